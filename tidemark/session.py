"""Session settings the library relies on, and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Only what the results depend on, or what every plan here profits from. Sizing
# (executors, memory, shuffle partitions) belongs to the cluster's own configuration.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings above to an existing session."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, app: str = "tidemark") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Recording the Python line behind every column doubles the time to build a query.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shuffle_partitions(spark: SparkSession) -> int:
    """As configured; on a single machine no more than it has cores."""
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sc = spark.sparkContext
    return min(configured, sc.defaultParallelism) if sc.master.startswith("local") else configured


# State grows with keys and open windows, beyond what fits a heap; only changes are uploaded.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def streaming_session(spark: SparkSession) -> SparkSession:
    """A session of the same application for stateful streams.

    A stream keeps the number of state partitions it was first started with. It is taken
    from here, so that it and the state store are set for streams alone.
    """
    session = configure(spark.newSession())
    for key, value in STATE_STORE.items():
        session.conf.set(key, value)
    session.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions(spark)))
    return session


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Unset is tolerated on a single machine only: a cluster's executors could not see a
    folder that exists on one of them.
    """
    sc = spark.sparkContext
    named = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="tidemark-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one, for tables a job writes for itself."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# Shuffle files go with the write that made them, not when the driver's collector finds them.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a small intermediate table to the shared folder and go on from there.

    For tables read several times: the pass that made them runs once, a lost executor takes
    nothing with it, and the planner knows the size of what it reads.
    """
    return written(df, work_dir(df.sparkSession, name))


def written(df: DataFrame, path: str) -> DataFrame:
    """The same in a folder of the caller's, who may delete it when nothing reads the table any more."""
    spark = df.sparkSession
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)
