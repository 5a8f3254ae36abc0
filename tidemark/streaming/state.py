"""What a stopped stream still holds in its state: windows that nothing has closed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.session import streaming_session

AGGREGATE = "stateStoreSave"


def last_batch(spark: SparkSession, checkpoint: str) -> int:
    """The last batch whose state is committed; -1 for a stream that never ran."""
    return _aggregate(spark, checkpoint)["maxBatchId"]


def _aggregate(spark: SparkSession, checkpoint: str):
    """The one aggregation of the query, by its operator's name."""
    found = [
        o
        for o in streaming_session(spark).read.format("state-metadata").load(checkpoint).collect()
        if o["operatorName"] == AGGREGATE
    ]
    if len(found) != 1:
        raise ValueError(f"{checkpoint} has {len(found)} aggregations, not one")
    return found[0]


def open_windows(spark: SparkSession, checkpoint: str, keys: list[str], name: str) -> DataFrame:
    """(``keys``, ``window_end``, ``name``) of the windows of a windowed count that are still open.

    Read as a table from the state of the last committed batch, spread over the state's
    partitions. The stream must have stopped.
    """
    operator = _aggregate(spark, checkpoint)["operatorId"]
    state = streaming_session(spark).read.format("statestore").option("operatorId", operator).load(checkpoint)
    parts = state.schema["key"].dataType
    windows = [f.name for f in parts if isinstance(f.dataType, StructType) and f.dataType.names == ["start", "end"]]
    if len(windows) != 1:
        raise ValueError(f"{checkpoint} does not count by one window but by {parts.names}")
    return state.select(
        *[F.col(f"key.{k}").alias(k) for k in keys],
        F.unix_millis(f"key.{windows[0]}.end").alias("window_end"),
        F.col("value.count").alias(name),
    )
