"""Marketing events from Parquet or JSON files with the fixed record schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.timing import from_epoch_millis
from tidemark.schemas import MARKETING_RECORD
from tidemark.session import configure


def _with_time(raw: DataFrame) -> DataFrame:
    return raw.select("user_id", "behavior", "channel", from_epoch_millis(F.col("timestamp")).alias("ts"))


def read_marketing(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Records whose ``timestamp`` is an epoch in milliseconds."""
    return _with_time(configure(spark).read.schema(MARKETING_RECORD).format(fmt).load(path))


def stream_marketing(spark: SparkSession, path: str, fmt: str = "parquet", max_files: int | None = None) -> DataFrame:
    reader = configure(spark).readStream.schema(MARKETING_RECORD).option("recursiveFileLookup", True)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _with_time(reader.format(fmt).load(path))
