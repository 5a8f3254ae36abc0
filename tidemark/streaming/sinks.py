"""Starting a stream into a console, a table, or a function of its batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter


def _writer(df: DataFrame, mode: str, checkpoint: str, once: bool) -> DataStreamWriter:
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True) if once else writer


def to_console(df: DataFrame, label: str, checkpoint: str, mode: str = "append", once: bool = False) -> StreamingQuery:
    """Print each batch; ``label`` names the query in Spark's progress reports."""
    return _writer(df, mode, checkpoint, once).queryName(label).format("console").option("truncate", False).start()


def to_parquet(df: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append final rows to a table, each exactly once."""
    return _writer(df, "append", checkpoint, once).format("parquet").option("path", path).start()


def for_each_batch(
    df: DataFrame, act: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append", once: bool = False
) -> StreamingQuery:
    """Hand each batch to ``act``, which must give the same result when a batch is repeated."""
    return _writer(df, mode, checkpoint, once).foreachBatch(act).start()
