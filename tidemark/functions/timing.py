"""Event-time assignment and watermarks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SECOND_MS = 1_000
MINUTE_MS = 60 * SECOND_MS
HOUR_MS = 60 * MINUTE_MS


def from_epoch_seconds(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def from_epoch_millis(millis: Column) -> Column:
    return F.timestamp_millis(millis)


def epoch_ms(ts: Column) -> Column:
    """Epoch milliseconds of a TIMESTAMP, rounding down."""
    return F.unix_millis(ts)


def interval(ms: int) -> str:
    """A duration as the interval text Spark's window and watermark calls take."""
    return f"{ms} milliseconds"


def monotone_watermark(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Rows come in time order: the watermark follows the newest row."""
    return df.withWatermark(ts, interval(0))


def bounded_watermark(df: DataFrame, disorder_ms: int = 5 * SECOND_MS, ts: str = "ts") -> DataFrame:
    """Rows come at most ``disorder_ms`` behind the newest one."""
    return df.withWatermark(ts, interval(disorder_ms))


def filter_after_watermark(df: DataFrame, predicate: Column, ts: str = "ts") -> DataFrame:
    """Filter a watermarked stream while rejected rows still move its clock.

    Catalyst pushes an ordinary filter below the watermark, where the rows it drops no
    longer count towards it. A predicate that mentions the event-time column is left in
    place, so an alternative no row can satisfy (earlier than the smallest timestamp) is
    added. It must stay inside one OR: as a separate conjunct it would be split off.
    """
    before_all_time = F.col(ts) < F.timestamp_micros(F.lit(-(2**63)).cast("bigint"))
    return df.where(predicate | before_all_time)


def keep(df: DataFrame, predicate: Column, ts: str = "ts") -> DataFrame:
    """Filter bounded input plainly, so that the scan sees it, and a stream behind its watermark."""
    return filter_after_watermark(df, predicate, ts) if df.isStreaming else df.where(predicate)
