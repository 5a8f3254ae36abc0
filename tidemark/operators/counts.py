"""Counts per window without a key of their own, and per channel and behaviour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.predicates import is_get, is_not_uninstall, is_page_url, is_page_view
from tidemark.functions.timing import HOUR_MS, MINUTE_MS, SECOND_MS, keep
from tidemark.operators.windows import Sliding, sliding_counts, tumbling, window_end, windowed_counts

HOT_ITEM_WINDOWS = Sliding(HOUR_MS, 5 * MINUTE_MS)
HOT_PAGE_WINDOWS = Sliding(10 * MINUTE_MS, 5 * SECOND_MS)


def page_views_only(behavior: DataFrame) -> DataFrame:
    return keep(behavior, is_page_view(F.col("behavior")))


def page_requests_only(log: DataFrame) -> DataFrame:
    return keep(keep(log, is_get(F.col("method"))), is_page_url(F.col("url")))


def _counts(df: DataFrame, keys: list[str], spec: Sliding, name: str = "view_count") -> DataFrame:
    """Spark's own windows where rows are not repeated, or on a stream; running sums otherwise."""
    count = windowed_counts if df.isStreaming or spec.size_ms == spec.slide_ms else sliding_counts
    return count(df, keys, spec, name)


def item_view_counts(behavior: DataFrame, spec: Sliding = HOT_ITEM_WINDOWS) -> DataFrame:
    """Views per (item, window)."""
    return _counts(page_views_only(behavior), ["item_id"], spec)


def page_view_counts(log: DataFrame, spec: Sliding = HOT_PAGE_WINDOWS) -> DataFrame:
    """Requests per (URL, window), static assets left out."""
    return _counts(page_requests_only(log), ["url"], spec)


def page_views(behavior: DataFrame, size_ms: int = HOUR_MS) -> DataFrame:
    """Views per tumbling window.

    The label is attached after counting. As a grouping key it would add nothing: rows are
    counted within each task first, so the shuffle carries one row per task and window.
    """
    return (
        page_views_only(behavior)
        .groupBy(tumbling(size_ms))
        .agg(F.count("*").alias("count"))
        .select(F.lit("pv").alias("name"), window_end(), "count")
    )


def channel_behavior_counts(marketing: DataFrame, spec: Sliding = Sliding(HOUR_MS, HOUR_MS)) -> DataFrame:
    """Events per (channel, behaviour, window) without uninstalls; ``window_end`` is text."""
    kept = keep(marketing, is_not_uninstall(F.col("behavior")))
    return channel_window_text(_counts(kept, ["channel", "behavior"], spec, name="count"))


def channel_window_text(counts: DataFrame) -> DataFrame:
    """Counts per (channel, behaviour) with the window end as text."""
    return counts.select(
        "channel",
        "behavior",
        F.date_format(F.timestamp_millis("window_end"), "yyyy-MM-dd HH:mm:ss").alias("window_end"),
        "count",
    )
