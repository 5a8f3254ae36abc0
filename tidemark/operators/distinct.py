"""Unique visitors per window: exact, by hash bitmap, and by sketch.

The distinct forms are left to Spark's two-step distinct aggregation: duplicates are
removed within each task, then shuffled by (window, visitor), so neither a busy hour nor
a busy visitor gathers in one task; only one partial count per task meets at the end.

Bitmaps and sketches can also be kept, one for each pane of time, and merged: into windows of
any length made of whole panes, overlapping or not, and with those of data that comes later. What
is merged then follows the panes, not the visits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.hashing import BITMAP_BITS, visitor_slot
from tidemark.functions.timing import HOUR_MS
from tidemark.operators.counts import page_views_only
from tidemark.operators.windows import Sliding, pane_of, tumbling, window_end

# Registers of a sketch as a power of two: a standard error of 1.04 / 2^(LG_K / 2), 1.6 %.
LG_K = 12


def _per_window(behavior: DataFrame, size_ms: int, who: Column, measure: Column) -> DataFrame:
    visits = page_views_only(behavior).select(tumbling(size_ms), who.alias("who"))
    return visits.groupBy("w").agg(measure.alias("n")).select(window_end(), "n")


def unique_visitors(behavior: DataFrame, size_ms: int = HOUR_MS) -> DataFrame:
    """Exact distinct users per window."""
    counted = _per_window(behavior, size_ms, F.col("user_id"), F.count_distinct("who"))
    return counted.select(F.lit("uv").alias("name"), "window_end", F.col("n").alias("count"))


def unique_visitors_sliding(behavior: DataFrame, spec: Sliding) -> DataFrame:
    """Exact distinct users per overlapping window: a user counts once for each pane, then once for each window."""
    panes = _visits(behavior, spec).where(F.col("user_id").isNotNull()).select("pane", "user_id").distinct()
    seen = _in_windows(panes, spec).groupBy("start").agg(F.count_distinct("user_id").alias("count"))
    return seen.select(F.lit("uv").alias("name"), spec.end_ms(F.col("start")).alias("window_end"), "count")


def unique_visitors_bitmap(behavior: DataFrame, size_ms: int = HOUR_MS, bits: int = BITMAP_BITS) -> DataFrame:
    """Bits set in a 2^bits bitmap per window: distinct hash slots, whatever the row order."""
    slot = visitor_slot("user_id", bits)
    return _per_window(behavior, size_ms, slot, F.count_distinct("who")).withColumnRenamed("n", "uv_count")


def unique_visitors_approx(behavior: DataFrame, size_ms: int = HOUR_MS, rsd: float = 0.05) -> DataFrame:
    """Distinct users per window by HyperLogLog++ with relative error ``rsd``; constant state."""
    sketch = F.approx_count_distinct("who", rsd)
    return _per_window(behavior, size_ms, F.col("user_id"), sketch).withColumnRenamed("n", "uv_count")


def _visits(behavior: DataFrame, spec: Sliding) -> DataFrame:
    return page_views_only(behavior).where(F.col("ts").isNotNull()).withColumn("pane", pane_of("ts", spec))


def _in_windows(panes: DataFrame, spec: Sliding) -> DataFrame:
    """Each pane's row once for every window it belongs to."""
    pane = F.col("pane")
    return panes.withColumn("start", F.explode(F.sequence(spec.first_start(pane), spec.last_start(pane))))


def visitor_bitmaps(behavior: DataFrame, spec: Sliding, bits: int = BITMAP_BITS) -> DataFrame:
    """(pane, bucket, bitmap): the 2^bits bitmap of a pane, cut into buckets of 32,768 bits.

    Buckets without a visitor are left out. One takes 4 KiB however few visitors it has, so with
    fewer than some hundred to a bucket the plain distinct count is the smaller.
    """
    slots = _visits(behavior, spec).select("pane", visitor_slot("user_id", bits).alias("slot")).where("slot IS NOT NULL")
    return slots.groupBy("pane", F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bitmap")
    )


def unique_visitors_of_bitmaps(bitmaps: DataFrame, spec: Sliding) -> DataFrame:
    """Bits set per window, whatever tables of bitmaps (of the same ``spec``) were put together."""
    merged = _in_windows(bitmaps, spec).groupBy("start", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    counted = merged.groupBy("start").agg(F.sum(F.bitmap_count("bitmap")).alias("uv_count"))
    return counted.select(spec.end_ms(F.col("start")).alias("window_end"), "uv_count")


def visitor_sketches(behavior: DataFrame, spec: Sliding, lg_k: int = LG_K) -> DataFrame:
    """(pane, sketch): a HyperLogLog sketch of the users of each pane, of bounded size."""
    users = _visits(behavior, spec).where(F.col("user_id").isNotNull())
    return users.groupBy("pane").agg(F.hll_sketch_agg("user_id", lg_k).alias("sketch"))


def unique_visitors_of_sketches(sketches: DataFrame, spec: Sliding) -> DataFrame:
    """Estimated distinct users per window, whatever tables of sketches were put together."""
    estimated = _in_windows(sketches, spec).groupBy("start").agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("uv_count")
    )
    return estimated.select(spec.end_ms(F.col("start")).alias("window_end"), "uv_count")


def sketch_error(lg_k: int = LG_K, deviations: float = 3.0) -> float:
    """The relative error that an estimate stays within but for one in some hundred windows."""
    return deviations * 1.04 / 2 ** (lg_k / 2)
