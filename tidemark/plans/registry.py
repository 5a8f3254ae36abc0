"""Every query by name, over the shared tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.predicates import is_page_url
from tidemark.functions.timing import HOUR_MS
from tidemark.operators import counts, distinct
from tidemark.operators.lateness import LatePages
from tidemark.operators.topn import ITEM_LABELS, PAGE_LABELS, ranking_report, top_n
from tidemark.operators.windows import Sliding
from tidemark.plans import views
from tidemark.sources import access_log, behavior

Query = Callable[[SparkSession, str], DataFrame]


def item_view_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.item_view_counts(views.behavior_events(spark, sf_dir))


def hot_items_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_n(item_view_counts(spark, sf_dir), 5, "item_id")


def page_view_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.page_view_counts(views.access_log_events(spark, sf_dir))


def hot_pages_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_n(page_view_counts(spark, sf_dir), 3, "url")


def hot_items_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking_report(hot_items_top5(spark, sf_dir), "item_id", ITEM_LABELS)


def hot_pages_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking_report(hot_pages_top3(spark, sf_dir), "url", PAGE_LABELS)


def pv_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.page_views(views.behavior_events(spark, sf_dir))


def uv_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct.unique_visitors(views.behavior_events(spark, sf_dir))


def uv_hourly_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct.unique_visitors_bitmap(views.behavior_events(spark, sf_dir))


def uv_hourly_bitmap_128(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bitmap so small that visitors share slots."""
    return distinct.unique_visitors_bitmap(views.behavior_events(spark, sf_dir), bits=7)


def uv_hourly_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct.unique_visitors_approx(views.behavior_events(spark, sf_dir))


#: Panes of a quarter of an hour make an hour; hours make windows of six hours.
QUARTERS = Sliding(HOUR_MS, HOUR_MS // 4)
LONG_WINDOWS = Sliding(6 * HOUR_MS, HOUR_MS)
SMALL_BITMAP = 16


def uv_hourly_bitmap_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bitmaps of quarters of an hour, merged into hours that follow each other."""
    bitmaps = distinct.visitor_bitmaps(views.behavior_events(spark, sf_dir), QUARTERS)
    merged = distinct.unique_visitors_of_bitmaps(bitmaps, QUARTERS)
    return merged.where(F.col("window_end") % HOUR_MS == 0)


def uv_sliding_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six hours, every hour, from bitmaps of an hour each."""
    bitmaps = distinct.visitor_bitmaps(views.behavior_events(spark, sf_dir), LONG_WINDOWS, SMALL_BITMAP)
    return distinct.unique_visitors_of_bitmaps(bitmaps, LONG_WINDOWS)


def _within_bound(estimates: DataFrame, exact: DataFrame) -> DataFrame:
    """The exact count of each window, and whether the estimate is as near as the sketch promises."""
    error = F.greatest(F.lit(1.0), distinct.sketch_error() * F.col("visitors"))
    return exact.join(estimates, "window_end", "left").select(
        "window_end", "visitors", F.coalesce(F.abs(F.col("uv_count") - F.col("visitors")) <= error, F.lit(False)).alias("within_bound")
    )


def uv_hourly_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    behavior = views.behavior_events(spark, sf_dir)
    hours = Sliding(HOUR_MS, HOUR_MS)
    estimates = distinct.unique_visitors_of_sketches(distinct.visitor_sketches(behavior, hours), hours)
    return _within_bound(estimates, distinct.unique_visitors(behavior).withColumnRenamed("count", "visitors"))


def uv_sliding_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six hours, every hour, from sketches of an hour each, against the distinct users of each window."""
    behavior = views.behavior_events(spark, sf_dir)
    estimates = distinct.unique_visitors_of_sketches(distinct.visitor_sketches(behavior, LONG_WINDOWS), LONG_WINDOWS)
    return _within_bound(estimates, distinct.unique_visitors_sliding(behavior, LONG_WINDOWS).withColumnRenamed("count", "visitors"))


def channel_behavior_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.channel_behavior_counts(views.marketing_events(spark, sf_dir))


def _late_pages(spark: SparkSession, sf_dir: str) -> LatePages:
    return LatePages(views.arrival_events(spark, sf_dir), ["arrival_key", "event_id"])


def late_page_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = _late_pages(spark, sf_dir).late_rows()
    return late.select("event_id", F.unix_millis("ts").alias("event_ms"), "running_max_ms")


def page_counts_first_fire(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _late_pages(spark, sf_dir).first_counts()


def page_counts_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _late_pages(spark, sf_dir).final_counts()


def hot_pages_first_fire_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _late_pages(spark, sf_dir).first_ranking(3)


def hot_pages_final_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _late_pages(spark, sf_dir).final_ranking(3)


def static_asset_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = views.events(spark, sf_dir).select("event_id", *views.access_log_fields())
    return log.where(is_page_url(F.col("url"))).select("event_id", "url")


def parse_user_behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = views.behavior_lines(views.behavior_events(spark, sf_dir))
    parsed = behavior.records(lines)
    return parsed.select("user_id", "item_id", "category_id", "behavior", F.unix_millis("ts").alias("event_ms"))


def parse_access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = views.access_log_lines(views.access_log_events(spark, sf_dir))
    parsed = access_log.records(lines)
    return parsed.select("ip", "user_id", F.unix_millis("ts").alias("event_ms"), "method", "url")


def parse_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return behavior.records(views.damaged_lines(views.events(spark, sf_dir)), "quarantine").rejects


def parse_log_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access_log.records(views.damaged_log_lines(views.events(spark, sf_dir)), "quarantine").rejects


BATCH: dict[str, Query] = {
    q.__name__: q
    for q in (
        item_view_counts,
        hot_items_top5,
        page_view_counts,
        hot_pages_top3,
        pv_hourly,
        uv_hourly,
        uv_hourly_bitmap,
        uv_hourly_bitmap_128,
        uv_hourly_approx,
        uv_hourly_bitmap_merged,
        uv_sliding_bitmap,
        uv_hourly_sketch,
        uv_sliding_sketch,
        channel_behavior_counts,
        late_page_events,
        page_counts_first_fire,
        page_counts_final,
        hot_pages_first_fire_top3,
        hot_pages_final_top3,
        static_asset_filter,
        parse_user_behavior,
        parse_access_log,
        parse_rejects,
        parse_log_rejects,
        hot_items_report,
        hot_pages_report,
    )
}
