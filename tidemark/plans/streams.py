"""The streaming jobs run to the end of the shared tables, as queries.

``events`` is landed as many files in the order of its rows, or in the disordered arrival of
``views.as_arrivals``, and read some files a batch. What is open when the input ends is taken from
the state, so the results are those of the batch queries over the whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import counts, distinct
from tidemark.operators.topn import ITEM_LABELS, PAGE_LABELS, ranking_report, top_n
from tidemark.plans import views
from tidemark.session import configure, streaming_session, work_dir
from tidemark.sources.access_log import read_access_log, stream_access_log
from tidemark.sources.behavior import read_behavior, stream_behavior
from tidemark.sources.landing import land_in_order
from tidemark.sources.marketing import read_marketing, stream_marketing
from tidemark.streaming import jobs
from tidemark.streaming.files import SharedFolder

#: Files the input is landed as at least, bytes of the table for each when it is large, files a batch.
FILES = 24
FILE_BYTES = 64 << 20
FILES_A_BATCH = 3


def _files(spark: SparkSession, sf_dir: str) -> int:
    return max(FILES, SharedFolder(spark, sf_dir).size("events.parquet") // FILE_BYTES)


def _arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of access-log rows as they arrive, out of order, one file a batch."""
    arrivals = views.arrival_events(spark, sf_dir)
    landed = land_in_order(arrivals, "arrival_key", work_dir(spark, "arrivals"), _files(spark, sf_dir))
    reader = configure(streaming_session(spark)).readStream.schema(arrivals.schema).option("recursiveFileLookup", True)
    return reader.option("maxFilesPerTrigger", 1).parquet(landed)


def _events(spark: SparkSession, sf_dir: str, files: int = FILES_A_BATCH) -> DataFrame:
    """A stream of the events in order, several files a batch."""
    events = views.raw_events(spark, sf_dir).withColumn("order", F.unix_micros(F.col("ts").cast("timestamp")))
    landed = land_in_order(events, "order", work_dir(spark, "events"), _files(spark, sf_dir))
    reader = configure(streaming_session(spark)).readStream.schema(views.EVENTS).option("recursiveFileLookup", True)
    return views.event_columns(reader.option("maxFilesPerTrigger", files).parquet(landed))


def _to_the_end(results: jobs.WindowResults) -> DataFrame:
    results.start(once=True).awaitTermination()
    results.finish()
    return results.read()


def _paths(spark: SparkSession, name: str) -> tuple[str, str]:
    base = work_dir(spark, name)
    return f"{base}/out", f"{base}/checkpoint"


def pv_hourly_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _to_the_end(jobs.page_view_results(spark, views.as_behavior(_events(spark, sf_dir)), *_paths(spark, "pv")))


def uv_hourly_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _to_the_end(jobs.unique_visitor_results(spark, views.as_behavior(_events(spark, sf_dir)), *_paths(spark, "uv")))


def channel_behavior_counts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    marketing = views.as_marketing(_events(spark, sf_dir))
    return _to_the_end(jobs.channel_results(spark, marketing, *_paths(spark, "channels")))


def hot_items_top5_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _to_the_end(jobs.item_rankings(spark, views.as_behavior(_events(spark, sf_dir)), *_paths(spark, "hot-items")))


def hot_items_report_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    behavior = views.as_behavior(_events(spark, sf_dir))
    return _to_the_end(jobs.item_reports(spark, behavior, *_paths(spark, "item-reports"), ITEM_LABELS))


def uv_hourly_bitmap_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, checkpoint = _paths(spark, "running-uv")
    visitors = jobs.RunningVisitors(spark, out)
    visitors.start(views.as_behavior(_events(spark, sf_dir)), checkpoint, once=True).awaitTermination()
    return visitors.current()


# Runs of a job that several queries ask about, by application and tables.
_RUNS: dict[tuple[str, ...], jobs.PageFirings] = {}


def _run_once(spark: SparkSession, sf_dir: str, name: str, arrival: list[str], log: Callable[[], DataFrame]) -> jobs.PageFirings:
    run = spark.sparkContext.applicationId, sf_dir, name
    if run not in _RUNS:
        out, checkpoint = _paths(spark, name)
        pages = jobs.PageFirings(spark, out, arrival)
        pages.start(log(), checkpoint, once=True).awaitTermination()
        pages.finish()
        _RUNS[run] = pages
    return _RUNS[run]


def _in_order(spark: SparkSession, sf_dir: str) -> jobs.PageFirings:
    """The rows as they are in the table, whose event times never fall; a third of the files a batch."""

    def log() -> DataFrame:
        events = _events(spark, sf_dir, _files(spark, sf_dir) // 3)
        return events.select("event_id", F.unix_millis("ts").alias("order"), *views.access_log_fields())

    return _run_once(spark, sf_dir, "hot-pages", ["order", "event_id"], log)


def _firings(spark: SparkSession, sf_dir: str) -> jobs.PageFirings:
    """The rows out of order, one file a batch."""
    return _run_once(spark, sf_dir, "late-pages", ["arrival_key", "event_id"], lambda: _arrivals(spark, sf_dir))


def page_view_counts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _in_order(spark, sf_dir).counts().select("url", "window_end", "view_count")


def hot_pages_top3_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _in_order(spark, sf_dir).current_ranking()


def late_page_events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = _firings(spark, sf_dir).late.read()
    return late.select("event_id", F.unix_millis("ts").alias("event_ms"), "running_max_ms")


def page_counts_first_fire_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _firings(spark, sf_dir).counts().where("first_count > 0")
    return found.select("url", "window_end", F.col("first_count").alias("view_count"))


def page_counts_final_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _firings(spark, sf_dir).counts().select("url", "window_end", "view_count")


def hot_pages_first_fire_top3_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _firings(spark, sf_dir).first_ranking()


def hot_pages_final_top3_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _firings(spark, sf_dir).current_ranking()


def hot_pages_first_report_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = _firings(spark, sf_dir).reports(PAGE_LABELS)
    return reports.where("revision = 0").select("window_end", "report")


# The same results from text and JSON files, through the readers, in batch and as streams.


def _behavior_files(spark: SparkSession, sf_dir: str) -> str:
    lines = views.behavior_lines(views.behavior_events(spark, sf_dir), "ts")
    out = work_dir(spark, "behavior-files")
    return land_in_order(lines.withColumn("order", F.unix_seconds("ts")), "order", out, _files(spark, sf_dir), "text")


def _log_files(spark: SparkSession, sf_dir: str) -> str:
    lines = views.access_log_lines(views.access_log_events(spark, sf_dir), "ts")
    out = work_dir(spark, "log-files")
    return land_in_order(lines.withColumn("order", F.unix_seconds("ts")), "order", out, _files(spark, sf_dir), "text")


def _marketing_files(spark: SparkSession, sf_dir: str, fmt: str) -> str:
    records = views.marketing_records(views.marketing_events(spark, sf_dir))
    landed = records.withColumn("order", F.col("timestamp"))
    return land_in_order(landed, "order", work_dir(spark, "marketing-files"), _files(spark, sf_dir), fmt)


def hot_items_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    behavior = read_behavior(spark, f"{_behavior_files(spark, sf_dir)}/*")
    return top_n(counts.item_view_counts(behavior), 5, "item_id")


def hot_items_from_files_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    behavior = stream_behavior(streaming_session(spark), _behavior_files(spark, sf_dir), max_files=FILES_A_BATCH)
    return _to_the_end(jobs.item_rankings(spark, behavior, *_paths(spark, "file-items")))


def uv_hourly_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct.unique_visitors(read_behavior(spark, f"{_behavior_files(spark, sf_dir)}/*"))


def hot_pages_report_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = read_access_log(spark, f"{_log_files(spark, sf_dir)}/*")
    return ranking_report(top_n(counts.page_view_counts(log), 3, "url"), "url", PAGE_LABELS)


def page_counts_from_files_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines are judged for lateness by their place in the files, which are in order here."""
    out, checkpoint = _paths(spark, "file-pages")
    landed = _log_files(spark, sf_dir)
    log = stream_access_log(streaming_session(spark), landed, max_files=_files(spark, sf_dir) // 3, arrival=True)
    pages = jobs.PageFirings(spark, out)
    pages.start(log, checkpoint, once=True).awaitTermination()
    return pages.counts().select("url", "window_end", "view_count")


def channel_counts_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.channel_behavior_counts(read_marketing(spark, _marketing_files(spark, sf_dir, "json"), "json"))


def channel_counts_from_files_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = _marketing_files(spark, sf_dir, "parquet")
    marketing = stream_marketing(streaming_session(spark), landed, max_files=FILES_A_BATCH)
    return _to_the_end(jobs.channel_results(spark, marketing, *_paths(spark, "file-channels")))


STREAMS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (
        pv_hourly_stream,
        uv_hourly_stream,
        channel_behavior_counts_stream,
        hot_items_top5_stream,
        hot_items_report_stream,
        uv_hourly_bitmap_stream,
        page_view_counts_stream,
        hot_pages_top3_stream,
        late_page_events_stream,
        page_counts_first_fire_stream,
        page_counts_final_stream,
        hot_pages_first_fire_top3_stream,
        hot_pages_final_top3_stream,
        hot_pages_first_report_stream,
        hot_items_from_files,
        hot_items_from_files_stream,
        uv_hourly_from_files,
        hot_pages_report_from_files,
        page_counts_from_files_stream,
        channel_counts_from_files,
        channel_counts_from_files_stream,
    )
}
