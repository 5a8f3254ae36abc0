"""Run a job over files: ``spark-submit`` or ``python -m tidemark JOB INPUT [--out FOLDER]``.

With ``--checkpoint`` the input is a folder that is read as a stream, and ``--out`` the folder of
the job's tables. The stream takes what is there and ends, results for open windows included;
the next run goes on where it stopped. With ``--follow`` it waits for files until it is stopped.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import counts, distinct
from tidemark.operators.lateness import LatePages
from tidemark.operators.topn import ITEM_LABELS, PAGE_LABELS, ranking_report, top_n
from tidemark.session import configure, streaming_session, work_dir
from tidemark.sources.access_log import land_access_log, stream_access_log
from tidemark.sources.behavior import read_behavior, stream_behavior
from tidemark.sources.lines import ARRIVAL
from tidemark.sources.marketing import read_marketing, stream_marketing
from tidemark.streaming import jobs


def hot_items(spark: SparkSession, path: str) -> DataFrame:
    ranking = top_n(counts.item_view_counts(read_behavior(spark, path)), 5, "item_id")
    return ranking_report(ranking, "item_id", ITEM_LABELS)


def _late_pages(spark: SparkSession, path: str) -> LatePages:
    return LatePages(land_access_log(spark, path, work_dir(spark, "access-log")), ARRIVAL)


def hot_pages(spark: SparkSession, path: str) -> DataFrame:
    return ranking_report(_late_pages(spark, path).final_ranking(3), "url", PAGE_LABELS)


def late_pages(spark: SparkSession, path: str) -> DataFrame:
    return _late_pages(spark, path).late_rows().drop(*ARRIVAL)


def page_views(spark: SparkSession, path: str) -> DataFrame:
    return counts.page_views(read_behavior(spark, path))


def unique_visitors(spark: SparkSession, path: str) -> DataFrame:
    return distinct.unique_visitors(read_behavior(spark, path))


def unique_visitors_bitmap(spark: SparkSession, path: str) -> DataFrame:
    return distinct.unique_visitors_bitmap(read_behavior(spark, path))


def channels(spark: SparkSession, path: str) -> DataFrame:
    return counts.channel_behavior_counts(read_marketing(spark, path))


JOBS = {
    f.__name__.replace("_", "-"): f
    for f in (hot_items, hot_pages, late_pages, page_views, unique_visitors, unique_visitors_bitmap, channels)
}


def _by_window(make, source):
    """A job whose windows close one after the other."""

    def run(spark: SparkSession, path: str, out: str, checkpoint: str, follow: bool) -> DataFrame:
        results = make(spark, source(streaming_session(spark), path), out, checkpoint)
        results.start(once=not follow).awaitTermination()
        results.finish()
        return results.read()

    return run


def _item_reports(spark: SparkSession, behavior: DataFrame, out: str, checkpoint: str) -> jobs.WindowResults:
    return jobs.item_reports(spark, behavior, out, checkpoint, ITEM_LABELS)


def _page_firings(spark: SparkSession, path: str, out: str, checkpoint: str, follow: bool) -> jobs.PageFirings:
    pages = jobs.PageFirings(spark, out)
    log = stream_access_log(streaming_session(spark), path, arrival=True)
    pages.start(log, checkpoint, once=not follow).awaitTermination()
    pages.finish()
    return pages


def _page_reports(spark: SparkSession, path: str, out: str, checkpoint: str, follow: bool) -> DataFrame:
    return _page_firings(spark, path, out, checkpoint, follow).reports(PAGE_LABELS)


def _late_requests(spark: SparkSession, path: str, out: str, checkpoint: str, follow: bool) -> DataFrame:
    return _page_firings(spark, path, out, checkpoint, follow).late.read().drop("arrival", "batch_id")


def _running_visitors(spark: SparkSession, path: str, out: str, checkpoint: str, follow: bool) -> DataFrame:
    visitors = jobs.RunningVisitors(spark, out)
    visitors.start(stream_behavior(streaming_session(spark), path), checkpoint, once=not follow).awaitTermination()
    return visitors.current()


STREAM_JOBS = {
    "hot-items": _by_window(_item_reports, stream_behavior),
    "hot-pages": _page_reports,
    "late-pages": _late_requests,
    "page-views": _by_window(jobs.page_view_results, stream_behavior),
    "unique-visitors": _by_window(jobs.unique_visitor_results, stream_behavior),
    "unique-visitors-bitmap": _running_visitors,
    "channels": _by_window(jobs.channel_results, stream_marketing),
}


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("input", help="file, folder or pattern")
    parser.add_argument("--out", help="folder for a Parquet result, printed if left out; of a stream's tables")
    parser.add_argument("--checkpoint", help="read the input as a stream that keeps its place in this folder")
    parser.add_argument("--follow", action="store_true", help="wait for more input")
    chosen = parser.parse_args(arguments)
    if chosen.checkpoint and not chosen.out:
        parser.error("a stream needs --out for its tables")
    if chosen.follow and not chosen.checkpoint:
        parser.error("--follow needs --checkpoint")
    spark = configure(SparkSession.builder.appName(f"tidemark {chosen.job}").getOrCreate())
    if chosen.checkpoint:
        STREAM_JOBS[chosen.job](spark, chosen.input, chosen.out, chosen.checkpoint, chosen.follow).show(truncate=False)
        return
    result = JOBS[chosen.job](spark, chosen.input)
    if chosen.out:
        result.write.parquet(chosen.out)
    else:
        result.show(truncate=False)


if __name__ == "__main__":
    main()
