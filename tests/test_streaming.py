import os
import random
from functools import partial

import pytest
from helpers import as_counter, behavior, brute_counts, log, ms
from pyspark.sql import functions as F

from tidemark.functions.timing import filter_after_watermark, monotone_watermark
from tidemark.operators import counts, distinct
from tidemark.operators.lateness import LatePages, Lateness
from tidemark.operators.topn import ITEM_LABELS, PAGE_LABELS, ranking_report, top_n
from tidemark.operators.windows import Sliding
from tidemark.sources.access_log import stream_access_log
from tidemark.sources.behavior import stream_behavior
from tidemark.sources.marketing import stream_marketing
from tidemark.streaming import jobs
from tidemark.streaming.sinks import to_console, to_parquet

HOUR = 3_600_000
START = ms("2024-01-01T00:00:00")
FAR = START + 1000 * HOUR


@pytest.fixture
def files(tmp_path):
    """Writes one text file per batch, in order."""
    folder = tmp_path / "in"
    folder.mkdir()
    def add(name, lines):
        file = folder / name
        file.write_text("\n".join(lines) + "\n")
        stamp = 1_700_000_000 + len(list(folder.iterdir()))
        os.utime(file, (stamp, stamp))

    add.path = str(folder)
    return add


def line(user, item, kind, at):
    return f"{user},{item},1,{kind},{at // 1000}"


def log_line(url, at, method="GET"):
    from datetime import datetime, timezone

    time = datetime.fromtimestamp(at / 1000, timezone.utc).strftime("%d/%m/%Y:%H:%M:%S")
    return f"10.0.0.1 - - {time} +0000 {method} {url}"


def drain(spark, df, tmp_path, name="out"):
    to_parquet(df, str(tmp_path / name), str(tmp_path / f"{name}-cp"), once=True).awaitTermination()
    return spark.read.schema(df.schema).parquet(str(tmp_path / name))


ROWS = [(u, i, "pv" if (u + i) % 3 else "buy", START + (u * 7 + i) * 400_000) for u in range(6) for i in range(5)]
ROWS.sort(key=lambda r: r[3])


def feed(files, rows, batches=3, sentinel=True):
    step = -(-len(rows) // batches)
    for b in range(batches):
        files(f"{b}.csv", [line(*r) for r in rows[b * step : (b + 1) * step]])
    if sentinel:
        files("z.csv", [line(0, 0, "end", FAR)])


def as_set(df):
    return {tuple(r) for r in df.collect()}


def results_of(spark, make, files, tmp_path, name):
    return make(spark, stream_behavior(spark, files.path, max_files=1), str(tmp_path / name), str(tmp_path / f"{name}-cp"))


def test_closed_windows_equal_batch(spark, files, tmp_path):
    """A far later row of no interest to any count closes every window."""
    feed(files, ROWS)
    batch = behavior(spark, ROWS)
    expected = {
        "pv": (jobs.page_view_results, counts.page_views(batch)),
        "uv": (jobs.unique_visitor_results, distinct.unique_visitors(batch)),
        "top": (partial(jobs.item_rankings, n=2), top_n(counts.item_view_counts(batch), 2, "item_id")),
    }
    for name, (make, answer) in expected.items():
        results = results_of(spark, make, files, tmp_path, name)
        results.start(once=True).awaitTermination()
        assert as_set(results.read()) == as_set(answer), name
        results.finish()
        assert as_set(results.read()) == as_set(answer), name


MAKERS = {
    "pv": (jobs.page_view_results, counts.page_views),
    "uv": (jobs.unique_visitor_results, distinct.unique_visitors),
    "top": (partial(jobs.item_rankings, n=2), lambda b: top_n(counts.item_view_counts(b), 2, "item_id")),
    "report": (
        partial(jobs.item_reports, labels=ITEM_LABELS, n=2),
        lambda b: ranking_report(top_n(counts.item_view_counts(b), 2, "item_id"), "item_id", ITEM_LABELS),
    ),
}


@pytest.mark.parametrize("name", sorted(MAKERS))
def test_the_end_of_the_input_and_what_follows_it(spark, files, tmp_path, name):
    """Open windows are added at the end, withdrawn when more comes, and added again."""
    make, batch = MAKERS[name]
    # Both parts end with a view, whose windows nothing closes.
    views = [k for k, r in enumerate(ROWS, 1) if r[2] == "pv"]
    cut, end = views[len(views) // 2], views[-1]
    feed(files, ROWS[:cut], batches=2, sentinel=False)
    results = results_of(spark, make, files, tmp_path, name)
    results.start(once=True).awaitTermination()
    closed = as_set(results.read())
    results.finish()
    half = as_set(batch(behavior(spark, ROWS[:cut])))
    assert as_set(results.read()) == half and closed < half
    results.finish()
    assert results.read().count() == len(half)

    files("more.csv", [line(*r) for r in ROWS[cut:end]])
    results = results_of(spark, make, files, tmp_path, name)
    results.start(once=True).awaitTermination()
    whole = as_set(batch(behavior(spark, ROWS[:end])))
    assert as_set(results.read()) < whole
    results.finish()
    rows = [tuple(r) for r in results.read().collect()]
    assert set(rows) == whole and len(rows) == len(whole)


def test_the_end_needs_the_state_of_the_last_batch(spark, files, tmp_path):
    feed(files, ROWS, sentinel=False)
    results = results_of(spark, jobs.page_view_results, files, tmp_path, "pv")
    results.start(once=True).awaitTermination()
    last = results.table.manifest().last
    results.table.write(results.table.read_batches([last]), last + 1)
    with pytest.raises(ValueError, match="restart the stream"):
        results.finish()


def test_channel_counts_at_the_end(spark, tmp_path):
    rows = [(1, "CLICK", "weibo", START), (2, "UNINSTALL", "weibo", START), (3, None, "weibo", START), (4, "CLICK", None, START + HOUR)]
    path = str(tmp_path / "m")
    spark.createDataFrame(rows, "user_id bigint, behavior string, channel string, timestamp bigint").coalesce(1).write.parquet(path)
    results = jobs.channel_results(spark, stream_marketing(spark, path), str(tmp_path / "out"), str(tmp_path / "cp"))
    results.start(once=True).awaitTermination()
    results.finish()
    first, second = "2024-01-01 01:00:00", "2024-01-01 02:00:00"
    assert as_set(results.read()) == {("weibo", "CLICK", first, 1), ("weibo", None, first, 1), (None, "CLICK", second, 1)}


def test_open_windows_are_not_emitted_before_the_end(spark, files, tmp_path):
    feed(files, [(1, 1, "pv", START), (1, 1, "pv", START + HOUR)], batches=2, sentinel=False)
    out = drain(spark, jobs.page_views_stream(stream_behavior(spark, files.path, max_files=1)), tmp_path)
    assert [r.window_end for r in out.collect()] == [START + HOUR]


def test_filtered_rows_still_close_windows(spark, files, tmp_path):
    feed(files, [(1, 1, "pv", START), (1, 1, "buy", START + 10 * HOUR)], batches=1, sentinel=False)
    stream = monotone_watermark(stream_behavior(spark, files.path))
    count = lambda df: df.groupBy(F.window("ts", "1 hour")).count()
    kept = filter_after_watermark(stream, F.col("behavior") == "pv")
    assert drain(spark, count(kept), tmp_path, "kept").count() == 1
    plain = stream.where(F.col("behavior") == "pv")
    assert drain(spark, count(plain), tmp_path, "plain").count() == 0, "the helper is no longer needed"


def test_running_visitors_and_replay(spark, files, tmp_path):
    feed(files, ROWS, batches=5, sentinel=False)
    out = str(tmp_path / "uv")
    visitors = jobs.RunningVisitors(spark, out, fanout=2)
    visitors.start(stream_behavior(spark, files.path, max_files=1), str(tmp_path / "cp"), once=True).awaitTermination()
    expected = {r.window_end: r.uv_count for r in distinct.unique_visitors_bitmap(behavior(spark, ROWS)).collect()}
    found = lambda: {r.window_end: r.uv_count for r in visitors.current().collect()}
    assert found() == expected
    assert any(e.level for e in visitors.table.manifest().entries), "batches have been merged"
    last = visitors.table.manifest().last
    batch = visitors.table.read_batches([last]).cache()
    batch.count()
    visitors.table.write(batch, last)
    assert found() == expected


def test_small_bitmap_stream_collides_like_the_batch_form(spark, files, tmp_path):
    rows = [(u, 1, "pv", START + u * 1000) for u in range(60)]
    feed(files, rows, sentinel=False)
    visitors = jobs.RunningVisitors(spark, str(tmp_path / "uv"), bits=5)
    visitors.start(stream_behavior(spark, files.path, max_files=1), str(tmp_path / "cp"), once=True).awaitTermination()
    (batch,) = distinct.unique_visitors_bitmap(behavior(spark, rows), bits=5).collect()
    (stream,) = visitors.current().collect()
    assert tuple(stream) == (batch.window_end, batch.uv_count) and batch.uv_count < 60


PAGES = dict(n=3, spec=Sliding(10_000, 5_000))


def run_pages(spark, files, tmp_path, name="pages", **settings):
    pages = jobs.PageFirings(spark, str(tmp_path / name), **{**PAGES, **settings})
    log = stream_access_log(spark, files.path, max_files=1, arrival=True)
    pages.start(log, str(tmp_path / f"{name}-cp"), once=True).awaitTermination()
    return pages


def test_rankings_fire_once_and_are_revised_by_number(spark, files, tmp_path):
    """Ten-second windows every five; /b is late but admitted, /gone comes too late."""
    first = [("/a", START), ("/a", START + 1000), ("/c", START + 2000), ("/x.css", START + 2000)]
    later = [("/z", START + 40_000)]
    late = [("/b", START + 1000), ("/b", START + 1000), ("/b", START + 3000)]
    later_still = [("/z", START + 41_000), ("/c", START + 4000), ("/c", START + 4000), ("/c", START + 4000)]
    end = [("/z", START + 200_000), ("/gone", START)]
    for i, batch in enumerate([first, later, late, later_still, end]):
        files(f"{i}.log", [log_line(*r) for r in batch])
    pages = run_pages(spark, files, tmp_path)
    admitted = [r for r in first + later + late + later_still + end if r[0] not in ("/x.css", "/gone")]
    assert as_counter(pages.counts().select("url", "window_end", "view_count"), "url") == brute_counts(admitted, 10_000, 5_000)
    assert [(r.url, r.running_max_ms) for r in pages.late.read().collect()] == [("/gone", START + 200_000)]
    history = pages.rankings.read().where(F.col("window_end") == START + 5_000).orderBy("revision", "rank").collect()
    assert [(r.revision, r["rank"], r.url, r.view_count) for r in history] == [
        (0, 1, "/a", 2), (0, 2, "/c", 1),
        (1, 1, "/b", 3), (1, 2, "/a", 2), (1, 3, "/c", 1),
        (2, 1, "/c", 4), (2, 2, "/b", 3), (2, 3, "/a", 2),
    ]
    reports = {(r.window_end, r.revision): r.report for r in pages.reports(PAGE_LABELS).collect()}
    assert "NO 1: URL = /a Page View = 2" in reports[START + 5_000, 0] and "/b" not in reports[START + 5_000, 0]
    assert "NO 1: URL = /c Page View = 4" in reports[START + 5_000, 2]
    assert max(r.window_end for r in pages.rankings.read().collect()) < START + 200_000
    pages.finish()
    assert max(r.window_end for r in pages.rankings.read().collect()) == START + 210_000


def disordered(n, seed=3):
    """(url, event time) in arrival order, up to 100 s out of order."""
    rng = random.Random(seed)
    rows = [(f"/{rng.randrange(5)}", START + k * 2_000, rng.choice((0, 0, 3_000, 30_000, 100_000))) for k in range(n)]
    return [(u, at) for u, at, _ in sorted(rows, key=lambda r: r[1] + r[2])]


def test_results_do_not_depend_on_the_cut_into_batches(spark, files, tmp_path):
    """Late and counted rows and both rankings equal those of the batch operators, for every cut and fanout."""
    rows = disordered(150)
    lateness = Lateness(5_000, 60_000)
    arrivals = log(spark, [(k, u, at) for k, (u, at) in enumerate(rows)])
    batch = LatePages(arrivals, ["arrival"], PAGES["spec"], lateness)
    late = sorted((r.url, r.running_max_ms) for r in batch.late_rows().collect())
    first, final = as_set(batch.first_ranking()), as_set(batch.final_ranking())
    counted = as_set(batch.firings().select("url", "window_end", "first_count", "view_count"))
    assert late and first != final
    for cuts, fanout in ((1, 16), (9, 2)):
        source = type("Files", (), {})()
        folder = tmp_path / f"in{cuts}"
        folder.mkdir()
        step = -(-len(rows) // cuts)
        for k in range(cuts):
            file = folder / f"{cuts - k:02d}.log"
            file.write_text("\n".join(log_line(*r) for r in rows[k * step : (k + 1) * step]) + "\n")
            os.utime(file, (1_700_000_000 + k, 1_700_000_000 + k))
        source.path = str(folder)
        pages = run_pages(spark, source, tmp_path, f"pages{cuts}", lateness=lateness, fanout=fanout)
        pages.finish()
        found = sorted((r.url, r.running_max_ms) for r in pages.late.read().collect())
        assert found == late, cuts
        assert as_set(pages.counts().select("url", "window_end", "first_count", "view_count")) == counted, cuts
        assert as_set(pages.first_ranking()) == first, cuts
        assert as_set(pages.current_ranking()) == final, cuts
        # Every request is late or counted in the last of its windows.
        last = pages.counts().where("window_end % 5000 = 0").groupBy().agg(F.sum("view_count")).first()[0]
        assert last <= 2 * (len(rows) - len(late)) and len(late) + batch.requests.count() - len(found) == len(rows)


def test_a_restart_with_another_fanout_changes_nothing(spark, files, tmp_path):
    rows = disordered(60)
    for k in range(4):
        files(f"{k}.log", [log_line(*r) for r in rows[k * 10 : k * 10 + 10]])
    run_pages(spark, files, tmp_path, fanout=2)
    files("4.log", [log_line(*r) for r in rows[40:]])
    pages = run_pages(spark, files, tmp_path, fanout=5)
    pages.finish()
    batch = LatePages(log(spark, [(k, u, at) for k, (u, at) in enumerate(rows)]), ["arrival"], PAGES["spec"])
    assert as_set(pages.current_ranking()) == as_set(batch.final_ranking())
    assert as_set(pages.first_ranking()) == as_set(batch.first_ranking())


def test_repeating_a_batch_changes_nothing(spark, tmp_path):
    rows = disordered(90)
    pages = jobs.PageFirings(spark, str(tmp_path / "pages"), ["arrival"], **PAGES)
    arrivals = log(spark, [(k, u, at) for k, (u, at) in enumerate(rows)])
    state = lambda: [
        sorted(map(tuple, df.collect()), key=repr)
        for df in (pages.counts(), pages.rankings.read(), pages.late.read())
    ]
    for k in range(3):
        part = arrivals.where(F.col("arrival").between(30 * k, 30 * k + 29))
        pages.apply(part, k)
        before = state()
        pages.apply(part, k)
        assert state() == before, k
    pages.apply(arrivals.where("false"), 3)
    assert state() == before


def test_tables_hold_requests_by_their_windows_not_for_each_window(spark, tmp_path):
    """A request lies in 120 windows of ten minutes every five seconds and is stored once."""
    pages = jobs.PageFirings(spark, str(tmp_path / "pages"), ["arrival"])
    pages.apply(log(spark, [(1, "/a", START), (2, "/a", START + 1000), (3, "/b", START + 2000)]), 0)
    stored = [f for f in (tmp_path / "pages").glob("*/data/*") if f.parent.parent.name not in ("input", "rankings")]
    assert sum(spark.read.parquet(str(f)).count() for f in stored) <= 3
    assert pages.counts().agg(F.count("*"), F.sum("view_count")).first()[:] == (240, 360)


def test_rows_without_a_time_and_empty_batches(spark, tmp_path):
    pages = jobs.PageFirings(spark, str(tmp_path / "pages"), ["arrival"], **PAGES)
    pages.apply(log(spark, [(1, "/a", START)]).where("false"), 0)
    pages.apply(log(spark, [(1, "/a", None), (2, "/a", START), (3, None, START)]), 1)
    pages.finish()
    assert {tuple(r) for r in pages.current_ranking().collect()} == {(START + e, 1, "/a", 1) for e in (5_000, 10_000)}
    with pytest.raises(ValueError, match="missing"):
        pages.apply(log(spark, [(1, "/a", START)]), 3)


def test_channel_counts_of_a_marketing_stream(spark, tmp_path):
    rows = [(1, "CLICK", "weibo", START), (2, "UNINSTALL", "weibo", START), (3, None, "weibo", START), (0, "UNINSTALL", "x", FAR)]
    path = str(tmp_path / "m")
    spark.createDataFrame(rows, "user_id bigint, behavior string, channel string, timestamp bigint").coalesce(1).write.parquet(path)
    out = drain(spark, jobs.channel_counts_stream(stream_marketing(spark, path)), tmp_path)
    end = "2024-01-01 01:00:00"
    assert {tuple(r) for r in out.collect()} == {("weibo", "CLICK", end, 1), ("weibo", None, end, 1)}


def test_console_sink(spark, files, tmp_path):
    feed(files, ROWS, batches=1)
    query = to_console(
        jobs.page_views_stream(stream_behavior(spark, files.path)), "pv", str(tmp_path / "cp"), once=True
    )
    query.awaitTermination()
    assert query.name == "pv" and query.exception() is None


def test_a_batch_takes_few_jobs(spark, tmp_path):
    """Batches are many and mostly small, so what each costs besides its rows is their number of jobs."""
    pages = jobs.PageFirings(spark, str(tmp_path / "pages"), ["arrival"], **PAGES)
    rows = disordered(60)
    arrivals = log(spark, [(k, u, at) for k, (u, at) in enumerate(rows)])
    pages.apply(arrivals.where("arrival < 30"), 0)
    spark.sparkContext.setJobGroup("second batch", "")
    try:
        pages.apply(arrivals.where("arrival >= 30"), 1)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < len(spark.sparkContext.statusTracker().getJobIdsForGroup("second batch")) <= 24
