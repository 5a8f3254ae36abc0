import random
from collections import Counter

import pytest
from helpers import as_counter, log, running_max, window_ends
from pyspark.sql import functions as F

from tidemark.operators.lateness import Lateness, LatePages, LookupLimits, RunningMax
from tidemark.operators.windows import Sliding
from tidemark.plans import views

SIZE, SLIDE = 600_000, 5_000
BROADCAST = LookupLimits()
# No step may be broadcast, and a bucket of ten rows is already cut up.
SORTED = LookupLimits(steps=0, rows_per_task=10)


def expected_counts(rows, grace, size=SIZE, slide=SLIDE):
    seen = running_max([(a, t) for a, _, t in rows])
    found = Counter()
    for (_, url, t), newest in zip(rows, seen):
        for end in window_ends(t, size, slide):
            if newest is None or newest < end + grace:
                found[url, end] += 1
    return found


def expected_late(rows, closing, size=SIZE, slide=SLIDE):
    seen = running_max([(a, t) for a, _, t in rows])
    return sorted((a, n) for (a, _, t), n in zip(rows, seen) if n is not None and n >= t // slide * slide + size + closing)


@pytest.mark.parametrize("limits", [BROADCAST, SORTED], ids=["broadcast", "sorted"])
@pytest.mark.parametrize(
    "after, first, final",
    [(4_999, True, True), (5_000, False, True), (64_999, False, True), (65_000, False, False)],
)
def test_edges_of_one_window(spark, limits, after, first, final):
    """The newest row so far lies ``after`` ms beyond the end of the late row's last window."""
    t = 1_700_000_000_000 // SLIDE * SLIDE
    last_end = t + SIZE
    pages = LatePages(log(spark, [(1, "/a", last_end + after), (2, "/b", t)]), ["arrival"], limits=limits)
    assert ("/b", last_end) in as_counter(pages.first_counts(), "url") or not first
    assert (("/b", last_end) in as_counter(pages.first_counts(), "url")) is first
    assert (("/b", last_end) in as_counter(pages.final_counts(), "url")) is final
    late = [(r.arrival, r.running_max_ms) for r in pages.late_rows().collect()]
    assert late == ([] if final else [(2, last_end + after)])


@pytest.mark.parametrize("limits", [BROADCAST, SORTED], ids=["broadcast", "sorted"])
@pytest.mark.parametrize("delay", [0, 30_000, 2_000_000])
def test_against_the_definition(spark, limits, delay):
    """Arrival is bursty: many rows share a bucket, and stretches of arrival time are empty."""
    rng = random.Random(delay)
    rows, arrivals = [], set()
    for _ in range(400):
        t = 1_700_000_000_000 + rng.randrange(0, 4_000_000)
        arrival = t + rng.randrange(0, delay + 1)
        if rng.random() < 0.3:
            arrival = 1_700_003_000_000 + rng.randrange(0, 2_000)
        while arrival in arrivals:
            arrival += 1
        arrivals.add(arrival)
        rows.append((arrival, rng.choice(["/a", "/b", "/c"]), t))
    df = log(spark, rows)
    pages = LatePages(df, ["arrival"], limits=limits)
    assert as_counter(pages.first_counts(), "url") == expected_counts(rows, 5_000)
    assert as_counter(pages.final_counts(), "url") == expected_counts(rows, 65_000)
    assert sorted((r.arrival, r.running_max_ms) for r in pages.late_rows().collect()) == expected_late(rows, 65_000)


@pytest.mark.parametrize("limits", [BROADCAST, SORTED], ids=["broadcast", "sorted"])
def test_windows_and_delays_that_do_not_divide_each_other(spark, limits):
    rng = random.Random(3)
    rows = [(i, "/a", 1_700_000_000_000 + i * 300 - rng.randrange(0, 40_000)) for i in range(300)]
    spec, lateness = Sliding(10_000, 4_000), Lateness(3_000, 7_000)
    pages = LatePages(log(spark, rows), ["arrival"], spec, lateness, limits)
    assert as_counter(pages.first_counts(), "url") == expected_counts(rows, 3_000, 10_000, 4_000)
    assert as_counter(pages.final_counts(), "url") == expected_counts(rows, 10_000, 10_000, 4_000)
    late = sorted((r.arrival, r.running_max_ms) for r in pages.late_rows().collect())
    assert late == sorted(
        (a, n)
        for (a, _, t), n in zip(rows, running_max([(a, t) for a, _, t in rows]))
        if n is not None and all(n >= end + 10_000 for end in window_ends(t, 10_000, 4_000))
    )


@pytest.mark.parametrize("limits", [BROADCAST, SORTED], ids=["broadcast", "sorted"])
@pytest.mark.parametrize("granularity", [1, 5_000])
def test_running_max_with_equal_arrivals(spark, limits, granularity):
    """A third of the rows arrive in the same millisecond; the second column orders them."""
    rng = random.Random(granularity)
    raw = [(rng.choice([5_000_000, rng.randrange(0, 9_000_000)]), i, rng.randrange(0, 9_000_000)) for i in range(600)]
    df = spark.createDataFrame(raw, "arrival bigint, id bigint, at bigint").withColumn("ts", F.timestamp_millis("at"))
    found = RunningMax(df, ["arrival", "id"], granularity, limits=limits).attach(df)
    expected = running_max([((a, i), t) for a, i, t in raw])
    floored = {i: None if m is None else m // granularity * granularity for (_, i, _), m in zip(raw, expected)}
    assert {r.id: r.running_max_ms for r in found.collect()} == floored


@pytest.mark.parametrize("limits", [BROADCAST, SORTED], ids=["broadcast", "sorted"])
def test_sharpened_maximum_is_exact(spark, limits):
    """Many values within one stretch, and one row far ahead that all later rows look up."""
    rng = random.Random(9)
    raw = [(i, i % 3, 1_700_000_000_000 + rng.randrange(0, 12_000)) for i in range(300)]
    raw += [(300, 0, 1_800_000_000_000)] + [(301 + i, 0, 1_700_000_000_000 + i) for i in range(100)]
    df = spark.createDataFrame(raw, "arrival bigint, id bigint, at bigint").withColumn("ts", F.timestamp_millis("at"))
    clock = RunningMax(df, ["arrival", "id"], 5_000, limits=limits)
    expected = {a: m for (a, _, _), m in zip(raw, running_max([((a, i), t) for a, i, t in raw]))}
    assert {r.arrival: r.running_max_ms for r in clock.sharpen(clock.attach(df)).collect()} == expected


def test_rows_that_are_filtered_out_still_move_the_clock(spark):
    t = 1_700_000_000_000 // SLIDE * SLIDE
    rows = [(1, "/x", t + 2 * SIZE, "POST"), (2, "/b", t, "GET")]
    pages = LatePages(log(spark, rows), ["arrival"])
    assert as_counter(pages.final_counts(), "url") == Counter()
    assert [r.url for r in pages.late_rows().collect()] == ["/b"]


def test_revised_ranking_is_over_the_complete_counts(spark):
    """A late /b overtakes nothing but must leave /a and /c in the revised ranking."""
    t = 1_700_000_000_000 // SLIDE * SLIDE
    end = t + SLIDE
    rows = [(1, "/a", t), (2, "/a", t), (3, "/c", t), (4, "/z", end + 6_000), (5, "/b", t), (6, "/b", t), (7, "/b", t)]
    pages = LatePages(log(spark, rows), ["arrival"])

    def at_end(df):
        return [(r.url, r.view_count) for r in df.where(F.col("window_end") == end).orderBy("rank").collect()]

    assert at_end(pages.first_ranking()) == [("/a", 2), ("/c", 1)]
    assert at_end(pages.final_ranking()) == [("/b", 3), ("/a", 2), ("/c", 1)]


def test_profile_of_the_shared_arrivals(spark, sf_check):
    """Before any filter: rows and (row, window) pairs on time, admitted and late."""
    df = views.arrival_events(spark, sf_check).withColumn("method", F.lit("GET")).withColumn("url", F.lit("/"))
    pages = LatePages(df, ["arrival_key", "event_id"])
    total = F.sum("view_count")
    assert pages.first_counts().agg(total).first()[0] == 717_699
    assert pages.final_counts().agg(total).first()[0] == 757_027
    assert pages.late_rows().count() == 2_137


def test_first_never_exceeds_final(spark, sf_small):
    pages = LatePages(views.arrival_events(spark, sf_small), ["arrival_key", "event_id"])
    first = pages.first_counts().withColumnRenamed("view_count", "first")
    both = first.join(pages.final_counts(), ["url", "window_end"], "left")
    assert both.where(F.col("view_count").isNull() | (F.col("first") > F.col("view_count"))).count() == 0


def test_a_busy_stretch_is_looked_up_in_slices(spark):
    """Nearly all rows ask for the same stretch; each slice of them has a copy of its list."""
    raw = [(0, 0, 1_700_000_004_000), (1, 0, 1_700_000_003_000), (2, 0, 1_700_000_004_999)]
    raw += [(3 + k // 7, k, 1_699_000_000_000 + k) for k in range(700)] + [(500, 0, 1_700_000_030_000), (501, 0, 0)]
    df = spark.createDataFrame(raw, "arrival bigint, id bigint, at bigint").withColumn("ts", F.timestamp_millis("at"))
    expected = {(a, i): m for (a, i, _), m in zip(raw, running_max([((a, i), t) for a, i, t in raw]))}
    for limits in (LookupLimits(rows_per_task=20), LookupLimits()):
        clock = RunningMax(df, ["arrival", "id"], 5_000, limits=limits)
        assert {(r.arrival, r.id): r.running_max_ms for r in clock.sharpen(clock.attach(df)).collect()} == expected


@pytest.mark.parametrize("at_most", [None, 1_000])
def test_first_and_final_counts_in_one_pass(spark, at_most):
    rng = random.Random(12)
    rows = [(i, rng.choice(["/a", "/b"]), 1_700_000_000_000 + i * 300 - rng.randrange(0, 100_000)) for i in range(300)]
    pages = LatePages(log(spark, rows), ["arrival"], Sliding(10_000, 5_000), at_most=at_most)
    both = pages.firings()
    first = both.where("first_count > 0").select("url", "window_end", F.col("first_count").alias("view_count"))
    assert as_counter(first, "url") == expected_counts(rows, 5_000, 10_000, 5_000)
    assert as_counter(both.select("url", "window_end", "view_count"), "url") == expected_counts(rows, 65_000, 10_000, 5_000)
    assert both.where("first_count > view_count").count() == 0


def test_packed_arrivals_are_in_the_order_of_their_columns(spark):
    values = [-(2**40), -1, 0, 1, 1_700_000_000_000]
    ids = [-(2**63), -1, 0, 2**63 - 1]
    raw = [(a, i, 0) for a in values for i in ids]
    df = spark.createDataFrame(raw, "arrival bigint, id bigint, at bigint").withColumn("ts", F.timestamp_millis("at"))
    packed = df.select("arrival", "id", RunningMax(df, ["arrival", "id"], 1)._order().alias("o")).orderBy("o").collect()
    assert [(r.arrival, r.id) for r in packed] == [(a, i) for a, i, _ in raw]
    assert len({r.o for r in packed}) == len(raw)


def test_a_small_log_has_the_exact_maximum_in_one_pass(spark):
    """Rows of one arrival do not see each other; rows without a time do not move the clock."""
    rng = random.Random(5)
    rows = [(rng.randrange(400_000), rng.randrange(4), rng.choice([None, *range(0, 300_000, 7_000)])) for _ in range(400)]
    schema = "a bigint, b bigint, at bigint"
    df = spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_millis("at"))
    timed = RunningMax(df, ["a", "b"], 5_000, limits=LookupLimits(sorted_per_task=100), at_most=len(rows)).timed()
    found = sorted(tuple(r) for r in timed.select("a", "b", F.coalesce("at", F.lit(-1)), "running_max_ms").collect())
    before = lambda r: max((at for a, b, at in rows if (a, b) < r[:2] and at is not None), default=None)
    assert found == sorted((a, b, -1 if at is None else at, before((a, b))) for a, b, at in rows)
