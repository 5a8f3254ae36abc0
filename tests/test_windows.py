import random

import pytest
from helpers import as_counter, behavior, brute_counts, log, ms
from pyspark.sql import functions as F

from tidemark.operators import counts
from tidemark.operators.windows import Sliding, sliding_counts, windowed_counts

HOUR, MINUTE, SECOND = 3_600_000, 60_000, 1_000


def test_row_on_the_edge_opens_a_window_and_is_not_in_the_one_that_ends(spark):
    rows = behavior(spark, [(1, 7, "pv", ms("2024-01-01T01:00:00"))])
    ends = sorted(r.window_end for r in counts.item_view_counts(rows).collect())
    assert ends == [ms("2024-01-01T01:05:00") + i * 5 * MINUTE for i in range(12)]


def test_window_without_rows_is_absent(spark):
    start = ms("2024-01-01T00:00:00")
    rows = behavior(spark, [(1, 7, "pv", start), (1, 7, "pv", start + 3 * HOUR)])
    assert sorted(r.window_end for r in counts.page_views(rows).collect()) == [start + HOUR, start + 4 * HOUR]


def test_other_behaviours_and_null_are_not_counted(spark):
    start = ms("2024-01-01T00:00:00")
    rows = behavior(spark, [(1, 7, "pv", start), (1, 7, "buy", start), (1, 7, None, start), (1, 7, "PV", start)])
    assert [(r.name, r["count"]) for r in counts.page_views(rows).collect()] == [("pv", 1)]


@pytest.mark.parametrize(
    "size, slide",
    [
        (HOUR, 5 * MINUTE),
        (10 * MINUTE, 5 * SECOND),
        (HOUR, HOUR),
        (7 * SECOND, 3 * SECOND),
        (10 * SECOND, 4 * SECOND),
        (2 * SECOND, 5 * SECOND),
        (250, 100),
    ],
)
def test_sliding_counts_match_the_definition(spark, size, slide):
    """Dense runs, long gaps, times before 1970 and bucket borders, a key per random case."""
    rng = random.Random(size * 31 + slide)
    spec = Sliding(size, slide)
    rows = []
    for case in range(40):
        border = rng.randrange(-3, 4) * spec.bucket * slide
        spread = rng.choice([slide, size, 3 * size, 25 * size])
        rows += [(case, border + rng.randrange(-spread, spread + 1)) for _ in range(rng.randrange(1, 25))]
    df = behavior(spark, [(0, key, "pv", t) for key, t in rows])
    expected = brute_counts(rows, size, slide)
    assert as_counter(sliding_counts(df, ["item_id"], spec), "item_id") == expected
    if size >= slide:
        assert as_counter(windowed_counts(df, ["item_id"], spec), "item_id") == expected


def test_several_keys_and_null_key_and_time(spark):
    start = ms("2024-01-01T00:00:00")
    df = behavior(spark, [(1, None, "pv", start), (1, None, "pv", start + 1), (2, 5, None, start), (1, 5, "pv", None)])
    out = sliding_counts(df, ["item_id", "behavior"], Sliding(2 * SECOND, SECOND))
    found = {(r.item_id, r.behavior, r.window_end): r.view_count for r in out.collect()}
    assert found == {
        (None, "pv", start + SECOND): 2,
        (None, "pv", start + 2 * SECOND): 2,
        (5, None, start + SECOND): 1,
        (5, None, start + 2 * SECOND): 1,
    }


def test_every_row_counts_once_per_overlap(spark, sf_small):
    from tidemark.plans import views

    pv = counts.page_views_only(views.behavior_events(spark, sf_small)).count()
    pages = counts.page_requests_only(views.access_log_events(spark, sf_small)).count()
    total = F.sum("view_count")
    assert counts.item_view_counts(views.behavior_events(spark, sf_small)).agg(total).first()[0] == 12 * pv
    assert counts.page_view_counts(views.access_log_events(spark, sf_small)).agg(total).first()[0] == 120 * pages
    assert counts.page_views(views.behavior_events(spark, sf_small)).agg(F.sum("count")).first()[0] == pv


def test_sizes_must_be_positive():
    with pytest.raises(ValueError):
        Sliding(0, 5)


def test_channel_counts_keep_a_null_behaviour_and_drop_uninstalls(spark):
    start = ms("2024-01-01T10:30:00")
    raw = [(1, "CLICK", "weibo"), (2, None, "weibo"), (3, "UNINSTALL", "weibo"), (4, "CLICK", "weibo")]
    df = spark.createDataFrame(raw, "user_id bigint, behavior string, channel string").withColumn(
        "ts", F.timestamp_millis(F.lit(start))
    )
    found = {tuple(r) for r in counts.channel_behavior_counts(df).collect()}
    assert found == {("weibo", "CLICK", "2024-01-01 11:00:00", 2), ("weibo", None, "2024-01-01 11:00:00", 1)}
    sliding = counts.channel_behavior_counts(df, Sliding(HOUR, 30 * MINUTE))
    assert {r.window_end for r in sliding.collect()} == {"2024-01-01 11:00:00", "2024-01-01 11:30:00"}


def test_static_assets(spark):
    start = ms("2024-01-01T00:00:00")
    urls = ["/a.css", "/a.css?x=1", "/a.CSS", "/a.cssx", "/js", "", "/a.png/b"]
    df = log(spark, [(i, url, start) for i, url in enumerate(urls)] + [(9, "/post", start, "POST"), (10, "/n", start, None)])
    assert sorted(r.url for r in counts.page_requests_only(df).collect()) == sorted(urls[1:])
