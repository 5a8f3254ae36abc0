import random

from helpers import ms

from tidemark.operators.topn import ITEM_LABELS, PAGE_LABELS, clock_text, ranking_report, top_n

COUNTS = "item_id bigint, window_end bigint, view_count bigint"


def ranks(df):
    return sorted((r.window_end, r["rank"], r.item_id, r.view_count) for r in df.collect())


def test_ties_go_to_the_smaller_key_and_short_windows_stay_short(spark):
    df = spark.createDataFrame([(3, 10, 5), (1, 10, 5), (2, 10, 9), (4, 10, 1), (8, 20, 1), (7, 20, 1)], COUNTS)
    assert ranks(top_n(df, 3, "item_id")) == [(10, 1, 2, 9), (10, 2, 1, 5), (10, 3, 3, 5), (20, 1, 7, 1), (20, 2, 8, 1)]


def test_counts_beyond_32_bits(spark):
    df = spark.createDataFrame([(1, 10, 2**31 + 5), (2, 10, 3), (3, 10, 2**33)], COUNTS)
    assert ranks(top_n(df, 2, "item_id")) == [(10, 1, 3, 2**33), (10, 2, 1, 2**31 + 5)]


def test_n_above_the_planners_threshold(spark):
    rng = random.Random(5)
    rows = [(item, window, rng.randrange(50)) for window in (10, 20) for item in range(3000)]
    found = ranks(top_n(spark.createDataFrame(rows, COUNTS), 1500, "item_id"))
    expected = []
    for window in (10, 20):
        best = sorted((r for r in rows if r[1] == window), key=lambda r: (-r[2], r[0]))[:1500]
        expected += [(window, i + 1, item, count) for i, (item, _, count) in enumerate(best)]
    assert found == expected


def test_report_text(spark):
    end = ms("2017-11-26T01:05:00")
    ranking = top_n(spark.createDataFrame([(1715, end, 3), (9, end, 2)], COUNTS), 5, "item_id")
    (row,) = ranking_report(ranking, "item_id", ITEM_LABELS).collect()
    assert row.window_end == end
    assert row.report == (
        "==============\nEndtime：2017-11-26 01:05:00.0\n"
        "NO 1: 商品ID = 1715 热门度 = 3\nNO 2: 商品ID = 9 热门度 = 2\n"
        "===============================\n\n"
    )


def test_report_lists_ranks_in_number_order(spark):
    rows = [(f"/{i:02d}", 5000, 100 - i) for i in range(12)]
    pages = spark.createDataFrame(rows, "url string, window_end bigint, view_count bigint")
    (row,) = ranking_report(top_n(pages, 12, "url"), "url", PAGE_LABELS).collect()
    lines = row.report.split("\n")[2:14]
    assert lines == [f"NO {i + 1}: URL = /{i:02d} Page View = {100 - i}" for i in range(12)]


def test_clock_text_fractions(spark):
    from pyspark.sql import functions as F

    cases = {0: "1970-01-01 00:00:00.0", 250: "1970-01-01 00:00:00.25", 5: "1970-01-01 00:00:00.005", 1000: "1970-01-01 00:00:01.0"}
    df = spark.createDataFrame([(k,) for k in cases], "t bigint").select("t", clock_text(F.col("t")).alias("text"))
    assert {r.t: r.text for r in df.collect()} == cases
