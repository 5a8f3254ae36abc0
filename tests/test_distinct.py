import random

import pytest
from helpers import behavior, ms
from pyspark.sql import functions as F

from tidemark.functions.hashing import visitor_slot
from tidemark.operators import distinct
from tidemark.plans import views


def slot(user_id: int, bits: int) -> int:
    value = 0
    for character in str(user_id):
        value = value * 61 + ord(character)
    return value % (1 << bits)


@pytest.mark.parametrize("bits", [7, 29, 48])
def test_slots(spark, bits):
    rng = random.Random(bits)
    ids = [0, 1, -1, -5, 543462, 2**63 - 1, -(2**63)] + [rng.randrange(-(2**63), 2**63) for _ in range(200)]
    df = spark.createDataFrame([(i,) for i in ids], "id bigint").select("id", visitor_slot("id", bits).alias("slot"))
    assert {r.id: r.slot for r in df.collect()} == {i: slot(i, bits) for i in ids}


def test_known_slots(spark):
    known = {543462: 398203944, 9223372036854775807: 206843804, -5: 2798}
    df = spark.createDataFrame([(i,) for i in known], "id bigint").select("id", visitor_slot("id").alias("slot"))
    assert {r.id: r.slot for r in df.collect()} == known


def test_a_visitor_counts_once_per_window(spark):
    start = ms("2024-01-01T00:00:00")
    rows = [(1, 1, "pv", start), (1, 2, "pv", start + 5), (2, 1, "pv", start + 9), (3, 1, "buy", start), (1, 1, "pv", start + 3_600_000)]
    df = behavior(spark, rows)
    expected = {start + 3_600_000: 2, start + 7_200_000: 1}
    assert {r.window_end: r["count"] for r in distinct.unique_visitors(df).collect()} == expected
    assert {r.window_end: r.uv_count for r in distinct.unique_visitors_bitmap(df).collect()} == expected


def test_small_bitmap_undercounts_and_large_does_not(spark, sf_check):
    df = views.behavior_events(spark, sf_check)

    def total(bits):
        return distinct.unique_visitors_bitmap(df, bits=bits).agg(F.sum("uv_count"), F.count("*")).first()

    assert tuple(total(29)) == (1962, 667)
    assert tuple(total(7)) == (1930, 667)


def test_sketch_is_close(spark):
    start = ms("2024-01-01T00:00:00")
    users = spark.range(200_000).select(
        (F.col("id") % 50_000).alias("user_id"), F.lit("pv").alias("behavior"), F.timestamp_millis(F.lit(start)).alias("ts")
    )
    for rsd in (0.02, 0.05):
        (row,) = distinct.unique_visitors_approx(users, rsd=rsd).collect()
        assert abs(row.uv_count - 50_000) <= 4 * rsd * 50_000


def test_bitmap_never_exceeds_exact(spark, sf_check):
    df = views.behavior_events(spark, sf_check)
    both = distinct.unique_visitors(df).join(distinct.unique_visitors_bitmap(df, bits=7), "window_end")
    assert both.where(F.col("uv_count") > F.col("count")).count() == 0
