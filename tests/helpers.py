"""Small inputs and plain-Python definitions to hold results against."""

from __future__ import annotations

from collections import Counter
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ms(text: str) -> int:
    return int(datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp() * 1000)


def behavior(spark: SparkSession, rows) -> DataFrame:
    """(user, item, behaviour, epoch ms)"""
    raw = spark.createDataFrame(rows, "user_id bigint, item_id bigint, behavior string, at bigint")
    return raw.withColumn("ts", F.timestamp_millis("at")).drop("at")


def log(spark: SparkSession, rows) -> DataFrame:
    """(arrival position, url, epoch ms[, method])"""
    full = [(*r, "GET") if len(r) == 3 else r for r in rows]
    raw = spark.createDataFrame(full, "arrival bigint, url string, at bigint, method string")
    return raw.select(
        "arrival",
        F.lit("10.0.0.1").alias("ip"),
        F.lit("u").alias("user_id"),
        F.timestamp_millis("at").alias("ts"),
        "method",
        "url",
    )


def window_ends(t: int, size: int, slide: int) -> list[int]:
    """Ends of the windows [start, start + size) that hold ``t``, starts at multiples of ``slide``."""
    start = t // slide * slide
    ends = []
    while start > t - size:
        ends.append(start + size)
        start -= slide
    return ends


def brute_counts(rows, size: int, slide: int) -> Counter:
    """(key, t) rows to {(key, window end): count}"""
    return Counter((key, end) for key, t in rows for end in window_ends(t, size, slide))


def as_counter(df: DataFrame, key: str, count: str = "view_count") -> Counter:
    rows = df.select(key, "window_end", count).collect()
    found = Counter({(r[0], r[1]): r[2] for r in rows})
    assert len(found) == len(rows), "a (key, window) came out twice"
    return found


def running_max(rows) -> list[int | None]:
    """Newest time before each row; rows are (arrival, t) in any order."""
    newest, out = None, {}
    for position, t in sorted(rows):
        out[position] = newest
        newest = t if newest is None else max(newest, t)
    return [out[position] for position, _ in rows]
