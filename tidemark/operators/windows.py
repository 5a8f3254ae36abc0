"""Counting per key over tumbling and sliding event-time windows.

Windows are half-open, aligned to the UTC epoch, named by their end in epoch
milliseconds, and absent when empty.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.integers import floor_div, floor_div_sql
from tidemark.functions.timing import epoch_ms, interval
from tidemark.session import shuffle_partitions

# Window starts covered by one (key, bucket) group of the running sum, as a multiple of
# the windows a row falls in. Wide buckets repeat fewer boundary rows, narrow ones make
# smaller groups; a group has at most two rows per window start either way.
BUCKET_SPANS = 10


@dataclass(frozen=True)
class Sliding:
    """Window length and distance between window starts, in milliseconds."""

    size_ms: int
    slide_ms: int

    def __post_init__(self) -> None:
        if self.size_ms <= 0 or self.slide_ms <= 0:
            raise ValueError("window size and slide must be positive")

    @property
    def pane_ms(self) -> int:
        """Rows within one pane belong to the same windows."""
        return gcd(self.size_ms, self.slide_ms)

    @property
    def bucket(self) -> int:
        return BUCKET_SPANS * max(1, -(-self.size_ms // self.slide_ms))

    def first_start(self, pane: Column) -> Column:
        """Index of the earliest window that holds a pane (index x slide = start)."""
        return floor_div(pane * self.pane_ms - self.size_ms, self.slide_ms) + 1

    def last_start(self, pane: Column) -> Column:
        return floor_div(pane * self.pane_ms, self.slide_ms)

    def first_start_ending_after(self, limit_ms: Column) -> Column:
        """Index of the earliest window whose end lies beyond ``limit_ms``."""
        return floor_div(limit_ms - self.size_ms, self.slide_ms) + 1

    def end_ms(self, start: Column) -> Column:
        return start * self.slide_ms + self.size_ms

    def first_start_sql(self, pane: str) -> str:
        return f"({floor_div_sql(f'{pane} * {self.pane_ms} - {self.size_ms}', self.slide_ms)} + 1)"

    def last_start_sql(self, pane: str) -> str:
        return floor_div_sql(f"{pane} * {self.pane_ms}", self.slide_ms)

    def first_start_ending_after_sql(self, limit_ms: str) -> str:
        return f"({floor_div_sql(f'{limit_ms} - {self.size_ms}', self.slide_ms)} + 1)"

    def end_ms_sql(self, start: str) -> str:
        return f"({start} * {self.slide_ms} + {self.size_ms})"

    def last_ending_by(self, limit_ms: int) -> int:
        """Index of the last window whose end does not lie beyond ``limit_ms``."""
        return (limit_ms - self.size_ms) // self.slide_ms


def tumbling(size_ms: int, ts: str = "ts") -> Column:
    """The tumbling window of a row, as a grouping column for batch and stream."""
    return F.window(ts, interval(size_ms)).alias("w")


def window_end(window: str = "w") -> Column:
    return F.unix_millis(f"{window}.end").alias("window_end")


def windowed_counts(df: DataFrame, keys: list[str], spec: Sliding, name: str = "view_count", ts: str = "ts") -> DataFrame:
    """Rows per (window, key) with Spark's own window assignment; the form streams accept."""
    return (
        df.groupBy(F.window(ts, interval(spec.size_ms), interval(spec.slide_ms)).alias("w"), *keys)
        .agg(F.count("*").alias(name))
        .select(*keys, window_end(), name)
    )


def sliding_counts(df: DataFrame, keys: list[str], spec: Sliding, name: str = "view_count", ts: str = "ts") -> DataFrame:
    """Rows per (window, key) for bounded input, without copying a row into each window.

    Rows are first counted per (key, pane), which combines before the shuffle and leaves
    nothing of a hot key or a hot moment but one row per map task.
    """
    panes = (
        df.where(F.col(ts).isNotNull())
        .groupBy(*keys, pane_of(ts, spec).alias("pane"))
        .agg(F.count("*").alias("n"))
    )
    spans = panes.select(
        *keys,
        spec.first_start(F.col("pane")).alias("lo"),
        spec.last_start(F.col("pane")).alias("hi"),
        "n",
    )
    return span_counts(spans, keys, spec, name)


def pane_of(ts: str, spec: Sliding) -> Column:
    return floor_div(epoch_ms(F.col(ts)), spec.pane_ms)


def pane_of_sql(ts: str, spec: Sliding) -> str:
    return floor_div_sql(f"unix_millis({ts})", spec.pane_ms)


def span_counts(spans: DataFrame, keys: list[str], spec: Sliding, name: str = "view_count") -> DataFrame:
    """Sum ``n`` per (key, window) over rows that count in every window from ``lo`` to ``hi``.

    A span may be empty (``lo`` beyond ``hi``) but not hold more windows than one row can.

    Each span turns into two steps, +n at ``lo`` and -n after ``hi``; the count is the
    running sum of the steps and holds until the next one. Work and shuffle follow the
    number of spans, not spans x windows; only the result itself is per window.

    The running sum is cut into buckets of window starts, and a span that reaches into the
    next bucket restarts there. So no group grows with a key's history.
    """
    return span_measures(spans, keys, spec, {name: "lo"})


def span_measures(spans: DataFrame, keys: list[str], spec: Sliding, measures: dict[str, str]) -> DataFrame:
    """Several such sums in one pass, each named and given the column its spans begin in.

    All spans of a row end in ``hi``. A window is in the result if any of its sums is above zero.
    """
    width = spec.bucket
    last = floor_div_sql("hi", width)
    names = list(measures)
    listed = ", ".join(f"`{k}`" for k in [*keys, "bucket"])

    def step(bucket: str, at: str, **parts: str) -> str:
        values = [f"'{m}', {parts.get(m, '0L')}" for m in names]
        return f"named_struct('bucket', {bucket}, 'at', {at}, {', '.join(values)})"

    made = []
    for measure, start in measures.items():
        lo = f"`{start}`"
        first = floor_div_sql(lo, width)
        made.append(step(f"CASE WHEN {lo} <= hi THEN {first} END", lo, **{measure: "n"}))
        made.append(step(f"CASE WHEN {last} > {first} THEN {last} END", f"{last} * {width}", **{measure: "n"}))
    counts_in = {m: f"`{start}` <= hi" for m, start in measures.items()}
    any_counts = " OR ".join(counts_in.values())
    ends = {m: f"CASE WHEN {counts_in[m]} THEN -n ELSE 0L END" if len(names) > 1 else "-n" for m in names}
    stays = f"({any_counts}) AND {floor_div_sql('hi + 1', width)} = {last}"
    made.append(step(f"CASE WHEN {stays} THEN {last} END", "hi + 1", **ends))
    steps = (
        spans.select(*keys, F.expr(f"inline(array({', '.join(made)}))"))
        .where("bucket IS NOT NULL")
        # Each row grows to as many as size / slide windows after this exchange, which the
        # bytes in it do not show: with the number given, AQE does not merge its partitions.
        .repartition(shuffle_partitions(spans.sparkSession), *keys, "bucket")
    )
    # A row is at most size / slide windows long, shorter than a bucket: two buckets suffice.
    in_order = f"PARTITION BY {listed} ORDER BY at"
    running = f"({in_order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    levels = steps.select(
        *keys,
        "at",
        *[F.expr(f"sum(`{m}`) OVER {running} AS `{m}`") for m in names],
        F.expr(f"coalesce(lead(at) OVER ({in_order}), (bucket + 1) * {width}) AS until"),
    ).where(f"({' OR '.join(f'`{m}` > 0' for m in names)}) AND until > at")
    # The outer form only keeps Catalyst from adding a second evaluation of the sequence
    # as a filter; the condition above already rules out empty ones.
    return levels.select(*keys, F.expr("explode_outer(sequence(at, until - 1)) AS start"), *names).select(
        *keys, F.expr(f"{spec.end_ms_sql('start')} AS window_end"), *names
    )
