"""The jobs over unbounded input.

Streams count with Spark's window and state operators. What Spark cannot rank or revise on
a stream is done on the closed or changed counts of each batch, with the batch operators.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DataType, LongType, StringType, StructField, StructType

from tidemark.functions.hashing import BITMAP_BITS, visitor_slot
from tidemark.functions.timing import HOUR_MS, monotone_watermark
from tidemark.operators.counts import (
    HOT_ITEM_WINDOWS,
    HOT_PAGE_WINDOWS,
    channel_behavior_counts,
    channel_window_text,
    item_view_counts,
    page_views,
    page_views_only,
)
from tidemark.operators.lateness import FIRINGS, LatePages, Lateness, LookupLimits
from tidemark.operators.topn import ranking_report, top_n
from tidemark.operators.windows import Sliding, span_measures, tumbling, window_end
from tidemark.schemas import ACCESS_LOG
from tidemark.sources.lines import number_arrivals
from tidemark.streaming.sinks import for_each_batch
from tidemark.streaming.state import last_batch, open_windows
from tidemark.streaming.tables import FANOUT, BatchTable, KeyedTable, Keys


def item_counts_stream(behavior: DataFrame, spec: Sliding = HOT_ITEM_WINDOWS) -> DataFrame:
    """Views per (item, window) of time-ordered rows; append mode emits a window once it has closed."""
    return item_view_counts(monotone_watermark(behavior), spec)


def page_views_stream(behavior: DataFrame, size_ms: int = HOUR_MS) -> DataFrame:
    return page_views(monotone_watermark(behavior), size_ms)


def channel_counts_stream(marketing: DataFrame, spec: Sliding = Sliding(HOUR_MS, HOUR_MS)) -> DataFrame:
    return channel_behavior_counts(monotone_watermark(marketing), spec)


def _first_seen(behavior: DataFrame, who: str, size_ms: int) -> DataFrame:
    """Each visitor of a window once. State is spread by (window, visitor) and dropped as windows close."""
    return (
        page_views_only(monotone_watermark(behavior))
        .select(tumbling(size_ms), who)
        .dropDuplicates(["w", who])
    )


def unique_visitors_stream(behavior: DataFrame, size_ms: int = HOUR_MS) -> DataFrame:
    """Exact distinct users per closed window."""
    counted = _first_seen(behavior, "user_id", size_ms).groupBy("w").agg(F.count("*").alias("count"))
    return counted.select(F.lit("uv").alias("name"), window_end(), "count")


def ranking_schema(key: str, key_type: DataType, *others: StructField) -> StructType:
    return StructType(
        [
            StructField("window_end", LongType()),
            *others,
            StructField("rank", LongType()),
            StructField(key, key_type),
            StructField("view_count", LongType()),
        ]
    )


class WindowResults:
    """What is made of a stream's windows as they close, and of the open ones when the input ends.

    ``counts`` is a windowed count in append mode: a window's rows all arrive in the batch that
    closes it, so what ``result`` makes of a batch is final. It runs as a batch query.

    A stream closes a window when a later row moves its clock. Finite input ends with windows
    that no row closes; ``finish`` takes these from the stream's state. Their results are
    provisional: if more input follows, they are withdrawn with its first batch, and the windows
    close in the ordinary way.
    """

    def __init__(
        self,
        spark: SparkSession,
        counts: DataFrame,
        out: str,
        checkpoint: str,
        schema: StructType,
        result: Callable[[DataFrame], DataFrame],
        from_state: Callable[[], DataFrame],
    ) -> None:
        self.spark = spark
        self.counts = counts
        self.checkpoint = checkpoint
        self.result = result
        self.from_state = from_state
        self.table = BatchTable(spark, out, schema)

    def start(self, once: bool = False) -> StreamingQuery:
        def act(batch: DataFrame, batch_id: int) -> None:
            self.table.write(self.result(batch), batch_id)

        return for_each_batch(self.counts, act, self.checkpoint, once=once)

    def finish(self) -> None:
        """Add the windows that are open at the end of the input. The stream must have stopped."""
        committed, written = last_batch(self.spark, self.checkpoint), self.table.manifest().last
        if committed != written:
            raise ValueError(f"batch {written} is written but {committed} is committed: restart the stream first")
        self.table.write_provisional(self.result(self.from_state()), committed)

    def read(self) -> DataFrame:
        return self.table.read().drop("batch_id")


def page_view_results(
    spark: SparkSession, behavior: DataFrame, out: str, checkpoint: str, size_ms: int = HOUR_MS
) -> WindowResults:
    counts = page_views_stream(behavior, size_ms)
    return WindowResults(
        spark, counts, out, checkpoint, counts.schema, lambda closed: closed,
        lambda: open_windows(spark, checkpoint, [], "count").withColumn("name", F.lit("pv")),
    )


def unique_visitor_results(
    spark: SparkSession, behavior: DataFrame, out: str, checkpoint: str, size_ms: int = HOUR_MS
) -> WindowResults:
    counts = unique_visitors_stream(behavior, size_ms)
    return WindowResults(
        spark, counts, out, checkpoint, counts.schema, lambda closed: closed,
        lambda: open_windows(spark, checkpoint, [], "count").withColumn("name", F.lit("uv")),
    )


def channel_results(
    spark: SparkSession, marketing: DataFrame, out: str, checkpoint: str, spec: Sliding = Sliding(HOUR_MS, HOUR_MS)
) -> WindowResults:
    counts = channel_counts_stream(marketing, spec)
    return WindowResults(
        spark, counts, out, checkpoint, counts.schema, lambda closed: closed,
        lambda: channel_window_text(open_windows(spark, checkpoint, ["channel", "behavior"], "count")),
    )


def item_rankings(
    spark: SparkSession, behavior: DataFrame, out: str, checkpoint: str, n: int = 5, spec: Sliding = HOT_ITEM_WINDOWS
) -> WindowResults:
    """Top-N items of each window. No window's keys are gathered into one state row."""
    counts = item_counts_stream(behavior, spec)
    return WindowResults(
        spark, counts, out, checkpoint, ranking_schema("item_id", counts.schema["item_id"].dataType),
        lambda closed: top_n(closed, n, "item_id"),
        lambda: open_windows(spark, checkpoint, ["item_id"], "view_count"),
    )


def item_reports(
    spark: SparkSession,
    behavior: DataFrame,
    out: str,
    checkpoint: str,
    labels: tuple[str, str],
    n: int = 5,
    spec: Sliding = HOT_ITEM_WINDOWS,
) -> WindowResults:
    """The report text of each window's ranking, written as the window closes."""
    counts = item_counts_stream(behavior, spec)
    schema = StructType([StructField("window_end", LongType()), StructField("report", StringType())])
    return WindowResults(
        spark, counts, out, checkpoint, schema,
        lambda closed: ranking_report(top_n(closed, n, "item_id"), "item_id", labels),
        lambda: open_windows(spark, checkpoint, ["item_id"], "view_count"),
    )


class RunningVisitors:
    """Unique visitors per window by hash bitmap, up to date after every batch.

    The state store is the bitmap: a slot passes the first time it is seen in a window.
    The result is a table by window to which each batch adds its new slots; repeating a batch
    replaces its share instead of counting it twice.
    """

    SCHEMA = StructType([StructField("window_end", LongType()), StructField("uv_count", LongType())])

    def __init__(
        self, spark: SparkSession, out: str, size_ms: int = HOUR_MS, bits: int = BITMAP_BITS, fanout: int = FANOUT
    ) -> None:
        self.table = KeyedTable(spark, out, self.SCHEMA, Keys(("window_end",), {"uv_count": "sum"}), fanout)
        self.size_ms = size_ms
        self.bits = bits

    def start(self, behavior: DataFrame, checkpoint: str, once: bool = False) -> StreamingQuery:
        slotted = behavior.withColumn("slot", visitor_slot("user_id", self.bits))
        new = _first_seen(slotted, "slot", self.size_ms).select(window_end())

        def act(batch: DataFrame, batch_id: int) -> None:
            self.table.write(batch.groupBy("window_end").agg(F.count("*").alias("uv_count")), batch_id)

        return for_each_batch(new, act, checkpoint, once=once)

    def current(self) -> DataFrame:
        return self.table.read().select("window_end", "uv_count")


# The last of a span's windows that had fired before its requests came; those begin with ``lo``.
LATE_TO = "least(lo_first - 1, hi)"


@dataclass(frozen=True)
class Revised:
    """Windows from ``lowest`` to ``highest`` that are ranked again: (window_end, revision)."""

    numbers: DataFrame
    lowest: int
    highest: int


class PageFirings:
    """Page rankings as windows fire and are revised, counts, and the requests that come too late.

    One clock rules them all: the newest event time among the rows that arrived before a row. It
    is judged row by row, inside a batch by the arrival columns and across batches by the value
    the batches before have left. So results do not depend on how the input is cut into batches,
    and a request is either late or counted.

    A window fires when the clock passes its end and the disorder: that ranking has revision 0.
    A request that comes later, but within the allowed lateness, revises it: each batch with such
    requests adds a revision of the windows they belong to, over the counts up to date. Once the
    clock passes the allowed lateness too, the window's counts are final and no longer read.

    What is stored of the requests are the spans of windows that take them, one row for many
    requests of a URL, not their windows. Each window is formed when it is ranked and when the counts are
    read, so the tables and the work on them do not grow with size / slide.

    ``arrival`` names LONG columns whose ascending order is that of arrival, as for
    :class:`RunningMax`. Without it, lines count in the order of the files and in them
    (``stream_access_log`` with ``arrival=True``).
    """

    SPANS = StructType(
        [StructField("url", StringType()), *(StructField(c, LongType()) for c in ("lo_first", "lo", "hi", "n"))]
    )
    RANKINGS = ranking_schema("url", StringType(), StructField("revision", LongType()))
    # A repeated batch looks up the one before it.
    KEEP = 2

    def __init__(
        self,
        spark: SparkSession,
        out: str,
        arrival: list[str] | None = None,
        n: int = 3,
        spec: Sliding = HOT_PAGE_WINDOWS,
        lateness: Lateness = Lateness(),
        limits: LookupLimits = LookupLimits(),
        fanout: int = FANOUT,
    ) -> None:
        self.numbered = arrival is None
        self.arrival = arrival or ["arrival"]
        self.n = n
        self.spec = spec
        self.lateness = lateness
        self.limits = limits
        rows = [*ACCESS_LOG.fields, *(StructField(c, LongType()) for c in self.arrival)]
        self.input = BatchTable(spark, f"{out}/input", StructType(rows), fanout, keep=self.KEEP)
        self.late = BatchTable(spark, f"{out}/late", StructType([*rows, StructField("running_max_ms", LongType())]), fanout)
        self.spans = BatchTable(spark, f"{out}/spans", self.SPANS, fanout)
        self.rankings = BatchTable(spark, f"{out}/rankings", self.RANKINGS, fanout)

    def start(self, log: DataFrame, checkpoint: str, once: bool = False) -> StreamingQuery:
        return for_each_batch(log, self.apply, checkpoint, once=once)

    def _newest(self, batch_id: int) -> int | None:
        """The clock after a batch, noted with its rankings; null before any row with a time."""
        return self.rankings.note(batch_id) if batch_id >= 0 else None

    def _passed(self, wait_ms: int, clock: int | None) -> int | None:
        """The last window whose end and ``wait_ms`` the clock has passed."""
        return None if clock is None else self.spec.last_ending_by(clock - wait_ms)

    def _ranking(self, after: int | None, last: int | None, revised: Revised | None = None) -> DataFrame:
        """Top-N of the windows beyond ``after`` up to ``last`` by the counts they fire with, as revision 0, and
        of the ``revised`` ones by the counts up to date. Counts are formed once for both."""
        low = None if after is None else min(w for w in (after + 1, revised and revised.lowest) if w is not None)
        high = max((w for w in (last, revised and revised.highest) if w is not None), default=None)
        measures = FIRINGS if revised else {"first_count": FIRINGS["first_count"]}
        spans, cut, hi = self.spans.read(), {c: c for c in measures.values()}, "hi"
        # Spans of windows long past are skipped by the statistics of their files.
        if low is not None:
            spans, cut = spans.where(f"hi >= {low}"), {c: f"greatest({c}, {low}L) AS {c}" for c in cut}
        if high is not None:
            spans, hi = spans.where(" OR ".join(f"{c} <= {high}" for c in cut)), f"least(hi, {high}L) AS hi"
        spans = (
            spans.selectExpr("url", *cut.values(), hi, "n")
            .where(" OR ".join(f"{c} <= hi" for c in cut))
            .groupBy("url", *cut, "hi")
            .agg(F.expr("sum(n) AS n"))
        )
        counts = span_measures(spans, ["url"], self.spec, measures)
        keys = ("window_end", "revision")
        if revised is None:
            fired = counts.selectExpr("url", "window_end", "0L AS revision", "first_count AS view_count")
            return top_n(fired, self.n, "url", keys=keys)
        fires = ["first_count > 0"]
        if after is not None:
            fires.append(f"window_end > {self.spec.end_ms(after)}")
        if last is not None:
            fires.append(f"window_end <= {self.spec.end_ms(last)}")
        first = f"CASE WHEN {' AND '.join(fires)} THEN struct(0L AS revision, first_count AS view_count) END"
        again = "CASE WHEN revision IS NOT NULL THEN struct(revision, view_count) END"
        counts = counts.join(revised.numbers, "window_end", "left").selectExpr(
            "url", "window_end", f"inline(array({first}, {again}))"
        )
        return top_n(counts.where("revision IS NOT NULL"), self.n, "url", keys=keys)

    def _revised(self, batch_id: int, lowest: int, highest: int) -> Revised:
        """The windows that had fired before requests of this batch came for them, with the numbers of their revisions.

        Of earlier rankings those of such windows are read; the rest is skipped by its statistics.
        """
        end = self.spec.end_ms
        again = (
            self.spans.read_batches([batch_id])
            .where(f"lo <= {LATE_TO}")
            .selectExpr(f"explode(sequence(lo, {LATE_TO})) AS start")
            .selectExpr(f"{self.spec.end_ms_sql('start')} AS window_end", "0L AS revision", "true AS now")
        )
        earlier = self.rankings.read_before(batch_id).where(f"window_end BETWEEN {end(lowest)} AND {end(highest)}")
        numbers = (
            again.union(earlier.selectExpr("window_end", "revision", "false AS now"))
            .groupBy("window_end")
            .agg(F.expr("max(revision) + 1 AS revision"), F.expr("max(now) AS now"))
            .where("now")
            .drop("now")
        )
        few = highest - lowest < self.limits.steps
        return Revised(F.broadcast(numbers) if few else numbers, lowest, highest)

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        before = self._newest(batch_id - 1)
        # The source is read once; everything below reads this copy.
        batch = number_arrivals(batch, self.arrival[0]) if self.numbered else batch
        found = Observation()
        self.input.write(batch.observe(found, F.expr("max(unix_millis(ts)) AS newest"), F.expr("count(1) AS n")), batch_id)
        seen = found.get
        rows = self.input.read_batches([batch_id]).drop("batch_id")
        after = max((t for t in (before, seen.get("newest")) if t is not None), default=None)

        pages = LatePages(rows, self.arrival, self.spec, self.lateness, self.limits, before, seen.get("n") or 0)
        requests = pages.requests.persist()
        try:
            self.late.write(pages.late_rows(), batch_id)
            found = Observation()
            ends = [F.expr(f"{f}(CASE WHEN lo <= {LATE_TO} THEN {at} END) AS {f}") for f, at in (("min", "lo"), ("max", LATE_TO))]
            self.spans.write(pages.spans().observe(found, *ends), batch_id)
        finally:
            requests.unpersist()
        fired = self._passed(self.lateness.disorder_ms, after)
        late = found.get
        lowest, highest = late.get("min"), late.get("max")
        revised = None if lowest is None else self._revised(batch_id, lowest, highest)
        rankings = self._ranking(self._passed(self.lateness.disorder_ms, before), fired, revised)
        if fired is None:
            rankings = rankings.where("false")
        # The last write of the batch: with it the clock moves on.
        self.rankings.write(rankings, batch_id, after)

    def finish(self) -> None:
        """Fire the windows that are pending at the end of the input.

        These rankings are provisional: if more input follows, they are withdrawn with its first batch.
        """
        last = self.rankings.manifest().last
        fired = self._passed(self.lateness.disorder_ms, self._newest(last))
        self.rankings.write_provisional(self._ranking(fired, None), last)

    def counts(self) -> DataFrame:
        """Requests per (URL, window) so far: ``first_count`` for its firing, ``view_count`` with those after it."""
        spans = self.spans.read().groupBy("url", "lo_first", "lo", "hi").agg(F.sum("n").alias("n"))
        return span_measures(spans, ["url"], self.spec, FIRINGS)

    def first_ranking(self) -> DataFrame:
        return self.rankings.read().where("revision = 0").select("window_end", "rank", "url", "view_count")

    def current_ranking(self) -> DataFrame:
        """Each window's ranking as of its last revision."""
        newest = Window.partitionBy("window_end")
        return (
            self.rankings.read()
            .withColumn("newest", F.max("revision").over(newest))
            .where(F.col("revision") == F.col("newest"))
            .select("window_end", "rank", "url", "view_count")
        )

    def reports(self, labels: tuple[str, str]) -> DataFrame:
        """(window_end, revision, report) of every firing so far."""
        return ranking_report(self.rankings.read(), "url", labels, keys=("window_end", "revision"))
