"""Out-of-order rows: first firing, allowed lateness, and the late side output.

A row's lateness depends on the newest event time among the rows that arrived before it
(all rows, before any filter). With ``M`` that running maximum and ``E`` a window end, the
row counts in the window's first result if ``M < E + disorder``, in its revised result if
``M < E + disorder + lateness``, and is late if it is too late for the last of its windows.

``M`` is a running maximum over the whole input in arrival order, but the rows are not sorted
for it. ``RunningMax.marks`` reduces the input to when each stretch of event time first showed
up in each stretch of arrival time. That table's size follows the time covered, not the
rows, and it holds all there is to know about ``M`` up to a chosen granularity. Rows then
look their value up. As sizes and delays are multiples of the slide, knowing ``M`` to the
slide is exact for counting.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from functools import cached_property
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tidemark.functions.integers import floor_div, floor_div_sql
from tidemark.functions.timing import MINUTE_MS, SECOND_MS, epoch_ms
from tidemark.operators.counts import HOT_PAGE_WINDOWS, page_requests_only
from tidemark.operators.topn import top_n
from tidemark.operators.windows import Sliding, pane_of_sql, span_counts, span_measures
from tidemark.session import materialize, shuffle_partitions

# Arrival time per bucket. Narrower means fewer steps to compare per row, wider fewer buckets.
BUCKET_MS = MINUTE_MS
# Buckets per block of the two-level running maximum over buckets.
BLOCK = 4096
# Largest table of steps to broadcast, at some 50 bytes a step, and most steps to compare per row.
BROADCAST_STEPS = 1_000_000
BROADCAST_STEPS_PER_BUCKET = 256
# Rows of one arrival bucket per task when the lookup has to shuffle.
ROWS_PER_TASK = 4_000_000
# Rows of a small input for each task that sorts them.
SORTED_PER_TASK = 50_000
# What is counted per (URL, window), and the column of a span in which that begins.
FIRINGS = {"first_count": "lo_first", "view_count": "lo"}


@dataclass(frozen=True)
class Lateness:
    """Disorder the watermark waits for, and how long a window stays open after firing."""

    disorder_ms: int = 5 * SECOND_MS
    allowed_ms: int = MINUTE_MS

    @property
    def closing_ms(self) -> int:
        return self.disorder_ms + self.allowed_ms


@dataclass(frozen=True)
class LookupLimits:
    """When steps may be broadcast, and how finely a busy bucket is split when they are not."""

    steps: int = BROADCAST_STEPS
    steps_per_bucket: int = BROADCAST_STEPS_PER_BUCKET
    rows_per_task: int = ROWS_PER_TASK
    sorted_per_task: int = SORTED_PER_TASK


class RunningMax:
    """Newest event time among the rows that arrived before a row.

    ``arrival`` names the columns whose ascending order is the arrival order, a LONG epoch
    in milliseconds first; together they must be unique. ``granularity_ms`` is the precision
    of the result, which is rounded down to a multiple of it. ``at_most``, where it is known, is
    the number of rows: of an input that fits a task nothing is written or counted to look for skew, its
    rows are sorted by bucket (``timed``).
    """

    def __init__(
        self,
        rows: DataFrame,
        arrival: list[str],
        granularity_ms: int,
        ts: str = "ts",
        bucket_ms: int = BUCKET_MS,
        limits: LookupLimits = LookupLimits(),
        at_most: int | None = None,
    ) -> None:
        self.rows = rows
        self.arrival = arrival
        self.granularity_ms = granularity_ms
        self.ts = ts
        self.bucket_ms = bucket_ms
        self.limits = limits
        self.at_most = at_most
        self.small = at_most is not None and at_most <= limits.rows_per_task

    def _bucket(self) -> Column:
        return floor_div(F.col(self.arrival[0]), self.bucket_ms)

    def _order(self) -> Column:
        """The arrival columns as one value in the same order.

        Two LONGs are packed into one number. A minimum of numbers is kept in a hash table,
        that of a struct takes a sort of all rows.
        """
        columns = [F.col(c) for c in self.arrival]
        if len(columns) == 1:
            return columns[0]
        if len(columns) > 2 or any(self.rows.schema[c].dataType != LongType() for c in self.arrival):
            return F.struct(*columns)
        upper, lower = (c.cast("decimal(20,0)") for c in columns)
        return (upper * F.lit(Decimal(2**64)) + (lower + F.lit(Decimal(2**63)))).cast("decimal(38,0)")

    @cached_property
    def marks(self) -> DataFrame:
        """First arrival of each event-time cell per arrival bucket, and the rows it stands for.

        Read several times, so it is written out once.
        """
        marks = (
            self.rows.where(F.col(self.ts).isNotNull())
            .groupBy(
                self._bucket().alias("bucket"),
                floor_div(epoch_ms(F.col(self.ts)), self.granularity_ms).alias("cell"),
            )
            .agg(F.min(self._order()).alias("seen"), F.count("*").alias("n"))
        )
        return marks if self.small else materialize(marks, "arrival-marks")

    @cached_property
    def buckets(self) -> DataFrame:
        """Per arrival bucket ``carry``, the newest cell of all earlier buckets.

        The running maximum over buckets is taken within blocks and over blocks. Only the
        latter meets in one task, with one row per ``BLOCK`` buckets that hold any rows.
        """
        per_bucket = self.marks.groupBy("bucket").agg(F.max("cell").alias("top"))
        blocked = per_bucket.withColumn("block", floor_div(F.col("bucket"), BLOCK))
        earlier = (Window.unboundedPreceding, -1)
        over_blocks = Window.orderBy("block").rowsBetween(*earlier)
        blocks = (
            blocked.groupBy("block")
            .agg(F.max("top").alias("top"))
            .select("block", F.max("top").over(over_blocks).alias("before"))
        )
        in_block = Window.partitionBy("block").orderBy("bucket").rowsBetween(*earlier)
        return (
            blocked.withColumn("within", F.max("top").over(in_block))
            .join(blocks, "block")
            .select("bucket", F.greatest("within", "before").alias("carry"))
        )

    @cached_property
    def steps(self) -> DataFrame:
        """Where the running maximum rises: per bucket, when (``seen``) and to what (``cell``).

        What earlier buckets reached stands in each bucket as a step with a null arrival.
        """
        in_bucket = Window.partitionBy("bucket").orderBy("seen").rowsBetween(Window.unboundedPreceding, -1)
        rising = (
            self.marks.join(self.buckets.select("bucket", "carry"), "bucket")
            .withColumn("reached", F.greatest(F.max("cell").over(in_bucket), "carry"))
            .where(F.col("reached").isNull() | (F.col("cell") > F.col("reached")))
            .select("bucket", "seen", "cell")
        )
        carried = self.buckets.where(F.col("carry").isNotNull()).select(
            "bucket", F.lit(None).cast(rising.schema["seen"].dataType).alias("seen"), F.col("carry").alias("cell")
        )
        return materialize(rising.unionByName(carried), "arrival-steps")

    def _steps_are_few(self) -> bool:
        size = (
            self.steps.groupBy("bucket")
            .agg(F.count("*").alias("steps"))
            .agg(F.sum("steps").alias("all"), F.max("steps").alias("widest"))
            .first()
        )
        return (size["all"] or 0) <= self.limits.steps and (size["widest"] or 0) <= self.limits.steps_per_bucket

    def attach(self, rows: DataFrame, name: str = "running_max_ms") -> DataFrame:
        """Add the running maximum to ``rows``, any part of those it was built from.

        Null for a row before which nothing arrived.
        """
        found = self._look_up_broadcast(rows) if self._steps_are_few() else self._look_up_sorted(rows)
        return found.withColumn(name, F.col("__cell") * self.granularity_ms).drop("__cell")

    def timed(self, name: str = "running_max_ms") -> DataFrame:
        """All rows with the exact running maximum, if they are ``small``: no bucket is more than a task sorts.

        A running maximum in each bucket, and what earlier buckets reached, a row for each of these. Rows
        of the same arrival do not see each other.
        """
        arrival, earlier = ", ".join(f"`{c}`" for c in self.arrival), "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
        value, nothing = f"unix_millis(`{self.ts}`)", f"{-(2**63) + 1}L"
        tasks = min(shuffle_partitions(self.rows.sparkSession), 1 + self.at_most // self.limits.sorted_per_task)
        rows = self.rows.selectExpr("*", f"{floor_div_sql(f'`{self.arrival[0]}`', self.bucket_ms)} AS __bucket")
        carried = (
            rows.where("__bucket IS NOT NULL")
            .groupBy("__bucket")
            .agg(F.expr(f"max({value}) AS top"))
            .selectExpr("__bucket", f"max(top) OVER (ORDER BY __bucket {earlier}) AS __carry")
        )
        if self.at_most <= self.limits.steps:
            carried = F.broadcast(carried)
        within = f"max({value}) OVER (PARTITION BY __bucket ORDER BY {arrival} {earlier})"
        passed = f"min(coalesce(__within, {nothing})) OVER (PARTITION BY __bucket, {arrival})"
        return (
            rows.repartition(tasks, "__bucket")
            .selectExpr("*", f"CASE WHEN __bucket IS NOT NULL THEN {within} END AS __within")
            .selectExpr("* EXCEPT (__within)", f"{passed} AS __within")
            .join(carried, "__bucket", "left")
            .selectExpr("* EXCEPT (__bucket, __within, __carry)", f"greatest(nullif(__within, {nothing}), __carry) AS `{name}`")
        )

    def _look_up_broadcast(self, rows: DataFrame) -> DataFrame:
        """Rows stay where they are; each compares itself with the few steps of its bucket."""
        lists = self.steps.groupBy(F.col("bucket").alias("__bucket")).agg(
            F.max(F.when(F.col("seen").isNull(), F.col("cell"))).alias("__carry"),
            F.collect_list(F.when(F.col("seen").isNotNull(), F.struct("seen", "cell"))).alias("__steps"),
        )
        here = self._order()
        passed = F.array_max(F.transform(F.filter("__steps", lambda s: s["seen"] < here), lambda s: s["cell"]))
        return (
            rows.withColumn("__bucket", self._bucket())
            .join(F.broadcast(lists), "__bucket", "left")
            .withColumn("__cell", F.greatest("__carry", passed))
            .drop("__bucket", "__carry", "__steps")
        )

    def _look_up_sorted(self, rows: DataFrame) -> DataFrame:
        """Rows and steps are merged in arrival order, per bucket and slice of it.

        A row needs the steps but no other row. So a bucket with many rows is cut into
        slices of bounded size, each with its own copy of the bucket's steps.
        """
        columns = rows.columns
        # Busy buckets only: at most one entry per ``rows_per_task`` rows of the input.
        slices = F.broadcast(
            self.marks.groupBy(F.col("bucket").alias("__bucket"))
            .agg(F.sum("n").alias("rows"))
            .where(F.col("rows") > self.limits.rows_per_task)
            .select("__bucket", F.ceil(F.col("rows") / self.limits.rows_per_task).cast("bigint").alias("__slices"))
        )
        numbered = (
            rows.withColumn("__bucket", self._bucket())
            .withColumn("__order", self._order())
            .join(slices, "__bucket", "left")
            .withColumn(
                "__slice", F.coalesce(F.pmod(F.xxhash64(*self.arrival), F.col("__slices")), F.lit(0).cast("bigint"))
            )
            .select(*columns, "__bucket", "__slice", "__order", F.lit(None).cast("bigint").alias("__step"))
        )
        copies = (
            self.steps.select(
                F.col("bucket").alias("__bucket"), F.col("seen").alias("__order"), F.col("cell").alias("__step")
            )
            .join(slices, "__bucket", "left")
            .withColumn("__slice", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("__slices", F.lit(1)) - 1)))
            .drop("__slices")
        )
        # What was carried in has a null arrival and comes first. The row a step was taken
        # from has the same arrival and must not see it.
        in_order = (
            Window.partitionBy("__bucket", "__slice")
            .orderBy(F.asc_nulls_first("__order"), F.asc_nulls_first("__step"))
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        return (
            numbered.unionByName(copies, allowMissingColumns=True)
            .withColumn("__cell", F.max("__step").over(in_order))
            .where(F.col("__step").isNull())
            .select(*columns, "__cell")
        )

    def sharpen(self, rows: DataFrame, name: str = "running_max_ms") -> DataFrame:
        """Replace the attached, rounded maximum by the exact one; for the few rows that need it.

        The rounded value names the stretch of event time the exact one lies in. That holds at
        most ``granularity_ms`` different values, and of those only the ones that arrived before
        every larger one, so each list is short however many rows are behind it. A stretch that
        many rows ask for is cut into slices of bounded size, each with its own copy of the list.
        """
        rows = rows.withColumn("__cell", floor_div(F.col(name), self.granularity_ms))
        value = epoch_ms(F.col(self.ts))
        larger = Window.partitionBy("__cell").orderBy(F.desc("at")).rowsBetween(Window.unboundedPreceding, -1)
        lists = (
            self.rows.where(F.col(self.ts).isNotNull())
            .groupBy(value.alias("at"))
            .agg(F.min(self._order()).alias("seen"))
            .withColumn("__cell", floor_div(F.col("at"), self.granularity_ms))
            .withColumn("before", F.min("seen").over(larger))
            .where(F.col("before").isNull() | (F.col("seen") < F.col("before")))
            .groupBy("__cell")
            .agg(F.collect_list(F.struct("seen", "at")).alias("__marks"))
        )
        here = self._order()
        passed = F.array_max(F.transform(F.filter("__marks", lambda m: m["seen"] < here), lambda m: m["at"]))
        if self.small:
            return rows.join(lists, "__cell", "left").withColumn(name, passed).drop("__cell", "__marks")
        rows = materialize(rows, "late-rows")
        # Busy stretches only: at most one entry per ``rows_per_task`` of the rows.
        slices = F.broadcast(
            rows.groupBy("__cell")
            .agg(F.count("*").alias("n"))
            .where(F.col("n") > self.limits.rows_per_task)
            .select("__cell", F.ceil(F.col("n") / self.limits.rows_per_task).cast("bigint").alias("__slices"))
        )
        zero = F.lit(0).cast("bigint")
        copies = lists.join(slices, "__cell", "left").withColumn(
            "__slice", F.explode(F.sequence(zero, F.coalesce("__slices", F.lit(1)) - 1))
        )
        return (
            rows.join(slices, "__cell", "left")
            .withColumn("__slice", F.coalesce(F.pmod(F.xxhash64(*self.arrival), F.col("__slices")), zero))
            .drop("__slices")
            .join(copies.drop("__slices"), ["__cell", "__slice"], "left")
            .withColumn(name, passed)
            .drop("__cell", "__slice", "__marks")
        )


class LatePages:
    """Page counts over disordered access-log rows, with first and final results and late rows.

    ``before_ms`` is the newest event time among rows that came before all of ``log``, if any did;
    ``at_most`` the number of rows, if it is known.
    """

    def __init__(
        self,
        log: DataFrame,
        arrival: list[str],
        spec: Sliding = HOT_PAGE_WINDOWS,
        lateness: Lateness = Lateness(),
        limits: LookupLimits = LookupLimits(),
        before_ms: int | None = None,
        at_most: int | None = None,
    ) -> None:
        self.log = log
        self.arrival = arrival
        self.spec = spec
        self.lateness = lateness
        self.limits = limits
        self.before_ms = before_ms
        self.at_most = at_most

    @property
    def granularity_ms(self) -> int:
        """Coarsest precision of the running maximum that leaves every comparison exact."""
        return gcd(self.spec.pane_ms, self.lateness.disorder_ms, self.lateness.allowed_ms)

    @cached_property
    def clock(self) -> RunningMax:
        return RunningMax(self.log, self.arrival, self.granularity_ms, limits=self.limits, at_most=self.at_most)

    @cached_property
    def requests(self) -> DataFrame:
        """Page requests with ``running_max_ms``, to the granularity above or, of a small log, exact."""
        if self.clock.small:
            return self._with_before(page_requests_only(self.clock.timed()).where(F.col("ts").isNotNull()))
        attached = self.clock.attach(page_requests_only(self.log).where(F.col("ts").isNotNull()))
        return self._with_before(attached, self.granularity_ms)

    def _with_before(self, timed: DataFrame, granularity_ms: int = 1) -> DataFrame:
        if self.before_ms is None:
            return timed
        rounded = self.before_ms // granularity_ms * granularity_ms
        return timed.withColumn("running_max_ms", F.greatest("running_max_ms", F.lit(rounded).cast("bigint")))

    def _first_open(self, grace_ms: int) -> str:
        """Index of the first of a row's windows that still takes it, with ``grace_ms`` to wait after its end, as SQL.

        One past the row's last window if none does.
        """
        spec, pane = self.spec, pane_of_sql("ts", self.spec)
        open_from = f"greatest({spec.first_start_sql(pane)}, {spec.first_start_ending_after_sql(f'running_max_ms - {grace_ms}')})"
        return f"least({open_from}, {self._last} + 1)"

    @property
    def _last(self) -> str:
        return self.spec.last_start_sql(pane_of_sql("ts", self.spec))

    def _counts(self, grace_ms: int) -> DataFrame:
        """Lateness only shortens a row's span of windows from the left."""
        spans = (
            self.requests.selectExpr("url", f"{self._first_open(grace_ms)} AS lo", f"{self._last} AS hi")
            .groupBy("url", "lo", "hi")
            .agg(F.count("*").alias("n"))
        )
        return span_counts(spans, ["url"], self.spec)

    def spans(self) -> DataFrame:
        """Requests by URL and the windows that take them: those from ``lo_first`` to ``hi`` in the first result,
        those from ``lo`` in the revised one. Requests that no window takes are left out."""
        return (
            self.requests.selectExpr(
                "url",
                f"{self._first_open(self.lateness.disorder_ms)} AS lo_first",
                f"{self._first_open(self.lateness.closing_ms)} AS lo",
                f"{self._last} AS hi",
            )
            .where("lo <= hi")
            .groupBy("url", "lo_first", "lo", "hi")
            .agg(F.count("*").alias("n"))
        )

    def firings(self) -> DataFrame:
        """Per (URL, window) the requests of the first result and of the revised one, in one pass."""
        return span_measures(self.spans(), ["url"], self.spec, FIRINGS)

    def first_counts(self) -> DataFrame:
        """Requests per (URL, window) known when the window first fires."""
        return self._counts(self.lateness.disorder_ms)

    def final_counts(self) -> DataFrame:
        """Requests per (URL, window) including those within the allowed lateness."""
        return self._counts(self.lateness.closing_ms)

    def first_ranking(self, n: int = 3) -> DataFrame:
        return top_n(self.first_counts(), n, "url")

    def final_ranking(self, n: int = 3) -> DataFrame:
        """The ranking after the last revision, over the complete counts."""
        return top_n(self.final_counts(), n, "url")

    def late_rows(self) -> DataFrame:
        """Requests too late for every window they belong to, with the exact running maximum."""
        first = self.spec.first_start_sql(pane_of_sql("ts", self.spec))
        late = self.requests.where(
            f"{first} <= {self._last} AND {self._first_open(self.lateness.closing_ms)} > {self._last}"
        )
        return late if self.clock.small else self._with_before(self.clock.sharpen(late))
