"""Top-N per window and its text report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Groups a window's keys are split into before the final ranking, where Spark itself
# does not cut the rows per task (see ``top_n``).
SPLITS = 256


def top_n(
    counts: DataFrame,
    n: int,
    key: str,
    count: str = "view_count",
    window: str = "window_end",
    keys: tuple[str, ...] | None = None,
) -> DataFrame:
    """The ``n`` keys with the highest count in each window; ties go to the smaller key.

    ``keys``, the window among them, tells rankings of one window apart.

    With the rank limit written this way Spark plans a group limit below the exchange:
    every task sends at most ``n`` rows per window. It does so up to a threshold only;
    above it the same is done by hand, ranking within slices of the keys first.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    keys = keys or (window,)
    order = [F.desc(count), F.asc(key)]
    threshold = int(counts.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n > threshold:
        sliced = counts.withColumn("slice", F.pmod(F.xxhash64(key), F.lit(SPLITS)))
        place = F.row_number().over(Window.partitionBy(*keys, "slice").orderBy(*order))
        counts = sliced.withColumn("place", place).where(F.col("place") <= n).drop("slice", "place")
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return (
        counts.withColumn("rank", rank)
        .where(F.col("rank") <= n)
        .select(*keys, F.col("rank").cast("bigint").alias("rank"), key, count)
    )


def clock_text(window_end: Column) -> Column:
    """Session-zone time with at least one and no needless fraction digits."""
    text = F.date_format(F.timestamp_millis(window_end), "yyyy-MM-dd HH:mm:ss.SSS")
    return F.regexp_replace(text, r"(\.\d+?)0+$", "$1")


# The report's rulers and labels.
OPENING_RULER = "==============\n"
CLOSING_RULER = "===============================\n\n"
END_LABEL = "Endtime："
RANK_LABEL = "NO "
ITEM_LABELS = (": 商品ID = ", " 热门度 = ")
PAGE_LABELS = (": URL = ", " Page View = ")


def ranking_report(
    ranking: DataFrame,
    key: str,
    labels: tuple[str, str],
    count: str = "view_count",
    window: str = "window_end",
    keys: tuple[str, ...] | None = None,
) -> DataFrame:
    """One text per window of a ``top_n`` result, whose size ``n`` bounds each list.

    ``keys``, the window among them, tells rankings of one window apart.
    """
    keys = keys or (window,)
    key_label, count_label = labels
    line = F.concat(
        F.lit(RANK_LABEL),
        F.col("rank").cast("string"),
        F.lit(key_label),
        F.col(key).cast("string"),
        F.lit(count_label),
        F.col(count).cast("string"),
        F.lit("\n"),
    )
    listed = ranking.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("rank", line.alias("line")))).alias("lines"))
    return listed.select(
        *keys,
        F.concat(
            F.lit(OPENING_RULER),
            F.lit(END_LABEL),
            clock_text(F.col(window)),
            F.lit("\n"),
            F.array_join(F.col("lines.line"), ""),
            F.lit(CLOSING_RULER),
        ).alias("report"),
    )
