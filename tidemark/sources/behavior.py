"""User-behaviour lines: ``user,item,category,behaviour,epoch seconds``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.parsing import field, split_lines, strict_integer
from tidemark.functions.timing import from_epoch_seconds
from tidemark.schemas import USER_BEHAVIOR
from tidemark.sources.lines import Parsed, failfast, first_reason, quarantine, read_lines, stream_lines

COLUMNS = USER_BEHAVIOR.fieldNames()


def parse(lines: DataFrame) -> DataFrame:
    """Record columns plus ``line`` and ``reason``, which is null for a well-formed line."""
    split = split_lines(lines, ",")
    typed = split.select(
        "line",
        (F.size("f") < 5).alias("short"),
        strict_integer(field(F.col("f"), 0), "bigint").alias("user_id"),
        strict_integer(field(F.col("f"), 1), "bigint").alias("item_id"),
        strict_integer(field(F.col("f"), 2), "int").alias("category_id"),
        field(F.col("f"), 3).alias("behavior"),
        strict_integer(field(F.col("f"), 4), "bigint").alias("seconds"),
    )
    # Beyond this a timestamp does not fit 64-bit microseconds.
    in_range = F.col("seconds").between(-9_223_372_036_854, 9_223_372_036_854)
    return typed.select(
        "user_id",
        "item_id",
        "category_id",
        "behavior",
        F.when(in_range, from_epoch_seconds(F.col("seconds"))).alias("ts"),
        "line",
        first_reason(
            (F.col("short"), "too few fields"),
            (F.col("user_id").isNull(), "user_id"),
            (F.col("item_id").isNull(), "item_id"),
            (F.col("category_id").isNull(), "category_id"),
            (F.col("seconds").isNull() | ~in_range, "timestamp"),
        ).alias("reason"),
    )


def records(lines: DataFrame, mode: str = "failfast") -> DataFrame | Parsed:
    """``failfast`` gives records or fails the job, ``quarantine`` a :class:`Parsed`."""
    if mode == "failfast":
        return failfast(parse(lines), COLUMNS)
    if mode == "quarantine":
        return quarantine(parse(lines), COLUMNS)
    raise ValueError(f"unknown mode {mode!r}")


def read_behavior(spark: SparkSession, path: str | list[str], mode: str = "failfast") -> DataFrame | Parsed:
    return records(read_lines(spark, path), mode)


def stream_behavior(
    spark: SparkSession, path: str, mode: str = "failfast", max_files: int | None = None
) -> DataFrame | Parsed:
    return records(stream_lines(spark, path, max_files), mode)
