"""Web-access-log lines, separated by single blanks.

By position: 0 address, 1 user, 3 time, 5 method, 6 URL; 2 and 4 are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.parsing import field, log_time, split_lines
from tidemark.schemas import ACCESS_LOG
from tidemark.sources.lines import (
    ARRIVAL,
    Parsed,
    failfast,
    first_reason,
    quarantine,
    read_arriving_lines,
    read_lines,
    stream_lines,
)

COLUMNS = ACCESS_LOG.fieldNames()


def parse(lines: DataFrame, zone: str = "UTC") -> DataFrame:
    """Record columns, whatever else ``lines`` carries, and ``line`` and ``reason``, which is null for a well-formed line."""
    split = split_lines(lines, " ")
    others = [c for c in split.columns if c not in ("line", "f")]
    return split.select(
        *others,
        field(F.col("f"), 0).alias("ip"),
        field(F.col("f"), 1).alias("user_id"),
        log_time(field(F.col("f"), 3), zone).alias("ts"),
        field(F.col("f"), 5).alias("method"),
        field(F.col("f"), 6).alias("url"),
        "line",
        F.size("f").alias("n_fields"),
    ).select(
        *COLUMNS,
        *others,
        "line",
        first_reason((F.col("n_fields") < 7, "too few fields"), (F.col("ts").isNull(), "time")).alias("reason"),
    )


def records(lines: DataFrame, mode: str = "failfast", zone: str = "UTC") -> DataFrame | Parsed:
    """``failfast`` gives records or fails the job, ``quarantine`` a :class:`Parsed`."""
    if mode == "failfast":
        return failfast(parse(lines, zone), COLUMNS)
    if mode == "quarantine":
        return quarantine(parse(lines, zone), COLUMNS)
    raise ValueError(f"unknown mode {mode!r}")


def read_access_log(
    spark: SparkSession, path: str | list[str], mode: str = "failfast", zone: str = "UTC"
) -> DataFrame | Parsed:
    return records(read_lines(spark, path), mode, zone)


def land_access_log(spark: SparkSession, path: str | list[str], out: str, zone: str = "UTC") -> DataFrame:
    """Write log files to a Parquet table that keeps the order the lines came in.

    What lateness is judged on: the table has the record columns and those of ``ARRIVAL``.
    """
    parsed = failfast(parse(read_arriving_lines(spark, path), zone), [*COLUMNS, *ARRIVAL])
    parsed.write.mode("overwrite").parquet(out)
    return spark.read.schema(parsed.schema).parquet(out)


def stream_access_log(
    spark: SparkSession,
    path: str,
    mode: str = "failfast",
    zone: str = "UTC",
    max_files: int | None = None,
    arrival: bool = False,
) -> DataFrame | Parsed:
    """Records as files appear; with ``arrival``, and the columns by which ``number_arrivals`` orders lines."""
    lines = stream_lines(spark, path, max_files, arrival)
    if not arrival:
        return records(lines, mode, zone)
    columns = [*COLUMNS, *ARRIVAL[:3]]
    keep = {"failfast": failfast, "quarantine": quarantine}
    if mode not in keep:
        raise ValueError(f"unknown mode {mode!r}")
    return keep[mode](parse(lines, zone), columns)
