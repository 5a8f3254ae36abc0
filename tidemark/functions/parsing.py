"""Fields and numbers of delimited text lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fields(line: Column, separator: str) -> Column:
    """The line's fields; empty ones at the end do not count."""
    return F.split(F.rtrim(line, F.lit(separator)), "[" + separator + "]")


def split_lines(lines: DataFrame, separator: str) -> DataFrame:
    """``line`` and its fields ``f``, split once per line; other columns stay.

    Catalyst copies a projected expression into every filter above it. It does not look
    behind a generator, so the split is handed on through one, as an array of one array.
    """
    others = [c for c in lines.columns if c != "value"]
    return lines.select(*others, F.col("value").alias("line"), F.explode(F.array(fields(F.col("value"), separator))).alias("f"))


def field(parts: Column, index: int) -> Column:
    """A field by position, null where the line is too short."""
    return F.get(parts, F.lit(index))


def strict_integer(text: Column, kind: str) -> Column:
    """Decimal digits with an optional sign and nothing around them; null otherwise or on overflow."""
    return F.when(text.rlike(r"^[+-]?[0-9]+\z"), text.try_cast(kind))


def log_time(text: Column, zone: str = "UTC") -> Column:
    """``dd/MM/yyyy:HH:mm:ss`` read in ``zone``; null where the text is not exactly that.

    The session zone must be UTC, so that the wall-clock time is parsed unchanged.
    """
    wall_clock = F.try_to_timestamp(text, F.lit("dd/MM/yyyy:HH:mm:ss"))
    return wall_clock if zone == "UTC" else F.to_utc_timestamp(wall_clock, zone)
