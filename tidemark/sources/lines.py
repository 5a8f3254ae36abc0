"""Text line scans, and what happens to lines that do not parse."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import configure

# Lines end with a newline alone; a carriage return before it is not part of the line.
_LINE_END = {"lineSep": "\n"}


def _trimmed(lines: DataFrame) -> DataFrame:
    return lines.select(F.regexp_replace("value", "\r\\z", "").alias("value"))


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line, in the column ``value``."""
    return _trimmed(configure(spark).read.options(**_LINE_END).text(path))


# Columns that order the lines of a set of files as they came in: by the time a file was
# finished, then its path, then the place in it.
ARRIVAL = ["arrived_ms", "file", "block", "line_in_block"]


def _place() -> list[Column]:
    return [
        F.unix_millis("_metadata.file_modification_time").alias("arrived_ms"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    ]


def read_arriving_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with the :data:`ARRIVAL` columns.

    A block of a file is read by one task, in order, so the id Spark gives rows orders its lines.
    The ids hold within one read only: write the result out before using it twice.
    """
    lines = configure(spark).read.options(**_LINE_END).text(path)
    return lines.select(
        F.regexp_replace("value", "\r\\z", "").alias("value"),
        *_place(),
        F.monotonically_increasing_id().alias("line_in_block"),
    )


def stream_lines(spark: SparkSession, path: str, max_files: int | None = None, arrival: bool = False) -> DataFrame:
    """Lines of the files that appear in a folder, with ``arrival`` also the file and block they stand in."""
    reader = configure(spark).readStream.options(**_LINE_END).option("recursiveFileLookup", True)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.text(path)
    value = F.regexp_replace("value", "\r\\z", "").alias("value")
    return lines.select(value, *_place()) if arrival else lines.select(value)


def number_arrivals(rows: DataFrame, name: str = "arrival") -> DataFrame:
    """Number the rows of a batch of files in the order their lines came in.

    Blocks are numbered by the time their file was finished, its path and their place in it; a
    block is read by one task, in order. Write the result out before using it twice.
    """
    place = ARRIVAL[:3]
    in_block = F.pmod(F.monotonically_increasing_id(), F.lit(1 << 33))
    blocks = rows.select(*place).distinct().withColumn("__block", F.row_number().over(Window.orderBy(*place)))
    return (
        rows.withColumn("__line", in_block)
        .join(blocks, place)
        .withColumn(name, F.col("__block").cast("bigint") * F.lit(1 << 33) + F.col("__line"))
        .drop(*place, "__block", "__line")
    )


@dataclass(frozen=True)
class Parsed:
    """Well-formed records, and the lines set aside with the reason (``line``, ``reason``)."""

    records: DataFrame
    rejects: DataFrame


def failfast(parsed: DataFrame, columns: list[str]) -> DataFrame:
    """Records of ``parsed``; the job fails on the first line with a ``reason``.

    The check is a filter, since Catalyst would prune a column nobody selects.
    """
    complaint = F.concat(F.lit("malformed line ("), F.col("reason"), F.lit("): "), F.col("line"))
    return parsed.where(F.when(F.col("reason").isNull(), F.lit(True)).otherwise(_fail(complaint))).select(*columns)


def _fail(message: Column) -> Column:
    return F.raise_error(message).cast("boolean")


def quarantine(parsed: DataFrame, columns: list[str]) -> Parsed:
    bad = F.col("reason").isNotNull()
    return Parsed(parsed.where(~bad).select(*columns), parsed.where(bad).select("line", "reason"))


def first_reason(*checks: tuple[Column, str]) -> Column:
    """The text of the first check that holds, null if none does."""
    return F.coalesce(*[F.when(failed, F.lit(text)) for failed, text in checks])
