"""Whole-number arithmetic on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def floor_div(value: Column, step: int) -> Column:
    """``floor(value / step)`` on LONG, right for values below zero too."""
    return F.call_function("div", value - F.pmod(value, F.lit(step)), F.lit(step)).cast("bigint")


def floor_div_sql(value: str, step: int) -> str:
    """The same as SQL text. A plan that is built for every batch of a stream is built from text:
    each operation on a column is several calls to the JVM."""
    return f"cast((({value}) - pmod(({value}), {step})) div {step} as bigint)"
