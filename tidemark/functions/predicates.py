"""Row predicates of the click-stream, web-log and marketing jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The extensions that mark a request as a static asset.
STATIC_EXTENSIONS = ("css", "js", "png", "ico")


def is_page_view(behavior: Column) -> Column:
    """True for ``pv``; a null behaviour does not pass."""
    return behavior == F.lit("pv")


def is_get(method: Column) -> Column:
    return method == F.lit("GET")


def is_page_url(url: Column) -> Column:
    """False for a URL that ends in a static-asset extension (case-sensitive, no query)."""
    return ~url.rlike(r"\.(" + "|".join(STATIC_EXTENSIONS) + r")$")


def is_not_uninstall(behavior: Column) -> Column:
    """True for everything but UNINSTALL; a null behaviour passes."""
    return ~behavior.eqNullSafe(F.lit("UNINSTALL"))
