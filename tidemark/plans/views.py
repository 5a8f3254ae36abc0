"""The three record streams, derived from the ``events`` table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import configure

# Channels and behaviours of a marketing event.
CHANNELS = ("app store", "weibo", "wechat", "tieba")
MARKETING_BEHAVIORS = {
    "click": "CLICK",
    "view": "DOWNLOAD",
    "purchase": "INSTALL",
    "signup": "INSTALL",
    "error": "UNINSTALL",
}
URL_SUFFIXES = (".css", ".js", ".png", ".ico", ".css?x=1", ".CSS", ".html", "")


def _pick(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def event_columns(events: DataFrame) -> DataFrame:
    """``events`` with ``ts`` as an instant and ``k`` taken out of ``props``."""
    return events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        "event_type",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )


EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return configure(spark).read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_columns(raw_events(spark, sf_dir))


def as_behavior(e: DataFrame) -> DataFrame:
    return e.select(
        "user_id",
        F.col("k").alias("item_id"),
        (F.col("k") % 10).cast("int").alias("category_id"),
        F.when(F.col("event_type") == "view", F.lit("pv")).otherwise(F.col("event_type")).alias("behavior"),
        "ts",
    )


def access_log_fields() -> list[Column]:
    kind, k = F.col("event_type"), F.col("k")
    return [
        F.concat(F.lit("10.0.0."), (F.col("user_id") % 256).cast("string")).alias("ip"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("ts"),
        F.when(kind.isin("purchase", "signup"), F.lit("POST")).otherwise(F.lit("GET")).alias("method"),
        F.concat(F.lit("/"), kind, F.lit("/"), k.cast("string"), _pick(URL_SUFFIXES, k % 8)).alias("url"),
    ]


def as_access_log(e: DataFrame) -> DataFrame:
    return e.select(*access_log_fields())


def as_arrivals(e: DataFrame) -> DataFrame:
    """Access-log rows in a disordered arrival: each is delayed by 0 to 30 minutes."""
    delay = (F.col("event_id") * 7919) % 1801 * 1000
    return e.select("event_id", (F.unix_millis("ts") + delay).alias("arrival_key"), *access_log_fields())


def as_marketing(e: DataFrame) -> DataFrame:
    behavior = F.element_at(
        F.create_map(*[F.lit(v) for pair in MARKETING_BEHAVIORS.items() for v in pair]), F.col("event_type")
    )
    return e.select("user_id", behavior.alias("behavior"), _pick(CHANNELS, F.col("k") % 4).alias("channel"), "ts")


def behavior_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_behavior(events(spark, sf_dir))


def access_log_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_access_log(events(spark, sf_dir))


def arrival_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_arrivals(events(spark, sf_dir))


def marketing_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_marketing(events(spark, sf_dir))


def behavior_lines(b: DataFrame, *others: str) -> DataFrame:
    """Behaviour records written out as text lines, with columns to keep beside them."""
    return b.select(
        *others,
        F.concat_ws(
            ",",
            F.col("user_id").cast("string"),
            F.col("item_id").cast("string"),
            F.col("category_id").cast("string"),
            "behavior",
            F.unix_seconds("ts").cast("string"),
        ).alias("value")
    )


def access_log_lines(log: DataFrame, *others: str) -> DataFrame:
    """Access-log records written out as text lines, likewise."""
    time = F.date_format("ts", "dd/MM/yyyy:HH:mm:ss")
    return log.select(
        *others, F.concat_ws(" ", "ip", "user_id", F.lit("-"), time, F.lit("+0000"), "method", "url").alias("value")
    )


def marketing_records(m: DataFrame) -> DataFrame:
    """Marketing events as they are stored, with their time in epoch milliseconds."""
    return m.select("user_id", "behavior", "channel", F.unix_millis("ts").alias("timestamp"))


def damaged_lines(e: DataFrame) -> DataFrame:
    """Behaviour lines of every event, damaged in a way that changes from one to the next.

    In turn: a field missing, no number, a blank before the number, a number too large, an
    empty line, a field too many (harmless), an empty last field, undamaged.
    """
    user, item = F.col("user_id").cast("string"), F.col("k").cast("string")
    seconds = F.unix_seconds("ts").cast("string")
    variants = (
        F.concat_ws(",", user, item, F.lit("1"), "event_type"),
        F.concat_ws(",", F.concat(F.lit("x"), user), item, F.lit("1"), "event_type", seconds),
        F.concat_ws(",", user, F.concat(F.lit(" "), item), F.lit("1"), "event_type", seconds),
        F.concat_ws(",", user, item, F.lit("2147483648"), "event_type", seconds),
        F.lit(""),
        F.concat_ws(",", user, item, F.lit("1"), "event_type", seconds, F.lit("EXTRA")),
        F.concat_ws(",", user, item, F.lit("1"), "event_type", F.lit("")),
        F.concat_ws(",", user, item, F.lit("1"), "event_type", seconds),
    )
    return e.select(F.element_at(F.array(*variants), (F.col("event_id") % 8 + 1).cast("int")).alias("value"))


def damaged_log_lines(e: DataFrame) -> DataFrame:
    """Access-log lines of every event, damaged likewise.

    In turn: an empty URL, no such day, junk after the time, no time, undamaged.
    """
    def line(time, url) -> Column:
        return F.concat_ws(
            " ", F.lit("10.0.0.1"), F.col("user_id").cast("string"), F.lit("-"), time, F.lit("+0000"), F.lit("GET"), url
        )

    time = F.date_format("ts", "dd/MM/yyyy:HH:mm:ss")
    url = F.concat(F.lit("/"), "event_type")
    variants = (
        line(time, F.lit("")),
        line(F.concat(F.lit("32"), F.substring(time, 3, 18)), url),
        line(F.concat(time, F.lit("x")), url),
        line(F.lit(""), url),
        line(time, url),
    )
    return e.select(F.element_at(F.array(*variants), (F.col("event_id") % 5 + 1).cast("int")).alias("value"))
