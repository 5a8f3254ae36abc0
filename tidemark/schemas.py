"""Fixed record and result types."""

from pyspark.sql.types import (
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

USER_BEHAVIOR = StructType(
    [
        StructField("user_id", LongType()),
        StructField("item_id", LongType()),
        StructField("category_id", IntegerType()),
        StructField("behavior", StringType()),
        StructField("ts", TimestampType()),
    ]
)

ACCESS_LOG = StructType(
    [
        StructField("ip", StringType()),
        StructField("user_id", StringType()),
        StructField("ts", TimestampType()),
        StructField("method", StringType()),
        StructField("url", StringType()),
    ]
)

MARKETING_BEHAVIOR = StructType(
    [
        StructField("user_id", LongType()),
        StructField("behavior", StringType()),
        StructField("channel", StringType()),
        StructField("ts", TimestampType()),
    ]
)

# As stored by a marketing event file: the time is still an epoch in milliseconds.
MARKETING_RECORD = StructType(
    [
        StructField("user_id", LongType()),
        StructField("behavior", StringType()),
        StructField("channel", StringType()),
        StructField("timestamp", LongType()),
    ]
)

ITEM_VIEW_COUNT = StructType(
    [
        StructField("item_id", LongType()),
        StructField("window_end", LongType()),
        StructField("view_count", LongType()),
    ]
)

PAGE_VIEW_COUNT = StructType(
    [
        StructField("url", StringType()),
        StructField("window_end", LongType()),
        StructField("view_count", LongType()),
    ]
)

CHANNEL_COUNT = StructType(
    [
        StructField("channel", StringType()),
        StructField("behavior", StringType()),
        StructField("window_end", StringType()),
        StructField("count", LongType()),
    ]
)
