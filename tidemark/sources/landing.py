"""Writing rows as files that a file stream takes in a given order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.integers import floor_div
from tidemark.session import shuffle_partitions
from tidemark.streaming.files import SharedFolder

# Time of the first file; the others follow by one second each.
FIRST_FILE_MS = 1_700_000_000_000


def land_in_order(rows: DataFrame, order: str, out: str, files: int, fmt: str = "parquet") -> str:
    """Write ``rows`` as one file for each stretch of the LONG column ``order``, sorted by it.

    The stretches are equally long; text files get the column ``value`` alone. A file stream goes by the time files were finished, which a
    parallel write leaves to chance; so the files get times in the order of their stretches.
    """
    spark = rows.sparkSession
    low, high = rows.agg(F.min(order), F.max(order)).first()
    low, span = low or 0, (high or 0) - (low or 0) + 1
    width = max(1, -(-span // files))
    slots = rows.withColumn("slot", floor_div(F.col(order) - low, width))
    dealt = slots.repartition(max(files, shuffle_partitions(spark)), "slot").sortWithinPartitions("slot", order)
    if fmt == "text":
        dealt = dealt.select("value", "slot")
    dealt.write.partitionBy("slot").format(fmt).save(out)
    folder = SharedFolder(spark, out)
    for name in folder.files(""):
        slot = int(name.split("/")[0].removeprefix("slot="))
        folder.set_time(name, FIRST_FILE_MS + 1000 * slot)
    return out
