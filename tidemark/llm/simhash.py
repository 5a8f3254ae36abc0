"""SimHash near-duplicates with pivot distance tables.

A fingerprint is the bitwise majority of a document's shingle hashes. Two fingerprints link when
they differ in at most ``RADIUS`` bits. By the triangle inequality the distances of two linked
fingerprints to any third one differ by no more than that. So the distances to many reference
fingerprints (pivots) are tabulated first; a pair is discarded as soon as one coordinate of
the two table rows differs by more, and only pairs that survive all coordinates are verified.

Which pairs meet at all: of the eight bytes of linked fingerprints at least six are equal, so both
are in one of the 28 groups that agree on some six bytes. A group has two free bytes and thus
never more than 65,536 distinct fingerprints, however many documents there are. Equal
fingerprints are one row from the start.

Rows without a text or words have fingerprint zero and link like others. A row without a doc_id
gets its fingerprint, links with nothing and has a null component. Rows of one doc_id are one
node, with every fingerprint they have. Other columns of the input are not looked at; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.base import lower_words_of, map_batches, mixed, ship, table
from tidemark.llm.jaccard import components
from tidemark.session import materialize

SHINGLE = 3
SEED = 42
#: Fingerprints link at this many differing bits or fewer. The 28 groups are made for two.
RADIUS = 2
PIVOTS = 32
#: Shingles whose bits are counted at a time, pairs looked at a time, rows of groups taken at a time.
SHINGLES, PAIRS, ROWS = 1 << 16, 1 << 21, 1 << 18
#: A fingerprint of more than this share of all rows is looked up without a shuffle; there are
#: never more than the inverse of it.
HOT_SHARE = 1 / 256


def fingerprint(text: str | None) -> int:
    """Bits set in over half of the XXH64 hashes of the shingles, as a signed 64-bit integer."""
    words = lower_words_of(text)
    if not words:
        return 0
    size = min(SHINGLE, len(words))
    n = len(words) - size + 1
    ones = np.zeros(64, np.int64)
    for start in range(0, n, SHINGLES):
        part = words[start : start + SHINGLES + size - 1]
        runs = map(b" ".join, zip(*(part[k:] for k in range(size))))
        hashes = np.array([xxhash.xxh64_intdigest(run, SEED) for run in runs], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every row."""

    def run(rows: dict) -> dict:
        return {"doc_id": rows["doc_id"], "fp": [fingerprint(t) for t in rows["text"]]}

    return map_batches(docs.select(F.col("doc_id").cast("bigint"), "text"), run, "doc_id bigint, fp bigint")


def pivots(number: int) -> np.ndarray:
    """Reference fingerprints: the same on every machine, about half of the bits set in each."""
    return mixed(mixed(np.arange(1, number + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)))


def distance_table(fp: np.ndarray, references: np.ndarray) -> np.ndarray:
    """One row of distances for each reference."""
    return np.stack([np.bitwise_count(fp ^ r) for r in references]).astype(np.int8)


def surviving_pairs(group: np.ndarray, fp: np.ndarray, references: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the verified pairs of each group, some at a time.

    Groups are sorted by the first coordinate, where a row's partners are the next few. The
    other coordinates thin these out one after the other.
    """
    distances = distance_table(fp, references)
    order = np.lexsort((distances[0], group))
    group, fp, distances = group[order], fp[order], distances[:, order]
    place = group * 128 + distances[0]
    first = np.arange(1, len(fp) + 1)
    ends = np.cumsum(np.searchsorted(place, place + RADIUS, "right") - first)
    row = 0
    while row < len(fp):
        done = ends[row - 1] if row else 0
        until = max(row + 1, int(np.searchsorted(ends, done + PAIRS, "right")))
        counts = np.diff(ends[row:until], prepend=done)
        a = np.repeat(np.arange(row, until), counts)
        b = np.arange(len(a)) - np.repeat(np.cumsum(counts) - counts, counts) + a + 1
        for coordinate in distances[1:]:
            near = np.abs(coordinate[a] - coordinate[b]) <= RADIUS
            a, b = a[near], b[near]
        verified = np.bitwise_count(fp[a] ^ fp[b]) <= RADIUS
        yield order[a[verified]], order[b[verified]]
        row = until


def group_links(group: np.ndarray, fp: np.ndarray, first: np.ndarray, references: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what the verified pairs connect, at most one for each row."""
    sizes = np.bincount(group)
    shared = sizes[group] > 1
    group, fp, first = group[shared], fp[shared], first[shared]
    if not len(fp):
        return first, first
    found = list(surviving_pairs(group, fp, references))
    a, b = (np.concatenate(side) for side in zip(*found))
    smallest = first.copy()
    while True:
        least = np.minimum(smallest[a], smallest[b])
        moved = smallest.copy()
        np.minimum.at(moved, a, least)
        np.minimum.at(moved, b, least)
        if np.array_equal(moved, smallest):
            break
        smallest = moved
    joined = smallest != first
    return first[joined], smallest[joined]


def links(classes: DataFrame, n_pivots: int = PIVOTS) -> DataFrame:
    """(a, b): ``first`` of linked rows of ``classes`` (fp, first), enough to connect all that link."""
    ship(classes.sparkSession)
    masks = [
        sum(0xFF << 8 * k for k in range(8) if k not in free) for free in combinations(range(8), RADIUS)
    ]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    dealt = classes.select(
        "fp", "first", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in signed])).alias("mask", "kept")
    )
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        references = pivots(n_pivots)
        rest, size = [], 0

        def linked(mask, kept, fp, first):
            new = np.ones(len(fp), bool)
            new[1:] = (mask[1:] != mask[:-1]) | (kept[1:] != kept[:-1])
            return group_links(np.cumsum(new) - 1, fp.view(np.uint64), first, references)

        def batch_of(pair):
            return pa.RecordBatch.from_arrays([pa.array(pair[0]), pa.array(pair[1])], schema=schema)

        for batch in batches:
            rest.append([batch.column(name).to_numpy() for name in ("mask", "kept", "fp", "first")])
            size += batch.num_rows
            if size < ROWS:
                continue
            columns = [np.concatenate(c) for c in zip(*rest)]
            # The last group may go on in the next batch.
            other = (columns[0] != columns[0][-1]) | (columns[1] != columns[1][-1])
            cut = int(np.flatnonzero(other)[-1]) + 1 if other.any() else 0
            if cut:
                yield batch_of(linked(*(c[:cut] for c in columns)))
            rest, size = [[c[cut:] for c in columns]], len(columns[0]) - cut
        if size:
            yield batch_of(linked(*(np.concatenate(c) for c in zip(*rest))))

    return dealt.repartition("mask", "kept").sortWithinPartitions("mask", "kept").mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, n_pivots: int = PIVOTS) -> DataFrame:
    """(doc_id, fp, component_id) for every row."""
    marked = materialize(fingerprints(docs), "fingerprints")
    named = marked.where(F.col("doc_id").isNotNull())
    classes = materialize(named.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("size")), "classes")
    # Rows of one doc_id with several fingerprints link these.
    several = named.groupBy("doc_id").agg(F.min("fp").alias("least"), F.max("fp").alias("most")).where("least <> most")
    firsts = classes.select("fp", "first")
    same = (
        named.distinct().join(several.select("doc_id"), "doc_id").join(firsts, "fp").select(F.col("first").alias("a"), F.col("doc_id").alias("b"))
    )
    edges = links(firsts, n_pivots).unionByName(same).where("a <> b")
    found = materialize(components(edges), "components")
    answers = classes.join(found, classes["first"] == found["node"], "left").select(
        "fp", F.coalesce("component", "first").alias("component_id"), "size"
    )
    answers = materialize(answers, "class-components")
    total = classes.agg(F.sum("size")).first()[0] or 0
    often = F.col("size") > total * HOT_SHARE
    hot = answers.where(often).select("fp", F.col("component_id").alias("hot_id"))
    rest = answers.where(~often).select("fp", F.col("component_id").alias("rest_id"))
    # Rows of a frequent fingerprint have their answer from the broadcast and no key in the shuffle.
    placed = marked.join(F.broadcast(hot), "fp", "left").withColumn("key", F.when(F.col("hot_id").isNull(), F.col("fp")))
    return placed.join(rest.withColumnRenamed("fp", "key"), "key", "left").select(
        "doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.coalesce("hot_id", "rest_id")).alias("component_id")
    )


def op11_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
