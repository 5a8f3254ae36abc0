"""Importance resampling towards a target distribution, with segment deduplication.

Hashed n-gram features of the corpus and of a target are counted by bucket; a document's weight is
the mean log ratio of its features, and adding Gumbel noise that depends on its doc_id alone
turns the highest scores into a sample without replacement.

Features are never counted text by text. Newlines, which separate words, cut texts into lines;
a block of texts has each distinct line once, with its occurrences. The features inside a line are
computed once and multiplied by these; n-grams that run from one line into the next are added
separately. Blocks end at a number of bytes, so memory is bounded, and what leaves a task is one
count for each bucket: lines that repeat across tasks cost a second computation there, not a
shuffle of the corpus.

A null or empty text has no words and weight 0. A row without a doc_id is weighed, but has no
score and takes no part in the draw. Repeated rows are drawn each for itself. Other columns of
the input are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from array import array
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.integers import floor_div
from tidemark.llm.base import ship, table
from tidemark.session import materialize

BUCKETS = 10_000
#: Percentage of the eligible documents that is drawn, and words that make a document eligible.
PERCENT = 25
MIN_WORDS = 20
SEED = 7
#: Bytes of text in a block.
BLOCK_BYTES = 8 << 20
#: Scores in a block of the running count over all scores.
SCORES = 256

# A-Z in lower case; what is not of a word becomes a blank, but for the newline.
_KEPT = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_WORDS = bytes(
    c if c in _KEPT or c == 0x0A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256)
)


class Block:
    """The distinct lines of some texts: features of each, and where each occurs."""

    def __init__(self, buckets: int, limit: int = BLOCK_BYTES) -> None:
        self.buckets, self.limit = buckets, limit
        self.ids: dict[bytes, int] = {}
        self.features, self.ends = array("q"), array("q", [0])
        self.words = array("q")
        # For n-grams across lines: the first word, and the hash of the last word and a blank.
        self.first: list[bytes] = []
        self.last = array("q")
        self.line, self.line_row = array("q"), array("q")
        self.across, self.across_row = array("q"), array("q")
        self.rows, self.bytes = 0, 0

    def _new_line(self, words: list[bytes]) -> None:
        hashes = [crc32(w) for w in words]
        open_ = [crc32(b" ", h) for h in hashes]
        self.features.extend(hashes)
        self.features.extend([crc32(w, h) for w, h in zip(words[1:], open_)])
        self.ends.append(len(self.features))
        self.words.append(len(words))
        self.first.append(words[0])
        self.last.append(open_[-1])

    def add(self, text: str | None) -> None:
        before = -1
        data = text.encode("utf-8", "surrogatepass").translate(_WORDS) if text else b""
        for line in data.split(b"\n"):
            at = self.ids.get(line)
            if at is None:
                words = line.split()
                at = self.ids[line] = len(self.first) if words else -1
                if words:
                    self._new_line(words)
            if at < 0:
                continue
            self.line.append(at)
            self.line_row.append(self.rows)
            if before >= 0:
                self.across.append(crc32(self.first[at], self.last[before]))
                self.across_row.append(self.rows)
            before = at
        self.rows += 1
        self.bytes += len(data)

    @property
    def full(self) -> bool:
        return self.bytes >= self.limit

    def _inside(self) -> np.ndarray:
        return np.frombuffer(self.features, np.int64) % self.buckets if len(self.features) else np.empty(0, np.int64)

    def counts(self) -> np.ndarray:
        """Features of all texts by bucket."""
        times = np.bincount(self.line, minlength=len(self.words))
        total = np.zeros(self.buckets, np.int64)
        np.add.at(total, self._inside(), np.repeat(times, np.diff(self.ends)))
        return total + np.bincount(np.array(self.across) % self.buckets, minlength=self.buckets)

    def sums(self, gains: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(words, features, sum of their gains) of each text."""
        running = np.concatenate([[0], np.cumsum(gains[self._inside()])])
        line_gain = np.diff(running[np.array(self.ends)])
        line, row = np.array(self.line), np.array(self.line_row)
        words, features, gain = (np.zeros(self.rows, np.int64) for _ in range(3))
        np.add.at(words, row, np.array(self.words)[line])
        np.add.at(features, row, np.diff(self.ends)[line])
        np.add.at(gain, row, line_gain[line])
        np.add.at(features, np.array(self.across_row), 1)
        np.add.at(gain, np.array(self.across_row), gains[np.array(self.across) % self.buckets])
        return words, features, gain


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(bucket, n): occurrences of the features of all rows' ``text``; buckets without any are left out."""
    ship(texts.sparkSession)
    schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])

    def run(batches):
        total, block = np.zeros(buckets, np.int64), Block(buckets, block_bytes)
        for batch in batches:
            for text in batch.column(0):
                block.add(text.as_py())
                if block.full:
                    total += block.counts()
                    block = Block(buckets, block_bytes)
        total += block.counts()
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held])], schema=schema)

    parts = texts.select("text").mapInArrow(run, "bucket int, n bigint")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, block_bytes: int = BLOCK_BYTES) -> np.ndarray:
    """floor(1000 ln) of the smoothed ratio of target to corpus, by bucket. As many numbers as buckets."""

    def counted(texts: DataFrame) -> list[float]:
        held = dict(bucket_counts(texts, buckets, block_bytes).collect())
        return [held.get(b, 0) for b in range(buckets)]

    s, t = counted(docs), counted(target)
    over, under = float(sum(s) + buckets), float(sum(t) + buckets)
    return np.array([math.floor(1000 * math.log((float(y) + 1) * over / ((float(x) + 1) * under))) for x, y in zip(s, t)], np.int64)


def noise(doc_id: int, seed: int) -> int:
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(
    docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, seed: int = SEED, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row."""
    spark = docs.sparkSession
    ship(spark)
    gains = spark.sparkContext.broadcast(bucket_gains(docs, target, buckets, block_bytes))
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "n_words", "n_features", "weight", "score")])

    def run(batches):
        block, ids = Block(buckets, block_bytes), []

        def weighed() -> pa.RecordBatch:
            words, features, gain = block.sums(gains.value)
            weight = gain // np.maximum(features, 1)
            scores = [None if i is None else int(w) + noise(i, seed) for i, w in zip(ids, weight)]
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(words), pa.array(features), pa.array(weight), pa.array(scores, pa.int64())], schema=schema
            )

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                block.add(text.as_py())
                ids.append(doc_id.as_py())
                if block.full:
                    yield weighed()
                    block, ids = Block(buckets, block_bytes), []
        yield weighed()

    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    return rows.mapInArrow(run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint")


def draw(scored: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """``scored`` (doc_id, n_words, n_features, weight, score) with the ``rank`` of the drawn rows, null for others.

    No task sorts all scores. They are counted by value (a score is a few ten thousand at most,
    whatever the corpus), running counts over the values give each value its first rank, and
    only rows of the same score are put in order.
    """
    able = scored.where((F.col("n_words") >= min_words) & F.col("score").isNotNull())
    by_score = able.groupBy("score").agg(F.count("*").alias("n")).withColumn("block", floor_div(F.col("score"), SCORES))
    by_score = materialize(by_score, "score-counts")
    drawn = int(by_score.agg(F.sum("n")).first()[0] or 0) * percent // 100
    higher = (Window.unboundedPreceding, -1)
    over_blocks = Window.orderBy(F.desc("block")).rowsBetween(*higher)
    blocks = (
        by_score.groupBy("block")
        .agg(F.sum("n").alias("n"))
        .select("block", F.coalesce(F.sum("n").over(over_blocks), F.lit(0)).alias("above"))
    )
    in_block = Window.partitionBy("block").orderBy(F.desc("score")).rowsBetween(*higher)
    starts = (
        by_score.withColumn("within", F.coalesce(F.sum("n").over(in_block), F.lit(0)))
        .join(blocks, "block")
        .select("score", (F.col("above") + F.col("within")).alias("before"))
        .where(F.col("before") < drawn)
    )
    starts = materialize(starts, "score-ranks")
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    ties = Window.partitionBy("score").orderBy("doc_id", "n_features", "weight")
    ranked = able.join(starts, "score").withColumn("rank", F.col("before") + F.row_number().over(ties)).select(
        *columns, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")
    )
    # ``starts`` has every score from the lowest one up that is drawn at all.
    lowest = starts.agg(F.min("score")).first()[0]
    out = F.col("score").isNull() | (F.col("n_words") < min_words) | (F.lit(True) if lowest is None else F.col("score") < lowest)
    return ranked.unionByName(scored.where(out).select(*columns, F.lit(None).cast("bigint").alias("rank")))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row; ``rank`` is null for those not drawn."""
    return draw(materialize(weigh(docs, target, buckets, seed, block_bytes), "scores"), percent, min_words)


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("n_words")
