"""Substring deduplication with a count-min prefilter.

A window is a run of consecutive words. Partition sketches of all windows are merged; they may
count too much, never too little. A second pass groups exactly those windows that the sketch
takes for repeated, by 96 bits of their words' hashes, and finds the smallest document of each.
"""

from __future__ import annotations

import zlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.base import ROLL_B, map_batches, rolled, table, word_hashes, words_of
from tidemark.llm.sketch import expected_words, repeated

WINDOW = 13
#: Windows that a task compares with each other before it sends them on.
BUFFER = 1_000_000

#: A run of ``windows`` consecutive windows of a document from ``at`` on that are removed, or, with a
#: ``leader``, that are if the window at that place of the document is. ``windows`` is 0 for a
#: window to be grouped by its hash.
OPEN = "low bigint, high int, doc_id bigint, tag int, at int, windows int, leader int"


def window_hashes(text: str | None, size: int) -> np.ndarray:
    return rolled(word_hashes(words_of(text)), size)


def runs_of(doc, tag, at, leader):
    """(doc, tag, at, windows, leader) of consecutive places, in the order of documents and places."""
    order = np.lexsort((at, leader, tag, doc))
    doc, tag, at, leader = (x[order] for x in (doc, tag, at, leader))
    breaks = np.ones(len(doc), bool)
    breaks[1:] = (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]) | (leader[1:] != leader[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(breaks)
    return doc[first], tag[first], at[first], np.diff(np.append(first, len(doc))).astype(np.int32), leader[first]


def settle(low, high, doc, tag, at) -> pa.RecordBatch:
    """Windows for the exact grouping, after those of one task are compared.

    Of the documents of a task that share a window only the smallest can be the first one; for the others
    it is settled that the window is removed. So a window that is in very many documents is
    sent on once for each task, and so is one that is very often in one document: there it goes
    with the first of its places. All but these travel as runs, with their document as key.
    """
    order = np.lexsort((at, tag, doc, high, low))
    low, high, doc, tag, at = (x[order] for x in (low, high, doc, tag, at))
    new = np.ones(len(low), bool)
    new[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    settled = doc != doc[np.flatnonzero(new)][np.cumsum(new) - 1]
    leads = new.copy()
    leads[1:] |= (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])
    follows = ~leads & ~settled
    leader = np.where(follows, at[np.flatnonzero(leads)][np.cumsum(leads) - 1], -1).astype(np.int32)
    sent = settled | follows
    d, t, a, runs, led = runs_of(*(x[sent] for x in (doc, tag, at, leader)))
    rest = np.flatnonzero(~sent)
    rest = rest[np.lexsort((at[rest], doc[rest]))]  # alike values side by side take less room in a shuffle
    columns = [
        np.concatenate([x[rest], y])
        for x, y in (
            (low, d), (high, np.zeros(len(d), np.int32)), (doc, d), (tag, t), (at, a),
            (np.zeros(len(doc), np.int32), runs), (leader, led),
        )
    ]
    return pa.RecordBatch.from_arrays(
        [pa.array(x) for x in columns], names=["low", "high", "doc_id", "tag", "at", "windows", "leader"]
    )


def repeated_windows(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, tag, starts): runs (at, windows, leader) of windows that are also in a smaller document.

    Those with a leader count only if the leader is among them.
    """
    seen = repeated(docs, partial(window_hashes, size=size), expected_words(docs))

    def second_pass(batches):
        filter_, parts, rows = seen.value, [], 0
        for batch in batches:
            for doc_id, tag, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                words = word_hashes(words_of(text))
                low = rolled(words, size)
                at = np.flatnonzero(filter_(low))
                if len(at):
                    high = rolled(words, size, ROLL_B)[at] >> np.uint64(32)
                    n = len(at)
                    parts.append(
                        (low[at].view(np.int64), high.astype(np.uint32).view(np.int32), np.full(n, doc_id), np.full(n, tag, np.int32), at.astype(np.int32))
                    )
                    rows += n
                if rows >= BUFFER:
                    yield settle(*(np.concatenate(x) for x in zip(*parts)))
                    parts, rows = [], 0
        if parts:
            yield settle(*(np.concatenate(x) for x in zip(*parts)))

    windows = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "tag", "text").mapInArrow(second_pass, OPEN)
    first = F.min("doc_id").over(Window.partitionBy("low", "high"))
    removed = windows.withColumn("first", first).where((F.col("windows") > 0) | (F.col("doc_id") > F.col("first")))
    run = F.struct("at", F.greatest("windows", F.lit(1)).alias("windows"), "leader")
    return removed.groupBy("doc_id", "tag").agg(F.collect_list(run).alias("starts"))


def deduplicate(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """Every row with its words, without those in a window that also starts in a smaller document.

    (doc_id, n_words, n_removed, kept): ``kept`` has the words left, joined by one space. A null text
    has no words. Rows without a doc_id keep all words and take none from others. Rows of the
    same doc_id take nothing from each other.
    """
    given = docs.select(F.col("doc_id").cast("bigint"), "text").withColumn(
        "tag", F.pmod(F.xxhash64("text"), F.lit(1 << 30)).cast("int")
    )
    starts = repeated_windows(given, size)
    # Texts are shuffled once, compressed.
    packed = map_batches(
        given.select("doc_id", "tag", "text"),
        lambda rows: {**rows, "text": [zlib.compress((t or "").encode("utf-8", "surrogatepass"), 1) for t in rows["text"]]},
        "doc_id bigint, tag int, text binary",
    )
    joined = packed.join(starts, ["doc_id", "tag"], "left").select("doc_id", "text", "starts")

    def cut(rows: dict) -> dict:
        out = {"doc_id": rows["doc_id"], "n_words": [], "n_removed": [], "kept": []}
        for text, at in zip(rows["text"], rows["starts"]):
            words = zlib.decompress(text).split() if text else []
            gone = np.zeros(len(words) + 1, np.int64)
            if at is not None:
                alone = {r["at"] for r in at if r["leader"] < 0}
                removed = [r for r in at if r["leader"] < 0 or r["leader"] in alone]
                begin = np.array([r["at"] for r in removed], np.int64)
                np.add.at(gone, begin, 1)
                np.add.at(gone, begin + np.array([r["windows"] + size - 1 for r in removed], np.int64), -1)
            kept = [w for w, n in zip(words, np.cumsum(gone)[:-1]) if not n]
            out["n_words"].append(len(words))
            out["n_removed"].append(len(words) - len(kept))
            out["kept"].append(b" ".join(kept).decode("utf-8", "surrogatepass"))
        return out

    return map_batches(joined, cut, "doc_id bigint, n_words bigint, n_removed bigint, kept string")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = deduplicate(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS uid,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents
), w AS (
  SELECT uid, doc_id, p, array_to_string(words[p : p + 12], ' ') AS gram
  FROM (SELECT *, unnest(range(1, len(words) - 11)) AS p FROM d WHERE len(words) >= 13)
), f AS (SELECT gram, min(doc_id) AS first FROM w GROUP BY gram HAVING min(doc_id) < max(doc_id)
), r AS (
  SELECT DISTINCT uid, unnest(range(p, p + 13)) AS p FROM w JOIN f USING (gram) WHERE doc_id > first
), k AS (
  SELECT d.uid, list(x.word ORDER BY x.p) AS kept
  FROM d, LATERAL (SELECT unnest(range(1, len(d.words) + 1)) AS p, unnest(d.words) AS word) x
  LEFT JOIN r ON r.uid = d.uid AND r.p = x.p WHERE r.p IS NULL GROUP BY d.uid
)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(len(kept), 0))::BIGINT AS n_removed,
  sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256
FROM d LEFT JOIN k USING (uid)
"""
