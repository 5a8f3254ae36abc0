"""Quality rules: counts within a text, and the frequency of its lines across documents.

Lines are normalised and hashed. For each host the documents that contain a line are counted,
equal texts as one document; lines above the host's limit are boilerplate and are removed. A
document that loses most of its words is rejected, as is one that fails the rules on its own text.
An empty table gives an empty result; columns other than doc_id, text and the host's are kept as
they are by ``keep`` and not looked at otherwise.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.base import map_batches, rolled, ship, table, word_hashes, words_of
from tidemark.session import materialize

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
MIN_WORDS = 50
#: A line is boilerplate in more documents of a host than this, and than this share of them.
LINE_DOCUMENTS = 20
LINE_SHARE = 0.01
#: A document is depleted if fewer than this share of its words is left.
MIN_LEFT = 0.3

_digits = re.compile("[0-9]+")

MEASURES = (
    "doc_id bigint, host string, text_hash bigint, n_words bigint, word_chars bigint, n_symbols bigint, "
    "n_dup_lines bigint, n_repeat_words bigint, lines array<bigint>, line_words array<bigint>"
)


def repeat_words(hashes: np.ndarray, size: int = 3) -> int:
    """Words that lie in a window of ``size`` words found twice or more."""
    windows = rolled(hashes, size)
    if not len(windows):
        return 0
    _, where, counts = np.unique(windows, return_inverse=True, return_counts=True)
    starts = counts[where] > 1
    if not starts.any():
        return 0
    covered = np.zeros(len(hashes), bool)
    for k in range(size):
        covered[k : k + len(starts)] |= starts
    return int(covered.sum())


def normal(line: str) -> bytes:
    """Lines that differ in digits, capitals or white space alone are one line."""
    return " ".join(_digits.sub("0", line.lower()).split()).encode("utf-8", "surrogatepass")


def measure(rows: dict) -> dict:
    out = {k: [] for k in (c.split()[0] for c in MEASURES.split(", "))}
    line_hashes = {"lines": [], "counts": []}
    for doc_id, host, text in zip(rows["doc_id"], rows["host"], rows["text"]):
        text = text or ""
        words = words_of(text)
        lines = [x for x in text.split("\n") if x.strip(SPACES)]
        out["doc_id"].append(doc_id)
        out["host"].append(host)
        out["n_words"].append(len(words))
        out["word_chars"].append(len(text) - sum(map(text.count, SPACES)))
        out["n_symbols"].append(sum(map(text.count, SYMBOLS)))
        out["n_dup_lines"].append(len(lines) - len(set(lines)))
        out["n_repeat_words"].append(repeat_words(word_hashes(words)))
        counted = {}
        for line in lines:
            key = normal(line)
            counted[key] = counted.get(key, 0) + len(words_of(line))
        line_hashes["lines"].extend(counted)
        out["lines"].append(len(counted))
        out["line_words"].append(list(counted.values()))
    every = word_hashes(line_hashes["lines"]).view(np.int64)
    ends = np.cumsum([0, *out["lines"]])
    out["lines"] = [every[a:b] for a, b in zip(ends, ends[1:])]
    out["text_hash"] = rows["text_hash"]
    return out


def frequent_lines(measured: DataFrame, documents: int, share: float) -> DataFrame:
    """(host, line) above the limit of the host.

    Documents are distinct texts, both those of a line and those of the host, so copies of one
    text change neither. The distinct (host, line, text) are counted in two steps, each combined
    before its shuffle, so that neither a busy host nor a common line gathers in one task.
    """
    sizes = measured.select("host", "text_hash").distinct().groupBy("host").agg(F.count("*").alias("host_documents"))
    seen = measured.select("host", "text_hash", F.explode("lines").alias("line")).distinct()
    counts = seen.groupBy("host", "line").agg(F.count("*").alias("documents")).where(F.col("documents") > documents)
    return (
        counts.join(sizes, counts["host"].eqNullSafe(sizes["host"]))
        .where(F.col("documents") > share * F.col("host_documents"))
        .select(counts["host"], "line")
    )


def judge(
    docs: DataFrame, host: str, documents: int, share: float, min_left: float
) -> tuple[DataFrame, DataFrame]:
    """(judged, removed): a row for each row of ``docs``, and by ``uid`` the lines that it loses."""
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col(host).cast("string").alias("host"), "text", F.xxhash64("text").alias("text_hash"))
    measured = materialize(
        map_batches(rows, measure, MEASURES).withColumn("uid", F.monotonically_increasing_id()), "measures"
    )
    frequent = materialize(frequent_lines(measured, documents, share), "lines")
    lines = measured.select("uid", "host", F.explode(F.arrays_zip("lines", "line_words")).alias("x")).select(
        "uid", "host", F.col("x.lines").alias("line"), F.col("x.line_words").alias("words")
    )
    lost = lines.join(frequent, (lines["line"] == frequent["line"]) & lines["host"].eqNullSafe(frequent["host"]), "left_semi")
    removed = lost.groupBy("uid").agg(F.sum("words").alias("removed_words"), F.collect_set("line").alias("gone"))
    judged = measured.drop("lines", "line_words").join(removed.drop("gone"), "uid", "left")
    left = F.col("n_words") - F.coalesce("removed_words", F.lit(0))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = judged.withColumns(
        {"base_failed": failed, "kept": ~failed & (left >= min_left * F.col("n_words")), "removed_words": F.coalesce("removed_words", F.lit(0)).cast("bigint")}
    )
    return judged, removed.select("uid", "gone")


def assess(
    docs: DataFrame,
    host: str = "source",
    documents: int = LINE_DOCUMENTS,
    share: float = LINE_SHARE,
    min_left: float = MIN_LEFT,
) -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` for every row.

    A null text counts as empty and fails for its length; rows without a host form a host of
    their own; repeated rows are judged each, and count as one document of a line.
    """
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words"]
    return judge(docs, host, documents, share, min_left)[0].select(*columns, "host", "text_hash")


def without_lines(text: str, gone: set[int]) -> str:
    """``text`` without the lines whose normal form has one of these hashes."""
    lines = text.split("\n")
    hashes = word_hashes([normal(line) for line in lines]).view(np.int64).tolist()
    return "\n".join(line for line, h in zip(lines, hashes) if h not in gone or not line.strip(SPACES))


def keep(
    docs: DataFrame,
    host: str = "source",
    documents: int = LINE_DOCUMENTS,
    share: float = LINE_SHARE,
    min_left: float = MIN_LEFT,
) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns and their text without boilerplate lines.

    ``n_chars``, if there is one, is that of the new text. Rows with the same doc_id, host and text
    have the same verdict, so it is looked up by these; only verdicts that change a row are.
    """
    judged, removed = judge(docs, host, documents, share, min_left)
    changed = judged.join(removed, "uid", "left").where(~F.col("kept") | F.col("gone").isNotNull())
    verdicts = changed.select(
        F.col("doc_id").alias("__d"), F.col("host").alias("__h"), F.col("text_hash").alias("__t"),
        F.col("kept").alias("__kept"), F.array_sort("gone").alias("__gone"),
    ).dropDuplicates(["__d", "__h", "__t"])
    verdicts = materialize(verdicts, "verdicts")
    named = docs.where(F.length("text") > 0)  # without a text no row is kept
    joined = named.join(
        verdicts,
        named["doc_id"].cast("bigint").eqNullSafe(verdicts["__d"])
        & (F.xxhash64(named["text"]) == verdicts["__t"])
        & named[host].cast("string").eqNullSafe(verdicts["__h"]),
        "left",
    ).where(F.coalesce("__kept", F.lit(True))).select(*[named[c] for c in docs.columns], "__gone")
    ship(docs.sparkSession)
    names = docs.columns

    def strip(batches):
        for batch in batches:
            gone = batch.column("__gone")
            at = batch.schema.get_field_index("text")
            batch = batch.select(names)
            if gone.null_count < len(gone):
                pairs = zip(batch.column(at).to_pylist(), gone.to_pylist())
                texts = [t if g is None else without_lines(t, set(g)) for t, g in pairs]
                batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
            yield batch

    kept = joined.mapInArrow(strip, docs.schema)
    if "n_chars" in docs.columns:
        # A null stays null, as for a text that has not changed.
        length = F.when(F.col("n_chars").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType)
        kept = kept.withColumn("n_chars", length)
    return kept


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assess(table(spark, sf_dir, "documents")).drop("host", "text_hash")
