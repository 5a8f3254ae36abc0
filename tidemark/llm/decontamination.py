"""Benchmark decontamination by winnowing.

Of the hashed k-grams of a text the minimum of each window of w consecutive ones is kept as a
fingerprint; a span of k + w - 1 words shared by two texts yields a shared fingerprint for sure.
Documents and benchmark items that share one are candidates, and there the hits are extended:
their full windows are compared, and all words they cover counted. Only DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.base import table
from tidemark.session import materialize

SPAN = 13
#: A document is contaminated if at least one in so many of its words is hit.
HIT_SHARE = 20

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def split_words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), BETWEEN_WORDS, -1), lambda w: w != "")


def small_letters(text: Column) -> Column:
    return F.translate(text, CAPITALS, SMALL)


def fingerprints(hashes: Column, span: int) -> Column:
    """Winnowed hashes of an array of word hashes that has ``span`` words or more; else none."""
    k = (span + 1) // 2
    w = span - k + 1
    none = F.expr("cast(array() as array<bigint>)")

    def grams(h: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(h) - k), lambda i: F.xxhash64(F.lit(span), *(F.get(h, i + j) for j in range(k)))
        )

    def minima(g: Column) -> Column:
        if w == 1:
            return F.array_distinct(g)
        return F.array_distinct(
            F.transform(F.sequence(F.lit(0), F.size(g) - w), lambda i: F.least(*(F.get(g, i + j) for j in range(w))))
        )

    return let(hashes, lambda h: F.when(F.size(h) >= span, let(grams(h), minima)).otherwise(none))


def fingerprinted(texts: DataFrame, spans: list[int]) -> DataFrame:
    """``texts`` with n_words and the fingerprints for each of ``spans``, and without its text.

    Words are hashed in lower case of all scripts; that can only add candidates.
    """
    hashes = F.transform(split_words(F.col("text")), lambda w: F.xxhash64(F.lower(w)))
    found = let(
        hashes,
        lambda h: F.struct(F.size(h).cast("bigint").alias("n"), F.flatten(F.array(*(fingerprints(h, s) for s in spans))).alias("marks")),
    )
    return texts.withColumn("found", found).select(
        *(c for c in texts.columns if c != "text"), F.col("found.n").alias("n_words"), F.col("found.marks").alias("marks")
    )


def windows(texts: DataFrame, spans: Column) -> DataFrame:
    """Each window of the lengths in ``spans``, as (columns but text, at, span, low, high).

    The two hashes of a window's words stand for them: 128 bits.
    """
    words = split_words(small_letters(F.col("text")))
    listed = texts.select(*(c for c in texts.columns if c != "text"), words.alias("words"), F.explode(spans).alias("span"))
    grams = let(
        F.col("words"),
        lambda w: F.transform(
            F.when(F.size(w) >= F.col("span"), F.sequence(F.lit(1), F.size(w) - F.col("span") + 1)),
            lambda i: let(F.array_join(F.slice(w, i, F.col("span")), " "), lambda g: F.struct(F.xxhash64(g).alias("low"), F.xxhash64(F.lit("window"), g).alias("high"))),
        ),
    )
    columns = [c for c in listed.columns if c != "words"]
    return listed.select(*columns, F.posexplode(grams).alias("at", "g")).select(*columns, "at", "g.low", "g.high")


def contamination(docs: DataFrame, benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """(doc_id, text_key, n_words, n_hit, items, contaminated) for every row of ``docs``.

    A window is ``span`` consecutive words of an item; an item of fewer words is one window of
    all of them, and one without words (or null) has none. ``items`` are the item_ids with a
    window in the document, as sorted strings. Rows with the same doc_id and text have the same
    result; a null text has no words.
    """
    given = docs.select(F.col("doc_id").cast("bigint"), "text", F.xxhash64("text").alias("text_key"))
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    size = F.least(F.size(split_words(F.col("text"))), F.lit(span))
    items = materialize(items.withColumn("span", size).where(F.col("span") > 0), "items")
    spans = sorted({span, *(r[0] for r in items.select("span").distinct().collect())})

    marked = materialize(fingerprinted(given, spans), "fingerprints")
    item_marks = materialize(
        fingerprinted(items, spans).select("span", F.explode("marks").alias("mark")).distinct(), "item-fingerprints"
    )
    shared = marked.select("doc_id", "text_key", F.explode("marks").alias("mark")).join(item_marks, "mark")
    candidates = materialize(
        shared.groupBy("doc_id", "text_key").agg(F.collect_set("span").alias("spans")), "candidates"
    )

    item_windows = materialize(windows(items.select("item_id", "text", F.col("span").alias("size")), F.array("size")).select("item_id", "span", "low", "high").distinct(), "item-windows")
    same = given["doc_id"].eqNullSafe(candidates["doc_id"]) & (given["text_key"] == candidates["text_key"])
    suspects = given.join(candidates, same).select(given["doc_id"], given["text_key"], "text", "spans")
    hits = (
        windows(suspects, F.col("spans"))
        .select("doc_id", "text_key", "span", "at", "low", "high")
        .join(item_windows, ["span", "low", "high"])
        .groupBy("doc_id", "text_key")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_set(F.sequence(F.col("at"), F.col("at") + F.col("span") - 1))))).cast("bigint").alias("n_hit"),
            F.array_sort(F.collect_set("item_id")).alias("items"),
        )
    )
    hits = hits.select(F.col("doc_id").alias("d"), F.col("text_key").alias("t"), "n_hit", "items")
    found = marked.drop("marks").join(
        hits, marked["doc_id"].eqNullSafe(hits["d"]) & (marked["text_key"] == hits["t"]), "left"
    )
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return found.select(
        "doc_id", "text_key", "n_words", n_hit.alias("n_hit"),
        F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"),
        ((n_hit > 0) & (HIT_SHARE * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    found = contamination(docs, benchmark).where("contaminated").select(F.col("doc_id").alias("d"), F.col("text_key").alias("t")).distinct()
    bad = materialize(found, "contaminated")
    return docs.join(bad, docs["doc_id"].cast("bigint").eqNullSafe(bad["d"]) & (F.xxhash64(docs["text"]) == bad["t"]), "left_anti")


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS uid,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM documents
), i AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, least(len(words), 13) AS span,
    array_to_string(words[p : p + least(len(words), 13) - 1], ' ') AS gram
  FROM (SELECT *, unnest(range(1, len(words) - least(len(words), 13) + 2)) AS p FROM i WHERE len(words) > 0)
), dw AS (
  SELECT uid, p, span, array_to_string(words[p : p + span - 1], ' ') AS gram
  FROM (SELECT uid, words, span, unnest(range(1, len(words) - span + 2)) AS p
        FROM d, (SELECT DISTINCT span FROM iw) WHERE len(words) >= span)
), h AS (SELECT uid, p, dw.span AS span, item_id FROM dw JOIN iw USING (gram) WHERE dw.span = iw.span
), c AS (
  SELECT uid, count(DISTINCT w) AS n_hit FROM (SELECT uid, unnest(range(p, p + span)) AS w FROM h) GROUP BY uid
), n AS (
  SELECT uid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT uid, item_id FROM h) GROUP BY uid
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM d LEFT JOIN c USING (uid) LEFT JOIN n USING (uid)
"""
