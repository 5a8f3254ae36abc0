"""N-gram Jaccard join by vertical partitioning.

A document's set is its distinct word shingles. The global order of the shingles is cut into
fragments, so that a set becomes short segments; the overlap of a pair is counted in each
fragment separately and summed per pair. Candidates come from prefixes in the global order,
which puts shingles of many sets last, by classes of their number.
The result is the connected components of the links, so a pair is tested only while its two
sets are in different components: groups of near copies cost one test for each member.
"""

from __future__ import annotations

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.base import lower_words_of, map_batches, mixed, rolled, table, word_hashes
from tidemark.llm.sketch import expected_words, repeated
from tidemark.session import materialize

SHINGLE = 3
#: Two sets link when 100 * intersection >= SIMILARITY * union.
SIMILARITY = 90
FRAGMENTS = 8
#: The global order knows the shingles of the most sets, at most so many of them (2 MB); where
#: more shingles are in two sets or more, the rarer ones count as alike and go by their hash.
RANKED = 250_000
#: Most sets whose ids are sent to every task (8 MB).
LISTED = 1_000_000
#: Words of 64 bits in the bitmap that goes with a prefix shingle, and in the one that judges a pair.
BITMAP = 8
WIDE = 32
#: Sets of a shingle that are tested against all others in the first round; four times as many each round.
PIVOTS = 16


def shingles(text: str | None) -> np.ndarray:
    """Hashes of the distinct shingles; a text of fewer words is one shingle of its own length."""
    words = word_hashes(lower_words_of(text))
    if not len(words):
        return words
    size = min(SHINGLE, len(words))
    return np.unique(rolled(words + np.uint64(size), size))


def bitmap(members: np.ndarray, size: int = BITMAP) -> np.ndarray:
    """The parity of the members at each place, by hash; sets that differ in k bits differ in k members at least.

    Members of both sets cancel out, so what two bitmaps tell does not fade with the sets' sizes, only
    with the number of members in which they differ.
    """
    places = (mixed(members) % np.uint64(size * 64)).astype(np.int64)
    odd = np.bincount(places, minlength=size * 64) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def bits_of(column: str, size: int) -> F.Column:
    return F.struct(*[F.col(column)[k].alias(f"b{k}") for k in range(size)]).alias("bits")


def near(x: str, y: str, similarity: int, size: int = BITMAP) -> F.Column:
    """Whether two sets can link by their sizes and bitmaps, in columns with the suffixes ``x``, ``y``.

    Linked sets differ in at most (100 - similarity) / (100 + similarity) of the sum of their
    sizes, so no link is lost. Sets pass that may differ in more members than half a bitmap's bits.
    """
    n, m = F.col("n" + x), F.col("n" + y)
    differ = sum((F.bit_count(F.col(f"bits{x}.b{k}").bitwiseXOR(F.col(f"bits{y}.b{k}"))) for k in range(size)), F.lit(0))
    sizes = 100 * F.least(n, m) >= similarity * F.greatest(n, m)
    return sizes & ((100 + similarity) * differ <= (100 - similarity) * (n + m))


def shingle_sets(docs: DataFrame, similarity: int) -> DataFrame:
    """(doc_id, n, low, high, bitmap, shingles): the set's size, its 128-bit digest, and its members.

    Members are given only for sets that can have a link: the shingles that are in no other
    document must be few enough. A sketch over all documents tells those that are certainly in no other.
    """
    seen = repeated(docs, shingles, expected_words(docs))

    def run(rows: dict) -> dict:
        filter_ = seen.value
        out = {"doc_id": rows["doc_id"], "n": [], "low": [], "high": [], "bitmap": [], "shingles": []}
        for text in rows["text"]:
            s = shingles(text)
            alone = len(s) - int(filter_(s).sum())
            linked = len(s) and 100 * (len(s) - alone) >= similarity * len(s)
            out["n"].append(len(s))
            out["low"].append(int(mixed(s).sum(dtype=np.uint64).view(np.int64)) if linked else None)
            out["high"].append(int(mixed(~s).sum(dtype=np.uint64).view(np.int64)) if linked else None)
            out["bitmap"].append(bitmap(s) if linked else None)
            out["shingles"].append(s.view(np.int64) if linked else None)
        return out

    columns = docs.select("doc_id", "text")
    schema = "doc_id bigint, n bigint, low bigint, high bigint, bitmap array<bigint>, shingles array<bigint>"
    return map_batches(columns, run, schema)


def rarity(sets: DataFrame, limit: int = RANKED) -> Broadcast:
    """(shingles in ascending order, their classes): 1 + log2 of the number of sets, for the most frequent ones.

    Any order of the shingles gives the same links; this one makes prefixes rare. Classes are
    taken in from the most frequent one down, as long as the table stays within ``limit``.
    """
    counts = sets.select(F.explode("shingles").alias("s")).groupBy("s").agg(F.count("*").alias("sets")).where("sets > 1")
    classed = materialize(counts.select("s", F.floor(F.log2("sets")).cast("byte").alias("class")), "shingle-classes")
    sizes = {r["class"]: r["n"] for r in classed.groupBy("class").agg(F.count("*").alias("n")).collect()}
    lowest, total = 127, 0
    for k in sorted(sizes, reverse=True):
        total += sizes[k]
        if total > limit:
            break
        lowest = k
    # At most ``limit`` rows, whatever the corpus.
    held = classed.where(F.col("class") >= lowest).toArrow()
    members, classes = held["s"].to_numpy(), held["class"].to_numpy()
    order = np.argsort(members)
    return sets.sparkSession.sparkContext.broadcast((members[order], classes[order]))


def in_order(members: np.ndarray, known: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(classes, members) by class and hash, the global order."""
    shingles_, classes = known
    at = np.searchsorted(shingles_, members)
    at[at == len(shingles_)] = 0
    found = np.zeros(len(members), np.int8)
    if len(shingles_):
        hit = shingles_[at] == members
        found[hit] = classes[at[hit]]
    order = np.lexsort((members, found))
    return found[order], members[order]


def segments(sets: DataFrame, fragments: int, similarity: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(segments, wide bitmaps, prefixes): the sets cut by fragments of the global order, and their prefixes.

    Half of the fragments are ranges of hashes of the rare shingles, half of those in a class.
    A set's prefix is so long that two linked sets share a member of their prefixes.
    """
    order = rarity(sets)
    width = 2**64 // (fragments // 2)

    def run(rows: dict) -> dict:
        out = {k: [] for k in ("doc_id", "n", "bitmap", "wide", "prefix", "cut")}
        for doc_id, n, bits, members in zip(*(rows[k] for k in ("doc_id", "n", "bitmap", "shingles"))):
            classes, ranked = in_order(np.array(members, np.int64), order.value)
            out["doc_id"].append(doc_id)
            out["n"].append(n)
            out["bitmap"].append(bits)
            out["wide"].append(bitmap(np.array(members, np.int64).view(np.uint64), WIDE))
            out["prefix"].append(ranked[: n - -(-similarity * n // 100) + 1])
            place = np.minimum((ranked.view(np.uint64) // np.uint64(width)).astype(np.int64), fragments // 2 - 1)
            place += np.where(classes > 0, fragments // 2, 0)
            at = np.argsort(place, kind="stable")
            ends = np.searchsorted(place[at], np.arange(fragments + 1))
            out["cut"].append([ranked[at][a:b].tolist() for a, b in zip(ends, ends[1:])])
        return out

    schema = "doc_id bigint, n bigint, bitmap array<bigint>, wide array<bigint>, prefix array<bigint>, cut array<array<bigint>>"
    ordered = materialize(map_batches(sets.select("doc_id", "n", "bitmap", "shingles"), run, schema), "ordered-sets")
    cut = ordered.select("doc_id", F.posexplode("cut").alias("fragment", "segment")).where(F.size("segment") > 0)
    bits = ordered.select("doc_id", bits_of("bitmap", BITMAP))
    wide = ordered.select("doc_id", "n", bits_of("wide", WIDE))
    prefixes = ordered.select("doc_id", "n", F.explode("prefix").alias("s"))
    # Most prefix shingles are in one set only; the others get the set's bitmap.
    shared = prefixes.groupBy("s").agg(F.count("*").alias("sets")).where("sets > 1")
    return cut, wide, prefixes.join(shared, "s").join(bits, "doc_id")


def links(pairs: DataFrame, cut: DataFrame, wide: DataFrame, similarity: int) -> DataFrame:
    """Those of ``pairs`` (a, b, na, nb) that link: overlaps by fragment, summed per pair.

    Pairs whose wide bitmaps differ too much leave before their segments are sent.
    """
    for side in ("a", "b"):
        its = wide.select(F.col("doc_id").alias(side), F.col("n").alias(f"n{side}"), F.col("bits").alias(f"bits{side}"))
        pairs = pairs.join(its, [side, f"n{side}"])
    pairs = materialize(pairs.where(near("a", "b", similarity, WIDE)).select("a", "b", "na", "nb"), "pairs")
    needed = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    # Sets of no pair are not shuffled, as long as the list of those that are can be sent around.
    if needed.count() <= LISTED:
        cut = cut.join(F.broadcast(needed), "doc_id", "left_semi")
    left = cut.select(F.col("doc_id").alias("a"), "fragment", F.col("segment").alias("sa"))
    right = cut.select(F.col("doc_id").alias("b"), "fragment", F.col("segment").alias("sb"))
    partial = (
        pairs.join(left, "a")
        .join(right, ["b", "fragment"])
        .select("a", "b", "na", "nb", F.size(F.array_intersect("sa", "sb")).alias("overlap"))
    )
    total = partial.groupBy("a", "b", "na", "nb").agg(F.sum("overlap").alias("overlap"))
    union = F.col("na") + F.col("nb") - F.col("overlap")
    return total.where(100 * F.col("overlap") >= similarity * union).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node each node of ``edges`` (a, b) can reach.

    Large-star and small-star steps in turn: every neighbour is moved to the smallest node
    near it, until nothing changes. Minima are combined before they are shuffled.
    """
    edges = materialize(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges"
    )
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(near, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        near = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(near, "u")
        moved = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        edges = materialize(moved.where("u <> v").distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        state = now


def linked_sets(cut: DataFrame, wide: DataFrame, prefixes: DataFrame, similarity: int) -> DataFrame:
    """(node, component) of all sets that have a link.

    First every set is tested against the smallest set of one shingle, that of its prefix which is in
    most sets: a group of near copies comes together by one test for each. Then every set is
    tested against the smallest set of its other shingles, as far as it is in another component.
    What stays in different components of a shingle is tested last: all sets outside the
    shingle's largest component serve as pivots against the sets of other components, few at
    first and more in each round, as links found meanwhile make further tests unnecessary. The
    joins that make pairs compare the bitmaps, so pairs that cannot link leave no task.
    """
    prefixes = materialize(prefixes, "prefixes")
    head = prefixes.groupBy("s").agg(F.min(F.struct("doc_id", "n", "bits")).alias("h"))
    head = materialize(head.select("s", F.col("h.doc_id").alias("a"), F.col("h.n").alias("nx"), F.col("h.bits").alias("bitsx")), "heads")

    def with_heads(rows: DataFrame) -> DataFrame:
        found = rows.join(head, "s").where((F.col("a") != F.col("doc_id")) & near("", "x", similarity))
        return found.select("a", F.col("doc_id").alias("b"), F.col("nx").alias("na"), F.col("n").alias("nb"))

    widest = prefixes.groupBy("doc_id").agg(F.max(F.struct("sets", "s")).alias("w")).select("doc_id", F.col("w.s").alias("s"))
    edges = materialize(links(with_heads(prefixes.join(widest, ["doc_id", "s"])).distinct(), cut, wide, similarity), "links")
    found = materialize(components(edges), "components")

    def named(rows: DataFrame) -> DataFrame:
        """``rows`` with the component ``c`` of their set."""
        return rows.join(found, rows["doc_id"] == found["node"], "left").select(
            *rows.columns, F.coalesce("component", "doc_id").alias("c")
        )

    other = with_heads(prefixes).distinct()
    for side in ("a", "b"):
        at = found.select(F.col("node").alias(side), F.col("component").alias(f"c{side}"))
        other = other.join(at, side, "left").withColumn(f"c{side}", F.coalesce(f"c{side}", side))
    new = materialize(links(other.where("ca <> cb").drop("ca", "cb"), cut, wide, similarity), "links")
    if not new.isEmpty():
        edges = edges.unionByName(new)
        found = materialize(components(edges), "components")
    pivots, done = PIVOTS, None
    while True:
        opened = named(prefixes.select("s", "doc_id", "n", "bits"))
        sizes = opened.groupBy("s", "c").agg(F.count("*").alias("size"))
        largest = sizes.groupBy("s").agg(F.max(F.struct("size", "c")).alias("l"), F.count("*").alias("parts")).where("parts > 1")
        opened = materialize(opened.join(largest.select("s", F.col("l.c").alias("largest")), "s"), "open-shingles")
        outside = opened.where("c <> largest").select("s", "doc_id", "n", "bits", "c")
        if done is not None:
            outside = outside.join(done, ["s", "doc_id"], "left_anti")
        # The smallest few of each shingle; tasks send no more than that.
        place = F.row_number().over(Window.partitionBy("s").orderBy("doc_id"))
        chosen = materialize(outside.withColumn("place", place).where(F.col("place") <= pivots).drop("place"), "pivots")
        if chosen.isEmpty():
            return found
        pairs = (
            opened.join(
                chosen.select(
                    "s", F.col("doc_id").alias("x"), F.col("n").alias("nx"), F.col("bits").alias("bitsx"), F.col("c").alias("cx")
                ),
                "s",
            )
            .where((F.col("c") != F.col("cx")) & near("", "x", similarity))
            .select(
                F.least("doc_id", "x").alias("a"), F.greatest("doc_id", "x").alias("b"),
                F.when(F.col("doc_id") < F.col("x"), F.col("n")).otherwise(F.col("nx")).alias("na"),
                F.when(F.col("doc_id") < F.col("x"), F.col("nx")).otherwise(F.col("n")).alias("nb"),
            )
            .distinct()
        )
        new = materialize(links(pairs, cut, wide, similarity), "links")
        done = chosen.select("s", "doc_id") if done is None else done.unionByName(chosen.select("s", "doc_id"))
        if not new.isEmpty():
            edges = edges.unionByName(new)
            found = materialize(components(edges), "components")
        pivots *= 4


def join(docs: DataFrame, similarity: int = SIMILARITY, fragments: int = FRAGMENTS) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row.

    Documents with equal sets form a class, of which one takes part in the join. A null or empty
    text has an empty set and links with nothing; so does a row without a doc_id, whose
    component is null. Rows of the same doc_id are one node.
    """
    given = docs.select(F.col("doc_id").cast("bigint"), "text")
    sets = materialize(shingle_sets(given, similarity), "shingle-sets")
    able = sets.where(F.col("low").isNotNull() & F.col("doc_id").isNotNull())
    classes = materialize(able.groupBy("low", "high", "n").agg(F.min("doc_id").alias("first"), F.count("*").alias("size")), "classes")
    first = able.join(classes.select("low", "high", "n", F.col("first").alias("doc_id")), ["low", "high", "n", "doc_id"])
    first = materialize(first.select("doc_id", "n", "bitmap", "shingles").dropDuplicates(["doc_id", "n"]), "representatives")
    found = linked_sets(*segments(first, fragments, similarity), similarity)
    member = able.join(classes.where("size > 1"), ["low", "high", "n"]).select(F.col("doc_id").alias("a"), F.col("first").alias("b"))
    named = member.join(found, member["b"] == found["node"], "left").select(
        F.col("a").alias("node"), F.coalesce("component", "b").alias("component")
    ).unionByName(found)
    named = named.groupBy("node").agg(F.min("component").alias("component"))
    return sets.join(named, sets["doc_id"] == named["node"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its component, with all their columns."""
    others = materialize(join(docs).where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("d")).distinct(), "copies")
    return docs.join(others, docs["doc_id"].cast("bigint") == others["d"], "left_anti")


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))
