"""How far the sources of a language differ in their terms, from an index made in a single pass.

Each task collects the postings of its texts in memory: for each term the documents that have it,
with their language and source and how often they do. When there are too many, they are written as a run sorted by
term, cut by the shard of the term. A shard's runs, from all tasks, are merged with a heap into
frequencies; only terms in enough documents are kept. No text is shuffled.

The divergence of two sources is a sum over all kept terms, most of which one of the two lacks.
It is therefore taken as if both lacked every term, and corrected: for terms that one of them
has, by its numbers of terms of equal probability; for terms that both have, by a stream over
the merged postings that adds up the corrections by pair.

A null text, language or source counts as empty. A group without kept terms, and a language
without any, has value 0 with each other source. Each row is a document of its own, repeated or
not; doc_id and other columns are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import pickle
import zlib
from collections import Counter, defaultdict
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.base import ship, table
from tidemark.session import materialize, shuffle_partitions

MIN_DOCUMENTS = 3
SCALE = 1_000_000_000
TOP = 200
#: Postings that a task holds before it writes a run, and terms in one chunk of a run.
POSTINGS, CHUNK = 1_000_000, 4_000
#: Pairs of postings that a task looks at a time, and pairs of groups it adds up before it passes them on.
PAIRS, SUMS = 1 << 20, 1 << 18
#: Groups are broadcast up to so many (some 64 MB).
GROUPS = 1 << 20
#: Copies of a language's list of sources, so that a language is not one task's work.
COPIES = 16

# Blanks for what is not of a term, A-Z in lower case.
_TERMS = bytes(
    c if c >= 0x80 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256)
)


class Postings:
    """The postings of a block of texts: for each term, (group, occurrences) of every document with it.

    A group is the place of its (language, source) in ``groups``.
    """

    def __init__(self) -> None:
        self.groups: dict[tuple[str, str], int] = {}
        self.by_term: dict[bytes, list[int]] = {}
        self.size = 0

    def add(self, text: str, lang: str, source: str) -> None:
        counted = Counter(text.encode("utf-8", "surrogatepass").translate(_TERMS).split())
        place = self.groups.setdefault((lang, source), len(self.groups))
        by_term = self.by_term
        for term, n in counted.items():
            known = by_term.get(term)
            if known is None:
                by_term[term] = [place, n]
            else:
                known.append(place)
                known.append(n)
        self.size += len(counted)

    def sorted_run(self) -> tuple[list[tuple[str, str]], list[tuple[bytes, list[int]]]]:
        """Groups, and (term, [group, n, group, n, ...]) by term."""
        return list(self.groups), sorted(self.by_term.items())


RUNS = pa.schema([("shard", pa.int32()), ("run", pa.string()), ("chunk", pa.int32()), ("entries", pa.binary())])


def spill(postings: Postings, run: str, shards: int) -> pa.RecordBatch:
    """The run, by shard, in chunks that can be read one after the other."""
    by_shard: dict[int, list] = defaultdict(list)
    groups, entries = postings.sorted_run()
    for entry in entries:
        by_shard[zlib.crc32(entry[0]) % shards].append(entry)
    rows = [
        (shard, run, k, zlib.compress(pickle.dumps((groups, part[k : k + CHUNK]), pickle.HIGHEST_PROTOCOL), 1))
        for shard, part in by_shard.items()
        for k in range(0, len(part), CHUNK)
    ]
    columns = zip(*rows) if rows else [[] for _ in RUNS]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, RUNS)], schema=RUNS)


def runs(docs: DataFrame, shards: int, limit: int = POSTINGS) -> DataFrame:
    """The runs of all tasks, one row for each chunk."""

    def index(batches):
        postings, number = Postings(), 0
        task = TaskContext.get().partitionId()
        for batch in batches:
            for text, lang, source in zip(*batch.columns):
                postings.add(text.as_py(), lang.as_py(), source.as_py())
                if postings.size >= limit:
                    yield spill(postings, f"{task}-{number}", shards)
                    postings, number = Postings(), number + 1
        yield spill(postings, f"{task}-{number}", shards)

    return docs.select("text", "lang", "source").mapInArrow(index, "shard int, run string, chunk int, entries binary")


FREQUENCIES = pa.schema(
    [("lang", pa.string()), ("term", pa.string()), ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))]
)


def merged(chunks: dict[str, list[bytes]], min_documents: int):
    """(lang, term, sources, counts) of the kept terms of a shard, whose runs are merged with a heap."""

    def entries(run: int, parts: list[bytes]):
        for part in parts:
            groups, found = pickle.loads(zlib.decompress(part))
            for term, counted in found:
                yield term, run, groups, counted

    in_order = heapq.merge(*(entries(run, parts) for run, parts in enumerate(chunks.values())))
    for term, same in groupby(in_order, key=itemgetter(0)):
        found = [(groups, counted) for _, _, groups, counted in same]
        if sum(len(counted) for _, counted in found) < 2 * min_documents:
            continue
        total: dict[tuple[str, str], int] = {}
        documents: Counter = Counter()
        for groups, counted in found:
            for place, n in zip(counted[::2], counted[1::2]):
                group = groups[place]
                total[group] = total.get(group, 0) + n
                documents[group[0]] += 1
        for lang, n in documents.items():
            if n >= min_documents:
                kept = [(source, n) for (of, source), n in total.items() if of == lang]
                yield lang, term.decode("utf-8", "surrogatepass"), [s for s, _ in kept], [n for _, n in kept]


def frequencies(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, limit: int = POSTINGS) -> DataFrame:
    """(lang, term, sources, counts) of every term in at least ``min_documents`` documents of the language."""
    ship(docs.sparkSession)
    shards = max(shuffle_partitions(docs.sparkSession), docs.rdd.getNumPartitions())

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), FREQUENCIES)], schema=FREQUENCIES)

    def merge(batches):
        def shard_rows():
            for batch in batches:
                yield from zip(*(batch.column(name) for name in ("shard", "run", "entries")))

        out = []
        for _, rows in groupby(((s.as_py(), r.as_py(), e.as_py()) for s, r, e in shard_rows()), key=itemgetter(0)):
            chunks: dict[str, list[bytes]] = defaultdict(list)
            for _, run, entries in rows:
                chunks[run].append(entries)
            for row in merged(chunks, min_documents):
                out.append(row)
                if len(out) == CHUNK:
                    yield batch_of(out)
                    out = []
        if out:
            yield batch_of(out)

    in_order = runs(docs, shards, limit).repartition(shards, "shard").sortWithinPartitions("shard", "run", "chunk")
    return in_order.mapInArrow(merge, "lang string, term string, sources array<string>, counts array<bigint>")


def probability(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + kept)) without rounding; 1 for a language without terms."""
    short = F.call_function("div", SCALE * (count + 1), total + kept)
    above = F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    share = F.call_function("div", above, (total + kept).cast("decimal(20,0)"))
    fits = count < 2**63 // SCALE - 1
    return F.when(kept <= 0, 1).when(fits, 1 + short).otherwise(1 + share).cast("bigint")


def excess(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q). Probabilities are at most 1 + SCALE, so the square is a LONG."""
    return F.call_function("div", (p - q) * (p - q), q)


CORRECTIONS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def corrections_of(lang, term, source, p, p0) -> Counter:
    """Corrections of the pairs of postings of each term, added up by (lang, source, other source)."""

    def f(x, y):
        return (x - y) * (x - y) // y

    same = pc.and_(pc.equal(lang[1:], lang[:-1]), pc.equal(term[1:], term[:-1])).to_numpy(zero_copy_only=False)
    first = np.flatnonzero(np.concatenate([[True], ~same]))
    sizes = np.diff(np.append(first, len(p)))
    begin, size = np.repeat(first, sizes), np.repeat(sizes, sizes)
    langs, sources = lang.dictionary_encode(), source.dictionary_encode()
    width = len(sources.dictionary)
    group = langs.indices.to_numpy().astype(np.int64) * width + sources.indices.to_numpy()
    groups, group = np.unique(group, return_inverse=True)
    total: dict[int, int] = {}
    ends = np.cumsum(size)
    row = 0
    while row < len(p):
        done = ends[row - 1] if row else 0
        until = max(row + 1, int(np.searchsorted(ends, done + PAIRS, "right")))
        times = size[row:until]
        a = np.repeat(np.arange(row, until), times)
        b = np.arange(len(a)) - np.repeat(np.cumsum(times) - times, times) + begin[a]
        a, b = a[a != b], b[a != b]
        value = f(p[a], p[b]) - f(p[a], p0[b]) - f(p0[a], p[b]) + f(p0[a], p0[b])
        pairs, at = np.unique(group[a] * len(groups) + group[b], return_inverse=True)
        sums = np.zeros(len(pairs), np.int64)
        np.add.at(sums, at, value)
        for pair, n in zip(pairs.tolist(), sums.tolist()):
            total[pair] = total.get(pair, 0) + n
        row = until
    names = [(langs.dictionary[g // width].as_py(), sources.dictionary[g % width].as_py()) for g in groups.tolist()]
    return Counter({(*names[pair // len(groups)], names[pair % len(groups)][1]): n for pair, n in total.items()})


def pair_corrections(postings: DataFrame, limit: int = SUMS) -> DataFrame:
    """(lang, source, item, value) for terms that both have, added up within each task.

    Such a term counts with f(p, q), and was counted with f(p, q0) and f(p0, q) in place of f(p0, q0),
    where p0 and q0 are the probabilities of a term the source lacks. The rows of
    ``postings`` (lang, term, source, p, p0) with the same term must follow each other in one partition.
    """
    ship(postings.sparkSession)

    def batch_of(sums: Counter) -> pa.RecordBatch:
        columns = [*zip(*sums)] if sums else [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip([*columns, list(sums.values())], CORRECTIONS)], schema=CORRECTIONS)

    def run(batches):
        sums, rest = Counter(), None
        for batch in batches:
            batch = pa.Table.from_batches([batch])
            rows = pa.concat_tables([rest, batch]).combine_chunks() if rest is not None else batch
            if not rows.num_rows:
                continue
            # The last term may go on in the next batch.
            last = rows.num_rows - 1
            other = pc.or_(pc.not_equal(rows["lang"], rows["lang"][last]), pc.not_equal(rows["term"], rows["term"][last]))
            before = np.flatnonzero(other.to_numpy(zero_copy_only=False))
            cut = int(before[-1]) + 1 if len(before) else 0
            rest = rows.slice(cut)
            if cut:
                sums.update(corrections_of(*columns_of(rows.slice(0, cut))))
            if len(sums) > limit:
                yield batch_of(sums)
                sums = Counter()
        if rest is not None:
            sums.update(corrections_of(*columns_of(rest)))
        yield batch_of(sums)

    def columns_of(rows: pa.Table):
        text = [pa.concat_arrays(rows[c].chunks) for c in ("lang", "term", "source")]
        return *text, *(rows[c].to_numpy() for c in ("p", "p0"))

    rows = postings.select("lang", "term", "source", "p", "p0")
    parts = rows.mapInArrow(run, "lang string, source string, item string, value bigint")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def divergence(
    docs: DataFrame,
    min_documents: int = MIN_DOCUMENTS,
    top: int = TOP,
    posting_limit: int = POSTINGS,
    sum_limit: int = SUMS,
    group_limit: int = GROUPS,
) -> DataFrame:
    """(lang, source, part, item, value, rank): each pair of sources, and the terms a source has more of."""
    given = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    kept = materialize(frequencies(given, min_documents, posting_limit), "frequencies")
    zero = F.lit(0).cast("bigint")
    in_lang = F.aggregate("counts", zero, lambda a, c: a + c)
    counted = kept.select(
        "lang", "term", in_lang.alias("in_lang"), F.inline(F.arrays_zip(F.col("sources").alias("source"), F.col("counts").alias("n")))
    ).toDF("lang", "term", "in_lang", "source", "n")
    langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum(in_lang).alias("lang_total"))
    groups = given.groupBy("lang", "source").agg(F.count("*").alias("rows")).drop("rows")
    totals = counted.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("total", "kept", "lang_total")]
    )
    groups = materialize(groups.withColumn("p0", probability(zero, F.col("total"), F.col("kept"))), "groups")

    # Groups are few, one for each source of a language; beyond the limit they are joined by a shuffle.
    few = groups.count() <= group_limit
    priced = counted.join(F.broadcast(groups) if few else groups, ["lang", "source"])
    p_here = probability(F.col("n"), F.col("total"), F.col("kept")).alias("p")
    postings = materialize(
        priced.select("lang", "term", "source", "p0", p_here, probability(F.col("in_lang"), F.col("lang_total"), F.col("kept")).alias("q")),
        "postings",
    )
    # A term is one row of ``kept``, so its postings follow each other unless they have been shuffled.
    by_term = priced.select("lang", "term", "source", p_here, "p0")
    if not few:
        by_term = by_term.repartition("lang", "term").sortWithinPartitions("lang", "term")

    salted = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"), F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))).alias("salt"))
    alike = postings.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("terms")).withColumn(
        "salt", F.pmod(F.xxhash64("source", "p"), F.lit(COPIES)).cast("int")
    )
    p, p0, q0 = F.col("p"), F.col("p0"), F.col("q0")
    one_sided = (
        alike.join(salted, ["lang", "salt"])
        .where("source <> item")
        .groupBy("lang", "source", "item")
        .agg(
            F.sum(F.col("terms") * (excess(p, q0) - excess(p0, q0))).alias("here"),
            F.sum(F.col("terms") * (excess(q0, p) - excess(q0, p0))).alias("there"),
        )
    )
    others = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    as_if_empty = groups.join(others, "lang").where("source <> item").select(
        "lang", "source", "item", (F.col("kept") * excess(p0, q0)).alias("value")
    )
    pairs = (
        as_if_empty.unionByName(one_sided.select("lang", "source", "item", F.col("here").alias("value")))
        .unionByName(one_sided.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col("there").alias("value")))
        .unionByName(pair_corrections(by_term, sum_limit))
        .groupBy("lang", "source", "item")
        .agg(F.sum("value").alias("value"))
    )
    by_value = [F.desc("value"), F.asc("item")]
    group = Window.partitionBy("lang", "source")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    ranked_pairs = pairs.withColumn("part", F.lit("pair")).withColumn("rank", F.row_number().over(group.orderBy(*by_value)))
    terms = postings.where("p > q").select("lang", "source", F.col("term").alias("item"), excess(p, F.col("q")).alias("value"))
    # Ranked within slices of the terms first, so that a busy source is not one task's work.
    sliced = terms.withColumn("slice", F.pmod(F.xxhash64("item"), F.lit(COPIES)))
    place = F.row_number().over(Window.partitionBy("lang", "source", "slice").orderBy(*by_value))
    best = sliced.withColumn("place", place).where(F.col("place") <= top)
    ranked_terms = (
        best.withColumn("part", F.lit("term")).withColumn("rank", F.row_number().over(group.orderBy(*by_value))).where(F.col("rank") <= top)
    )
    return ranked_pairs.select(*columns).unionByName(ranked_terms.select(*columns))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS uid, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
words AS (
  SELECT uid, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS in_lang FROM words GROUP BY 1, 2 HAVING count(DISTINCT uid) >= 3),
found AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM words w JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
langs AS (SELECT lang, count(*) AS v, sum(in_lang)::HUGEINT AS total FROM kept GROUP BY 1),
totals AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM found GROUP BY 1, 2),
groups AS (SELECT DISTINCT lang, source FROM docs),
every AS (
  SELECT g.lang, g.source, k.term, coalesce(f.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(f.n, 0) + 1)) // (coalesce(t.total, 0) + l.v) AS p,
         1 + (1000000000::HUGEINT * (k.in_lang + 1)) // (l.total + l.v) AS q
  FROM groups g JOIN kept k ON k.lang = g.lang JOIN langs l ON l.lang = g.lang
  LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
  LEFT JOIN found f ON f.lang = g.lang AND f.source = g.source AND f.term = k.term),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM every a JOIN every b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // q AS BIGINT) AS value FROM every WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
