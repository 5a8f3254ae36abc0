"""SimHash links, source divergence and importance resampling against plain definitions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import divergence, importance, queries, scoring, simhash


def texts_of(sf_dir, name="documents", key="doc_id"):
    return duckdb.sql(f"select {key}, text from '{sf_dir}/{name}.parquet'").fetchall()


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def brute_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0D]+", lower(text))
    runs = [words[k : k + 3] for k in range(len(words) - 2)] if len(words) > 2 else [words] if words else []
    hashes = [xxhash.xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes):
    """nodes: (doc_id, fingerprint); the smallest doc_id each row reaches."""
    ids = sorted({i for i, _ in nodes})
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    first = {}
    for i, fp in sorted(nodes):
        j = first.setdefault(fp, i)
        x, y = sorted((root(i), root(j)))
        parent[y] = x
    known = np.array(sorted(first), np.uint64)
    for fp in first:
        for other in known[np.bitwise_count(known ^ np.uint64(fp)) <= 2].tolist():
            x, y = sorted((root(first[fp]), root(first[other])))
            parent[y] = x
    return {i: root(i) for i in ids}


def test_simhash(spark, sf_check):
    rows = texts_of(sf_check)
    expected = [(i, brute_fingerprint(t)) for i, t in rows]
    components = brute_components(expected)
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.QUERIES["op11_simhash_dedup"](spark, sf_check).collect()}
    assert found == {i: (f"{fp:016x}", components[i]) for i, fp in expected}


def test_fingerprint_is_the_hash_of_spark(spark):
    text = "one two three"
    (row,) = spark.createDataFrame([(text,)], "t string").select(F.xxhash64("t").alias("h")).collect()
    assert simhash.fingerprint("One  TWO three") == row["h"]


@pytest.mark.parametrize("n_pivots", [1, 32])
def test_dense_fingerprints_are_linked(spark, n_pivots):
    """Clusters around a few centres, chains of two-bit steps, and strangers at three bits."""
    rng = np.random.default_rng(5)
    fps = {0, 7}
    for centre in rng.integers(0, 2**63, 6).tolist():
        for _ in range(300):
            fps.add(centre ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 6), replace=False)))
        step = centre ^ 0xFFFF_FFFF
        for k in range(20):
            fps.add(step)
            step ^= 3 << (3 * k)
    nodes = [(k + 1, fp) for k, fp in enumerate(rng.permutation(np.array(sorted(fps), np.uint64)).tolist())]
    signed = [(fp - 2**64 if fp >= 2**63 else fp, i) for i, fp in nodes]
    classes = spark.createDataFrame(signed, "fp bigint, first bigint")
    edges = simhash.links(classes, n_pivots)
    named = {r["node"]: r["component"] for r in simhash.components(edges).collect()}
    assert {i: named.get(i, i) for i, _ in nodes} == brute_components(nodes)


def test_a_full_group_of_fingerprints():
    """All values of the two free bytes: one component, found without holding all pairs."""
    fp = np.arange(1 << 13, dtype=np.uint64)
    first = np.arange(1 << 13, dtype=np.int64)
    a, b = simhash.group_links(np.zeros(1 << 13, np.int64), fp, first, simhash.pivots(8))
    assert len(a) == (1 << 13) - 1 and set(b.tolist()) == {0}


def brute_draw(docs, bench):
    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
        runs = [*words, *(" ".join(p) for p in zip(words, words[1:]))]
        return len(words), [zlib.crc32(r.encode()) % 10000 for r in runs]

    made = {i: features(t) for i, t in docs}
    s, t = Counter(b for _, f in made.values() for b in f), Counter(b for _, x in bench for b in features(x)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000)))) for b in range(10000)]
    out = {}
    for i, (n, f) in made.items():
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
        out[i] = [len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None]
    able = sorted((i for i in made if made[i][0] >= 20), key=lambda i: (-out[i][2], i))
    for rank, i in enumerate(able[: 25 * len(able) // 100], 1):
        out[i][3] = rank
    return {i: tuple(v) for i, v in out.items()}


def test_resampling(spark, sf_check):
    rows = queries.QUERIES["op13_importance_resampling"](spark, sf_check).collect()
    found = {r["doc_id"]: (r["n_features"], r["weight"], r["score"], r["rank"]) for r in rows}
    assert len(rows) == len(found)
    assert found == brute_draw(texts_of(sf_check), texts_of(sf_check, "benchmark", "item_id"))


@pytest.mark.parametrize("block_bytes", [200, importance.BLOCK_BYTES])
def test_lines_are_counted_once_and_joined(spark, block_bytes):
    """Repeated lines, blank lines, n-grams across lines, and blocks that end early."""
    line = "One two, THREE 4 été"
    docs = [(k, "\n".join([line] * (k % 4) + ["", " \t", f"own{k} words"] + [line] * 5)) for k in range(40)]
    bench = [("b", "two three\nfour"), ("c", None)]
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    b = spark.createDataFrame(bench, "item_id string, text string")
    found = {r["doc_id"]: (r["n_features"], r["weight"], r["score"], r["rank"]) for r in importance.resample(d, b, block_bytes=block_bytes).collect()}
    assert found == brute_draw(docs, bench)


def test_draw_of_many_ties(spark):
    """Scores of both signs with many ties; of equal scores the smaller doc_ids are drawn."""
    rng = np.random.default_rng(2)
    rows = [(int(i), int(rng.integers(15, 40)), 1, 0, int(rng.integers(-3, 3)) * 300) for i in rng.permutation(500)]
    rows += [(None, 50, 1, 0, None)]
    scored = spark.createDataFrame(rows, "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint")
    able = sorted((r for r in rows if r[0] is not None and r[1] >= 20), key=lambda r: (-r[4], r[0]))
    expected = {r[0]: k for k, r in enumerate(able[: len(able) // 4], 1)}
    drawn = importance.draw(scored).collect()
    assert len(drawn) == len(rows)
    assert {r["doc_id"]: r["rank"] for r in drawn if r["rank"]} == expected


def divergence_by_sql(rows):
    with duckdb.connect() as db:
        db.sql("create table documents (doc_id bigint, text varchar, lang varchar, source varchar)")
        db.executemany("insert into documents values (?, ?, ?, ?)", rows)
        return Counter(db.sql(divergence.OP12_SQL).fetchall())


ODD = [
    (1, "Ab ab cd éÉ x", "en", "a"), (2, "ab cd EF", "en", "b"), (3, "ab, cd; ef ef ef", "en", None), (4, None, "en", "empty"),
    (5, "ab cd", None, "a"), (6, "ab", None, None), (7, "alone", "de", "a"), (8, "other", "de", "b"), (9, "solo", "xx", "one"),
    (None, "ab ab ef", "en", "a"), (1, "Ab ab cd éÉ x", "en", "a"), (10, "éÉ " * 3000, "en", "long\x00\t source"),
]


@pytest.mark.parametrize("limits", [{}, dict(posting_limit=3, sum_limit=2), dict(posting_limit=40, group_limit=0)])
def test_divergence_of_odd_rows(spark, limits):
    """Nulls, repeated rows, languages without kept terms; runs of a few postings, groups that are not broadcast."""
    rows = ODD + [(100 + k, " ".join(f"t{c}" for c in "abcdefgh"[: k % 9]), "en", f"s{k % 7}") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    docs = docs.withColumns({c: F.lit("clash") for c in ("term", "p", "p0", "total", "n", "value")})
    found = Counter(tuple(r) for r in divergence.divergence(docs.repartition(5), **limits).collect())
    assert found == divergence_by_sql(rows)


def test_runs_merge_in_order():
    blocks = [divergence.Postings() for _ in range(3)]
    for k in range(90):
        blocks[k % 3].add(f"t{chr(97 + k % 26)} common", "en", f"s{k % 4}")
    chunks = {}
    for k, block in enumerate(blocks):
        groups, entries = block.sorted_run()
        assert [e[0] for e in entries] == sorted(e[0] for e in entries)
        batch = divergence.spill(block, f"0-{k}", 1).to_pylist()
        chunks[f"0-{k}"] = [r["entries"] for r in batch]
    found = {term: (lang, dict(zip(sources, counts))) for lang, term, sources, counts in divergence.merged(chunks, 4)}
    assert found["common"] == ("en", {"s0": 23, "s1": 23, "s2": 22, "s3": 22})
    assert sum(sum(c.values()) for _, c in found.values()) == 90 + sum(n for n in Counter(k % 26 for k in range(90)).values() if n >= 4)


def test_probabilities_of_large_counts(spark):
    rows = [(0, 0, 0), (3, 10, 7), (10**11, 10**12, 10**9), (9_223_372_035, 10**13, 5), (9_223_372_036, 10**13, 5)]
    made = spark.createDataFrame(rows, "c bigint, n bigint, v bigint").select("*", divergence.probability(F.col("c"), F.col("n"), F.col("v")).alias("p"))
    for r in made.collect():
        assert r["p"] == (1 + 10**9 * (r["c"] + 1) // (r["n"] + r["v"]) if r["v"] else 1)


EDGES = [
    (1, None, None, None), (2, "", "en", "a"), (None, "a text without an id", "en", "a"), (None, None, None, None),
    (3, "the same row " * 30, "en", "a"), (3, "the same row " * 30, "en", "a"), (3, "another text of the same id", "en", "b"),
    (4, "another text of the same id", "en", "b"), (5, " \t\n\x0b ", "en", None), (6, "x" * 200_000, "en", "a"),
    (7, " ".join(f"w{k}" for k in range(70_000)), "en", "a"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string"
CLASHING = ("fp", "first", "node", "size", "n", "score", "rank", "block", "bucket", "key", "component")


def test_odd_rows(spark):
    docs = spark.createDataFrame(EDGES, SCHEMA).withColumns({c: F.lit("clash") for c in CLASHING})
    near = simhash.near_duplicates(docs).collect()
    assert len(near) == len(EDGES)
    assert all((r["doc_id"] is None) == (r["component_id"] is None) for r in near)
    assert {r["component_id"] for r in near if r["doc_id"] in (1, 2, 5)} == {1}
    assert {r["component_id"] for r in near if r["doc_id"] in (3, 4)} == {3}
    bench = spark.createDataFrame([("i", None, "clash"), ("j", "the same row", "clash")], "item_id string, text string, n string")
    drawn = importance.resample(docs, bench).collect()
    assert len(drawn) == len(EDGES)
    assert all(r["score"] is None and r["rank"] is None for r in drawn if r["doc_id"] is None)
    assert [r["rank"] for r in drawn if r["rank"]] == []  # three are eligible, a quarter of them is none


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    bench = spark.createDataFrame([], "item_id string, text string")
    assert simhash.near_duplicates(docs).collect() == []
    assert importance.resample(docs, bench).collect() == []
    assert divergence.divergence(docs).collect() == []
    one = spark.createDataFrame([(1, "w " * 30, "en", "a")], SCHEMA)
    assert [r["rank"] for r in importance.resample(one, bench).collect()] == [None]


def backed_off(texts, held):
    """A text's log10 probability under all n-grams of the training texts, by dictionaries; texts are (words, copies)."""
    counts, tokens = Counter(), 0
    for (words, copies), out in zip(texts, held):
        if not out:
            s = ["<s>", *words, "</s>"]
            tokens += copies * (len(s) - 1)
            for size in (1, 2, 3):
                for k in range(len(s) - size + 1):
                    counts[tuple(s[k : k + size])] += copies
    kinds = sum(len(g) == 1 for g in counts) - (("<s>",) in counts)
    after = {}
    for g in counts:
        after.setdefault(g[:-1], []).append(g)

    def seen(context):
        return counts[context] + (0.5 if len(context) == 1 and context != ("<s>",) else 0)

    def p(gram):
        if len(gram) == 1:
            return (counts[gram] + 0.5) / (tokens + 0.5 * (kinds + 1))
        if counts[gram]:
            return (counts[gram] - 0.6) / seen(gram[:-1])
        if gram[:-1] not in after:
            return p(gram[1:])
        arcs = after[gram[:-1]]
        used = sum((counts[g] - 0.6) / seen(g[:-1]) for g in arcs)
        return max(1e-12, 1 - used) / max(1e-12, 1 - sum(p(g[1:]) for g in arcs)) * p(gram[1:])

    def score(words):
        s = ["<s>", *words, "</s>"]
        return sum(math.log10(p(tuple(s[max(0, k - 2) : k + 1]))) for k in range(1, len(s)))

    return score


@pytest.mark.parametrize("copies", (1, 150))
def test_every_word_and_n_gram_counts_however_rare(spark, copies):
    """Over 1.4 million tokens an n-gram that occurs once makes less than a millionth of them."""
    rng = random.Random(5)
    texts = [([f"w{int(rng.paretovariate(0.7)) % 300}" for _ in range(rng.randrange(60))], 1) for _ in range(150)]
    texts += [(["rare", "words", "once"], 1), (["rare", "words", "once", "more", "w1"], 1), (["a", "b", "c"] * 3200, copies)]
    ids, rows = range(len(texts)), [(i, " ".join(words)) for i, (words, _) in enumerate(texts)]
    # Of ids for the copies those of training documents.
    out = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    extra = [i for i in range(10_000, 20_000) if not out(i)][: copies - 1]
    held = [out(i) for i in ids]
    assert not held[-1] and held[:-1].count(True) > 10
    docs = spark.createDataFrame(rows + [(i, rows[-1][1]) for i in extra], "doc_id bigint, text string").repartition(6)
    found = {r["doc_id"]: r["score"] for r in scoring.score(docs).collect()}
    expected = backed_off(texts, held)
    assert len(found) == len(rows) + len(extra)
    for i, (words, _) in zip(ids, texts):
        assert found[i] == pytest.approx(expected(words), rel=1e-9), i
