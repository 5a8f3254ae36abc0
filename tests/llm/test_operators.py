"""Each training-data query against a plain definition, computed without Spark."""

from __future__ import annotations

import hashlib
import html
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontamination, extraction, jaccard, packing, pii, quality, queries, scoring, secrets, substrings
from tidemark.llm.base import table

WORD = re.compile("[^\x20\x09-\x0D]+")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def rows_of(spark, sf_dir, query, key="doc_id"):
    rows = queries.QUERIES[query](spark, sf_dir).collect()
    found = {r[key]: r for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.fixture(scope="module")
def texts(sf_small):
    rows = duckdb.sql(f"select doc_id, text from '{sf_small}/documents.parquet'").fetchall()
    return {i: t or "" for i, t in rows}


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_agrees_with_sql(spark, sf_small, name):
    with duckdb.connect() as db:
        for t in ("documents", "benchmark", "conversations", "pages"):
            db.sql(f"create view {t} as select * from '{sf_small}/{t}.parquet'")
        expected = db.sql(queries.SQL[name])
        columns = sorted(expected.columns)
        expected = Counter(expected.select(*columns).fetchall())
    assert Counter(tuple(r) for r in queries.QUERIES[name](spark, sf_small).select(*columns).collect()) == expected


def test_secrets(spark, sf_small, texts):
    assign = re.compile(
        r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
    )
    found = rows_of(spark, sf_small, "op1_secret_scan")
    for i, t in texts.items():
        spans = [(m.start(), 0, m.end(), "assign") for m in assign.finditer(t) if len(m.group(1)) >= 12]
        spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m.group()) >= 18]
        spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m.group()) >= 16]
        base = [f"{k}:{a}:{b}" for a, _, b, k in sorted(spans)]
        assert found[i]["base_sha256"] == digest(",".join(base))
        assert set(base) <= set(filter(None, found[i]["spans"].split(",")))
        assert [found[i][f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(s[1] == k for s in spans) for k in range(3)]


PARTS = "account address builder cache client command config connection container context controller data decoder default device "
PARTS += "document element encoder endpoint error event factory filter format handler header index listener manager message method model "
PARTS += "module network object option order packet parameter parser policy process profile property provider query record register "
PARTS = (PARTS + "request resource response result schema server service session signal source status stream string system table token user value").split()


def identifier(rng):
    words = [PARTS[k] for k in rng.integers(0, len(PARTS), 4)]
    return "_".join(words) if rng.random() < 0.5 else words[0] + "".join(w.title() for w in words[1:])


def test_models_tell_secrets_from_identifiers(spark):
    """Strings that no pattern names are found, identifiers with digits of the same length are left alone."""
    rng = np.random.default_rng(17)
    signs = np.array(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"))
    secret = lambda n: "".join(rng.choice(signs, n)) + "7a"
    corpus = [(k, " ".join(identifier(rng) for _ in range(20))) for k in range(100)]
    hidden = [(1000 + k, f"see {secret(30)} in the log") for k in range(200)]
    alike = [(2000 + k, f"see {identifier(rng)}_v{k % 10} in the log") for k in range(200)]
    docs = spark.createDataFrame(corpus + hidden + alike, "doc_id bigint, text string")
    added = {r["doc_id"]: [(s["start"], s["end"]) for s in r["added"]] for r in secrets.scan(docs).collect()}
    assert sum(added[i] == [(4, 36)] for i, _ in hidden) >= 190
    assert sum(bool(added[i]) for i, _ in alike) <= 4
    assert not any(added[i] for i, _ in corpus)


def test_packing(spark, sf_small, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in packing.op2_packing(spark, sf_small).collect():
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(texts)
    for i, t in texts.items():
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 2048


def brute_fill(counts, capacity):
    """The largest length is in the window; the rest is free."""
    best = {max(counts)}
    for length, n in (counts - Counter([max(counts)])).items():
        best = {b + k * length for b in best for k in range(n + 1) if b + k * length <= capacity}
    return max(best)


def test_bin_slack_is_least():
    rng = np.random.default_rng(7)
    for _ in range(200):
        counts = Counter(rng.integers(1, 30, rng.integers(1, 8)).tolist())
        fill = packing.best_fill(counts, 40)
        assert sum(k * n for k, n in fill.items()) == brute_fill(counts, 40)
        assert all(n <= counts[k] for k, n in fill.items())


def brute_repeats(words):
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    counts = Counter(windows)
    return len({k + j for k, w in enumerate(windows) if counts[w] > 1 for j in range(3)})


def test_quality(spark, sf_small, texts):
    found = rows_of(spark, sf_small, "op4_quality_rules")
    for i, t in texts.items():
        words, seen, again = WORD.findall(t), set(), 0
        for line in t.split("\n"):
            if WORD.search(line):
                again += line in seen
                seen.add(line)
        repeats, r = brute_repeats(words), found[i]
        failed = len(words) < 50 or 100 * repeats > 50 * len(words)
        assert (r["n_words"], r["word_chars"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == (
            len(words), sum(map(len, words)), again, repeats, failed,
        )
        assert r["n_symbols"] == len(re.findall("[#*$%&|<>]", t))
        assert not (failed and r["kept"])


def test_lines_of_many_documents(spark):
    """A line in more documents of a host than the limit goes; copies count as one document.

    Lines that differ in digits alone are one line, so the documents' own words have letters only.
    """
    own = [" ".join("abcdefghijkl"[i] + "x" * k for k in range(60)) for i in range(12)]
    rows = [(i, own[i] + "\nSame 17 line", "a") for i in range(6)]
    rows += [(i, "short " + own[i] + "\n" + "\n".join(["Same 18 line"] * 60), "a") for i in range(6, 8)]
    rows += [(8, own[8] + "\nother line", "a"), (20, own[8] + "\nother line", "a"), (9, own[9] + "\nSame 17 line", "b")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = {r["doc_id"]: r for r in quality.assess(docs, documents=5, share=0.0).collect()}
    assert all(found[i]["removed_words"] == 3 and found[i]["kept"] for i in range(6))
    assert all(found[i]["removed_words"] == 180 and not found[i]["kept"] for i in (6, 7))
    assert all(found[i]["removed_words"] == 0 for i in (8, 9, 20))


def test_copies_do_not_change_the_share_of_a_line(spark):
    """Boilerplate in 100 documents of a host is found whether or not one of them has 20,000 copies."""
    body = lambda i: " ".join("abcdefghij"[int(d)] * 3 + "y" * k for k in range(30) for d in f"{i:02d}")
    texts = [f"{body(i)}\nthe boilerplate of this host\n{body(i)[::-1]}" for i in range(100)]
    rows = [(i, t, "a") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("n_chars", F.length("text").cast("bigint"))
    many = docs.where("doc_id = 7").crossJoin(spark.range(20_000)).select((F.col("id") + 1000).alias("doc_id"), "text", "source", "n_chars")
    for given in (docs, docs.unionByName(many)):
        judged = quality.assess(given)
        assert judged.where("removed_words <> 5").count() == 0
        kept = quality.keep(given)
        assert kept.columns == given.columns and kept.count() == given.count()
        assert kept.where("text LIKE '%boilerplate%' OR n_chars <> length(text)").count() == 0
        first = kept.where("doc_id = 3").first()
        assert first["text"] == f"{body(3)}\n{body(3)[::-1]}"


def test_lines_that_differ_in_digits_are_removed_alike():
    hashes = set(quality.word_hashes([quality.normal("Page 3 of  9")]).view(np.int64).tolist())
    assert quality.without_lines("a\npage 12 OF 0\n\n b ", hashes) == "a\n\n b "


def test_windows_repeated_in_a_document(spark):
    """One word for ever, two in turn, and parts of them in other documents."""
    texts = {1: "w " * 3000, 2: "w " * 40 + "x", 3: "a b " * 500, 4: "z " + "a b " * 30, 5: "w " * 12 + "q", 0: "b a " * 7}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    first, expected = {}, {}
    for i, t in sorted(texts.items()):
        words = t.split()
        for k in range(len(words) - 12):
            first.setdefault(tuple(words[k : k + 13]), i)
    for i, t in texts.items():
        words = t.split()
        gone = {k + j for k in range(len(words) - 12) if first[tuple(words[k : k + 13])] < i for j in range(13)}
        expected[i] = " ".join(w for k, w in enumerate(words) if k not in gone)
    for given in (docs.coalesce(1), docs.repartition(6)):
        assert {r["doc_id"]: r["kept"] for r in substrings.deduplicate(given).collect()} == expected


def test_a_window_is_sent_once_for_each_document():
    n = 100_000
    one = np.ones(n, np.int64)
    sent = substrings.settle(one, one.astype(np.int32), one, one.astype(np.int32), np.arange(n, dtype=np.int32))
    assert sent.num_rows == 2  # the window, and a run of those that go with it


def article_of(page):
    article = re.search("<article>(.*?)</article>", page, re.S).group(1)
    blocks = [re.sub("</?b>", "", b.replace("<br>", " ")) for b in re.split("</?p>|</?h1>", article)]
    blocks = [re.sub(r"\s+", " ", html.unescape(b)).strip() for b in blocks]
    return "\n".join(b for b in blocks if b)


def test_extraction(spark, sf_small):
    found = rows_of(spark, sf_small, "op7_html_extraction", "page_id")
    pages = duckdb.sql(f"select page_id, html from '{sf_small}/pages.parquet'").fetchall()
    assert len(found) == len(pages)
    for i, page in pages:
        expected = article_of(page)
        assert (found[i]["text"], found[i]["n_chars"]) == (expected, len(expected))


def test_ratios_choose_the_lines(sf_check):
    """Other ratios give other texts; elements and classes without telling names give nearly the same."""
    pages = [p for p, in duckdb.sql(f"select html from '{sf_check}/pages.parquet'").fetchall()]
    right = lambda change, **kw: sum(extraction.main_text(change(p), **kw) == article_of(p) for p in pages) / len(pages)
    rng = np.random.default_rng(4)
    same = lambda p: p
    untold = lambda p: re.sub(r' class="[^"]*"', "", re.sub(r"<(/?)(nav|footer|aside|header|article|main)\b", r"<\1div", p))
    assert right(same) == 1
    assert right(untold) > 0.97
    assert right(same, ratios=lambda lines: np.ones(len(lines))) < 0.6
    assert right(same, ratios=lambda lines: rng.random(len(lines))) < 0.6


LONG = "A paragraph of some length that nobody would take for a menu, a notice or an advert. " * 3


def test_names_only_weigh():
    page = f"""<body><div class="menu"><a href="x">Home</a> <a href="y">About</a></div>
    <div class="page"><div class="entry-header"><h1>A title</h1></div><p>{LONG}</p><p>Short.</p><div class="ad">Buy it now!</div>
    <section class="related-work"><h2>Related work</h2><p>{LONG * 6}</p></section><p>{LONG}</p><p>The end.</p></div>
    <div class="comments"><p>First!</p><p>I like it.</p></div><footer>Imprint</footer></body>"""
    found = extraction.main_text(page).split("\n")
    long = LONG.strip()
    assert {"Short.", "The end.", long, (LONG * 6).strip()} <= set(found)
    assert not {"Home", "Home About", "Buy it now!", "First!", "I like it.", "Imprint"} & set(found)


def test_deep_pages_take_memory_in_proportion():
    import tracemalloc

    peaks = []
    for n in (5_000, 40_000):
        page = "<div>x" * n
        tracemalloc.start()
        text = extraction.main_text(page)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert set(text) <= {"x", "\n"}
    assert peaks[1] < 12 * peaks[0]


@pytest.mark.parametrize("page", ["<p>", "text alone", "<nav>only a menu</nav>", "<a href='x'>only links</a>", "</p></div>", "<script>x", "<p>a<p>b"])
def test_pages_of_little(page):
    assert isinstance(extraction.main_text(page), str)


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return frozenset(zip(words, words[1:], words[2:])) if len(words) > 2 else frozenset([tuple(words)] if words else [])


def brute_components(texts):
    sets, parent = {i: shingle_set(t) for i, t in texts.items()}, {i: i for i in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 90 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_jaccard(spark, sf_small, texts):
    found = rows_of(spark, sf_small, "op8_ngram_jaccard_join")
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in found.items()} == brute_components(texts)


def test_jaccard_chains_and_copies(spark):
    """Chains whose ends do not link, copies, common shingles, sets near the limit and long texts."""
    rng = np.random.default_rng(11)
    texts = {}
    for family in range(6):
        words = [f"f{family}w{k}" for k in range((5, 42, 60, 130, 900, 62)[family])]
        for step in range(70 if family == 5 else 14):
            words = list(words)
            if rng.random() < 0.8:
                words[rng.integers(len(words))] = f"new{family}x{step}"
            texts[len(texts)] = " ".join(words)
    for k in range(80):
        texts[len(texts)] = " ".join(["a common start of all"] + [f"o{k}v{j}" for j in range(k // 4)])
    texts |= {len(texts) + k: t for k, t in enumerate(("", "  \n", "one", "ONE", "one two", "one two"))}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join(docs).collect()}
    assert found == brute_components(texts)


def test_bitmaps_lose_no_link():
    rng = np.random.default_rng(3)
    for n in (1, 10, 100, 500, 3000):
        a = rng.integers(0, 2**63, n).astype(np.uint64)
        b = a.copy()
        b[: n // 20] = rng.integers(0, 2**63, n // 20).astype(np.uint64)
        differ = sum(int(x).bit_count() for x in (jaccard.bitmap(a) ^ jaccard.bitmap(b)).view(np.uint64))
        assert differ <= len(set(a.tolist()) ^ set(b.tolist()))


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def personal(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    spans = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    spans += [
        ("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
        if all(int(x) < 256 for x in m.group().split("."))
    ]
    spans += [
        ("card", *m.span()) for m in re.finditer("[0-9]([\x20-]?[0-9])+", t)
        if 16 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))
    ]
    spans += [("phone", *m.span()) for m in re.finditer("\\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(digits(m.group())) <= 15]
    return [f"{k}:{a}:{b}" for k, a, b in spans]


def test_personal_data(spark, sf_small, texts):
    found = rows_of(spark, sf_small, "op9_pii")
    for i, t in texts.items():
        base = personal(t)
        assert found[i]["base_sha256"] == digest(",".join(base))
        assert set(base) <= set(filter(None, found[i]["spans"].split(",")))


def test_many_numbers_are_compared_with_their_neighbours_alone():
    import time

    def seconds(n):
        text = " ".join(f"+1 202 555 {k % 10000:04d} x 301-555-{k % 10000:04d}" for k in range(n))
        begin = time.perf_counter()
        spans = pii.scan_text(text)
        assert len(spans["extra"]) == n and spans["n_phone"] == n
        return time.perf_counter() - begin

    seconds(500)
    assert seconds(16_000) < 16 * seconds(2_000)


def test_masking_leaves_none(spark, sf_small, texts):
    masked = pii.redact(table(spark, sf_small, "documents")).collect()
    assert len(masked) == len(texts)
    for r in masked:
        assert r["n_chars"] == len(r["text"]) and not personal(r["text"])
        if not personal(texts[r["doc_id"]]) and "<" not in r["text"]:
            assert r["text"] == texts[r["doc_id"]]


def test_language_model(spark, sf_check):
    rows = duckdb.sql(f"select doc_id, text from '{sf_check}/documents.parquet'").fetchall()
    tokens = {i: [*(t or "").encode().lower().split(), None] for i, t in rows}
    out = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in tokens}
    counts = Counter(w for i, t in tokens.items() if not out[i] for w in t)
    total, distinct = sum(counts.values()), len(counts)
    found = rows_of(spark, sf_check, "op10_lm_scoring")
    held = []
    for i, t in tokens.items():
        r = found[i]
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in t)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (out[i], len(t), total)
        assert r["n_known"] == sum(counts[w] > 0 for w in t)
        held += [(r["score"], r["base_score"])] if out[i] else []
    assert sum(s for s, _ in held) > sum(b for _, b in held)


WINNOWED = 13


def test_passages_in_and_out_of_a_benchmark(spark):
    """Runs of 13 words or more are found wherever they stand, runs of 12 are not."""
    item = [f"q{k}" for k in range(40)]
    other = lambda n: [f"z{k}" for k in range(n)]
    docs = {
        1: other(30) + item[5:18] + other(30), 2: other(30) + item[5:17] + other(30), 3: item, 4: other(300) + item[:13],
        5: [w.upper() for w in item], 6: ["only", "four", "short", "words"] + other(10), 7: [],
    }
    given = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id bigint, text string")
    bench = spark.createDataFrame(
        [("b1", ", ".join(item)), ("b2", "only four short words"), ("b3", None), ("b4", "?!")], "item_id string, text string"
    )
    found = {r["doc_id"]: (r["n_hit"], list(r["items"]), r["contaminated"]) for r in decontamination.contamination(given, bench).collect()}
    assert found == {
        1: (13, ["b1"], True), 2: (0, [], False), 3: (40, ["b1"], True), 4: (13, ["b1"], False), 5: (40, ["b1"], True),
        6: (4, ["b2"], True), 7: (0, [], False),
    }
    assert {r["doc_id"] for r in decontamination.decontaminate(given, bench).collect()} == {2, 4, 7}


EDGES = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (None, "a text without an id", "en", "a", 20), (None, None, None, None, None),
    (3, "the same row " * 30, "en", "a", 390), (3, "the same row " * 30, "en", "a", 390), (4, "the same row " * 30, None, "b", 390),
    (5, " \t\n\x0b ", "en", None, 5), (6, "\u00e9t\u00e9 \U0001f600 x@y.org +1 202 555 0123", "fr", "b", 30),
    (7, " ".join(f"w{k}" for k in range(60_000)), "en", "a", None), (8, "x" * 100_000, "en", "a", 100_000),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHING = ("n", "s", "d", "t", "h", "uid", "node", "host", "span", "low", "component_id", "text_key", "kept", "words")




APPLIED = {
    "secrets": lambda d, b: queries.secrets.scan(d),
    "packing": lambda d, b: packing.pack(d, packing.tokenizer_path()).where("start = 0"),
    "substrings": lambda d, b: substrings.deduplicate(d),
    "quality": lambda d, b: quality.assess(d),
    "decontamination": decontamination.contamination,
    "jaccard": lambda d, b: jaccard.join(d),
    "personal": lambda d, b: pii.find(d),
    "masking": lambda d, b: pii.redact(d),
    "scoring": lambda d, b: scoring.score(d),
}


@pytest.mark.parametrize("name", sorted(APPLIED))
def test_odd_rows_are_all_answered(spark, name):
    docs = spark.createDataFrame(EDGES, SCHEMA).withColumns({c: F.lit("clash") for c in CLASHING})
    bench = spark.createDataFrame([("i", "the same row the same", "x")], "item_id string, text string, span string")
    assert len(APPLIED[name](docs, bench).collect()) == len(EDGES)


@pytest.mark.parametrize("name", sorted(APPLIED))
def test_empty_tables(spark, name):
    docs = spark.createDataFrame([], SCHEMA)
    bench = spark.createDataFrame([], "item_id string, text string")
    assert APPLIED[name](docs, bench).collect() == []


def test_filters_keep_columns_and_rows(spark):
    docs = spark.createDataFrame(EDGES, SCHEMA).withColumns({c: F.lit("clash") for c in CLASHING})
    bench = spark.createDataFrame([], "item_id string, text string")
    kept = decontamination.decontaminate(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(EDGES)
    one = jaccard.keep_one(docs)
    assert one.columns == docs.columns and sorted(r["doc_id"] for r in one.where("doc_id in (3, 4)").collect()) == [3, 3]
    good = quality.keep(docs)
    assert good.columns == docs.columns and {r["doc_id"] for r in good.collect()} <= {3, 4, 7}


def test_odd_pages(spark):
    rows = [(1, "u", None), (2, "u", ""), (3, None, "<p>" + "word " * 50_000), (4, "u", "<p>a &amp; b</p></div><b>"), (4, "u", "<p>a &amp; b</p></div><b>")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("tags", F.lit(1))
    found = queries.extraction.extract(pages).collect()
    assert len(found) == 5 and [r["text"] for r in found if r["page_id"] < 3] == ["", ""]
    assert next(r["n_chars"] for r in found if r["page_id"] == 3) == 249_999


def test_reply_trees(spark):
    """The best leaf of a tree, control strings in texts, ties, nulls and long chains."""
    from tidemark.llm import chat

    rows = [
        (1, 1, None, "user", "</s>[INST] <|turn|> &lt; q", 0.0), (1, 2, 1, "assistant", "bad", 1.0), (1, 3, 1, "assistant", "good <|/turn|>\n", 2.0),
        (1, 4, 3, "user", "more", 0.0), (2, 1, None, "user", None, None), (2, 2, 1, "assistant", "a", 1.0), (2, 3, 1, "assistant", "b", 1.0),
    ]
    rows += [(3, k, k - 1 if k > 1 else None, "user", f"t{k}", 0.0) for k in range(1, 71)]
    messages = spark.createDataFrame(rows, "conv_id bigint, node bigint, parent bigint, role string, text string, score double")
    best = chat.format_branches(messages)
    found = {r["conv_id"]: (r["leaf"], [tuple(t) for t in r["turns"]]) for r in best.withColumn("turns", chat.read_turns(F.col("formatted"))).collect()}
    assert found[1] == (4, [("user", "</s>[INST] <|turn|> &lt; q"), ("assistant", "good <|/turn|>\n"), ("user", "more")])
    assert found[2] == (2, [("user", ""), ("assistant", "a")])
    assert found[3] == (70, [("user", f"t{k}") for k in range(1, 71)])
    assert chat.format_branches(messages.limit(0)).collect() == []
    assert chat.format_branches(messages, branches=5).where("conv_id = 1").count() == 2


def test_repeated_messages_count_once(spark):
    from tidemark.llm import chat

    rows = [(1, 1, None, "user", "q", 1.0), (1, 2, 1, "assistant", "a", 1.0), (1, 3, 1, "assistant", "b", 1.5), (1, None, 1, "user", "x", 9.0)]
    rows += [(1, 2, 1, "assistant", "a", 1.0)] * 3 + [(1, 1, None, "user", "q", 1.0), (1, 3, 1, "user", "b", 1.5)]
    rows += [(None, 5, 77, "user", "alone", None), (None, 5, 77, "user", "alone", None)]
    messages = spark.createDataFrame(rows, "conv_id bigint, node bigint, parent bigint, role string, text string, score double")
    messages = messages.withColumns({c: F.lit("clash") for c in ("n", "c", "to", "total", "place", "up", "leaf")})
    found = {
        (r["conv_id"], r["leaf"]): (r["branch_score"], [tuple(t) for t in r["turns"]])
        for r in chat.format_branches(messages, 5).withColumn("turns", chat.read_turns(F.col("formatted"))).collect()
    }
    assert found == {
        (1, 2): (2.0, [("user", "q"), ("assistant", "a")]), (1, 3): (2.5, [("user", "q"), ("assistant", "b")]),
        (None, 5): (0.0, [("user", "alone")]),
    }
    cycle = spark.createDataFrame([(1, 1, 2, "u", "t", 0.0), (1, 2, 1, "u", "t", 0.0)], "conv_id bigint, node bigint, parent bigint, role string, text string, score double")
    with pytest.raises(ValueError, match="cycle"):
        chat.format_branches(cycle).collect()


def test_pipeline(spark, sf_small, texts):
    """Every document of the result passed each stage by its plain definition, and none that did is missing."""
    import corpus_pipeline

    left = brute_quality(duckdb.sql(f"select doc_id, text, source from '{sf_small}/documents.parquet'").fetchall())
    left = {i: t for i, t in left.items() if brute_components(left)[i][1] == i} if len(left) < 40 else keep_first(left)
    items = duckdb.sql(f"select text from '{sf_small}/benchmark.parquet'").fetchall()
    left = {i: t for i, t in left.items() if not brute_contaminated(t, [x for x, in items])}
    found = defaultdict(int)
    for r in corpus_pipeline.run(spark, sf_small).collect():
        found[r["doc_id"]] += r["length"]
        assert r["length"] <= 2048
    assert set(found) == set(left)


def test_pipeline_of_odd_tables(spark, tmp_path):
    """Nulls, repeated rows, other columns with clashing names; then no rows at all."""
    import corpus_pipeline

    body = " ".join(f"word{k}x{k * k}" for k in range(120))
    rows = [*EDGES, (20, body, "en", "a", 1), (21, body + " more", "en", "a", 1), (20, body, "en", "a", 1), (None, body[::-1], None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in CLASHING})
    for name, given, ids in (("some", docs, {7, 20, None}), ("none", docs.limit(0), set())):
        path = str(tmp_path / name)
        given.write.parquet(f"{path}/documents.parquet")
        spark.createDataFrame([], "item_id string, text string").write.parquet(f"{path}/benchmark.parquet")
        left = given
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
            stage(spark, left, path).write.parquet(f"{path}/{k}")
            left = spark.read.parquet(f"{path}/{k}")
            assert left.columns == docs.columns
        assert {r["doc_id"] for r in left.collect()} == ids
        assert {r["doc_id"] for r in corpus_pipeline.run(spark, path).collect()} == ids


def brute_quality(rows):
    """doc_id to the text that is left, by the definition of the rules."""
    normal = lambda line: " ".join(re.sub("[0-9]+", "0", line.lower()).split())
    of_host, of_line = defaultdict(set), defaultdict(set)
    for _, t, host in rows:
        of_host[host].add(t or "")
        for line in (t or "").split("\n"):
            of_line[host, normal(line)].add(t or "")
    left = {}
    for i, t, host in rows:
        words = WORD.findall(t or "")
        lines = (t or "").split("\n")
        common = lambda x: normal(x) and len(of_line[host, normal(x)]) > max(20, 0.01 * len(of_host[host]))
        kept = [x for x in lines if not common(x)]
        enough = len(words) >= 50 and 100 * brute_repeats(words) <= 50 * len(words)
        if enough and sum(len(WORD.findall(x)) for x in kept) >= 0.3 * len(words):
            left[i] = "\n".join(kept)
    return left


def keep_first(texts):
    classes = brute_components(texts)
    return {i: t for i, t in texts.items() if classes[i][1] == i}


def letters(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute_contaminated(text, items):
    words, hit = letters(text), set()
    for item in map(letters, items):
        size = min(len(item), WINNOWED)
        windows = {tuple(item[k : k + size]) for k in range(len(item) - size + 1)} if item else set()
        for k in range(len(words) - size + 1):
            if tuple(words[k : k + size]) in windows:
                hit |= set(range(k, k + size))
    return len(hit) > 0 and 20 * len(hit) >= len(words)
