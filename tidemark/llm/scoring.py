"""Language-model scoring with a weighted backoff automaton.

Documents are read once, in chunks with a dictionary each. Every word and every n-gram of the
training documents counts, however rare. Size by size, a chunk deals its distinct n-grams, as sorted
hashes, to shards of the hash range; a shard sums them over the chunks and answers each chunk in the
order it asked. An n-gram one of whose shorter ones is in no other chunk is in no other either, so its
number is known where it is. Neither texts, the vocabulary nor n-grams are broadcast or gathered.

The smoothed n-grams are the arcs of an automaton whose states are contexts. A failure arc leads to
the next shorter context and carries the backoff weight that makes the probabilities of all words
sum to one. A chunk has the arcs its texts can take from the answers and traverses them; the weights of
the failure arcs it took are sums over a context's whole set of arcs, formed by key and joined.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.base import ROLL_A, ROWS, lower_words_of, mixed, ship, table, word_hashes
from tidemark.session import materialize, work_dir, written
from tidemark.streaming.files import SharedFolder

END = np.uint64(0x5EED0F7E87C0FFEE)
START = np.uint64(0x0B5E55EDC0DEBA5E)
ORDER = 3
DISCOUNT = 0.6
#: Words in a chunk; a chunk is what one group holds in memory.
CHUNK_WORDS = 600_000
#: Tokens of all texts for each shard, which holds no more entries than that, as a rule.
SHARD_TOKENS = 1_200_000
#: Bits of a document's place in its chunk, which holds ``CHUNK_WORDS`` documents at most.
PLACE_BITS = 21

CHUNKS = (
    "chunk bigint, tokens bigint, train_tokens bigint, train_docs bigint, doc_ids array<bigint>, unnamed array<boolean>, "
    "held array<boolean>, lengths array<int>, ids binary, words binary, n binary"
)
ASKED = "shard bigint, chunk bigint, keys binary, n binary"
ANSWERS = "chunk bigint, shard bigint, kinds bigint, found binary"


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 1 modulo 5; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 1


def squeeze(numbers: np.ndarray) -> bytes:
    """Unsigned 64-bit numbers by byte planes: those of small numbers are nearly all zeros."""
    planes = np.ascontiguousarray(numbers.astype("<u8", copy=False)).view(np.uint8).reshape(-1, 8).T
    return zlib.compress(np.ascontiguousarray(planes).tobytes(), 1)


def spread(payload: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(payload), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u8")


def number(train: np.ndarray, held: np.ndarray) -> np.ndarray:
    """The number in training documents, doubled, plus one for any in a document held out."""
    return 2 * train.astype(np.int64) + (held > 0)


def chunks_of(docs: DataFrame) -> DataFrame:
    """One row for each chunk: its documents' ids and lengths, their words by number in its dictionary, and that.

    Frequent words come first in the dictionary, so that numbers are small, by classes of their number:
    within one the hashes ascend, so that what is between them is small, too.
    """
    schema = pa.schema(
        [("chunk", pa.int64()), ("tokens", pa.int64()), ("train_tokens", pa.int64()), ("train_docs", pa.int64()),
         ("doc_ids", pa.list_(pa.int64())), ("unnamed", pa.list_(pa.bool_())), ("held", pa.list_(pa.bool_())),
         ("lengths", pa.list_(pa.int32())), ("ids", pa.binary()), ("words", pa.binary()), ("n", pa.binary())]
    )

    def emit(chunk, rows, hashes):
        lengths = np.array([len(h) for h in hashes], np.int32)
        held = np.array([r[1] for r in rows], bool)
        codes, words = pd.factorize(np.concatenate(hashes))
        out = np.repeat(held, lengths)
        train, held_n = (np.bincount(codes[x], minlength=len(words)) for x in (~out, out))
        order = np.lexsort((words, -np.frexp(train + held_n)[1]))
        rank = np.empty(len(words), np.int64)
        rank[order] = np.arange(len(words))
        return pa.RecordBatch.from_pydict(
            {"chunk": [chunk], "tokens": [len(codes)], "train_tokens": [int(train.sum())], "train_docs": [int((~held).sum())],
             "doc_ids": [[0 if r[0] is None else r[0] for r in rows]], "unnamed": [[r[0] is None for r in rows]],
             "held": [held], "lengths": [lengths], "ids": [squeeze(rank[codes])], "words": [squeeze(np.diff(words[order], prepend=np.uint64(0)))],
             "n": [squeeze(number(train, held_n)[order])]}, schema
        )

    def run(batches):
        chunk = TaskContext.get().partitionId() << 24
        rows, hashes, size = [], [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                for doc_id, held, text in zip(*(part.column(k).to_pylist() for k in range(3))):
                    h = np.append(word_hashes(lower_words_of(text)), END)
                    rows.append((doc_id, held))
                    hashes.append(h)
                    size += len(h)
                    if size >= CHUNK_WORDS:
                        yield emit(chunk, rows, hashes)
                        chunk, rows, hashes, size = chunk + 1, [], [], 0
        if rows:
            yield emit(chunk, rows, hashes)

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, CHUNKS)


class Texts:
    """The words of a chunk's documents, one after the other, each document behind a start of its own."""

    def __init__(self, row) -> None:
        lengths = np.asarray(row["lengths"], np.int64)
        n = lengths.sum() + len(lengths)
        self.first = np.cumsum(lengths + 1) - lengths - 1
        self.doc = np.repeat(np.arange(len(lengths)), lengths + 1)
        self.place = np.arange(n) - self.first[self.doc]
        self.words = np.empty(n, np.uint64)
        self.words[self.first] = START
        words = np.cumsum(spread(row["words"]), dtype=np.uint64)
        self.words[self.place > 0] = words[spread(row["ids"]).astype(np.int64)]
        self.held = np.asarray(row["held"], bool)[self.doc]

    def grams(self, order: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(size, ends, keys) of the n-grams of each size; only their first word may be a start.

        A size's keys are hashes that tell sizes apart; words have theirs at every place, starts included.
        """
        rolled = self.words
        yield 1, np.flatnonzero(self.place > 0), mixed(rolled + np.uint64(1))
        for size in range(2, order + 1):
            longer = np.zeros_like(rolled)
            longer[1:] = rolled[:-1] * ROLL_A + self.words[1:]
            rolled = longer
            yield size, np.flatnonzero(self.place >= size - 1), mixed(rolled + np.uint64(size))


class Distinct:
    """The distinct keys in ascending order, with the first place and the group of each place."""

    def __init__(self, keys: np.ndarray) -> None:
        self.order = np.argsort(keys, kind="stable")
        ordered = keys[self.order]
        new = np.append(True, ordered[1:] != ordered[:-1])[: len(ordered)]
        self.starts = np.flatnonzero(new)
        self.keys = ordered[self.starts]
        self.group = np.empty(len(keys), np.int64)
        self.group[self.order] = np.cumsum(new) - 1

    @property
    def examples(self) -> np.ndarray:
        return self.order[self.starts]

    def sums(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values[self.order], self.starts) if len(self.starts) else values[:0]


def asked_of_shards(chunk: int, size: int, keys: np.ndarray, n: np.ndarray, shards: int) -> dict:
    """Rows for the shards: of the ascending ``keys`` the stretch that is theirs, and its numbers."""
    shard = (keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)
    cuts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])[: len(shard)])
    spans = [slice(a, b) for a, b in zip(cuts, [*cuts[1:], len(shard)])]
    return {
        "shard": [size << 32 | int(shard[s.start]) for s in spans], "chunk": [chunk] * len(spans),
        "keys": [squeeze(np.diff(keys[s], prepend=np.uint64(0))) for s in spans], "n": [squeeze(n[s]) for s in spans],
    }


def ask_for_words(chunks: DataFrame, shards: int) -> DataFrame:
    """The words of the dictionaries, for the shards."""
    schema = pa.schema([("shard", pa.int64()), ("chunk", pa.int64()), ("keys", pa.binary()), ("n", pa.binary())])

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                chunk, words, n = (batch.column(c)[k].as_py() for c in range(3))
                keys = mixed(np.cumsum(spread(words), dtype=np.uint64) + np.uint64(1))
                order = np.argsort(keys)
                yield pa.RecordBatch.from_pydict(asked_of_shards(chunk, 1, keys[order], spread(n)[order], shards), schema)

    return chunks.select("chunk", "words", "n").mapInArrow(run, ASKED)


def summed(rows: pd.DataFrame) -> pd.DataFrame:
    """A shard's answers, in the order its chunks asked.

    Of each n-gram the number in all training documents, times eight; plus four if several chunks
    have it, plus two for the one chunk that speaks for it, plus one if any document held out has
    it. ``kinds`` are those a chunk speaks for.
    """
    keys = [np.cumsum(spread(p), dtype=np.uint64) for p in rows["keys"]]
    n = np.concatenate([spread(p) for p in rows["n"]]).astype(np.int64)
    found = Distinct(np.concatenate(keys))
    train, held = found.sums(n >> 1), found.sums(n & 1) > 0
    several = np.diff(found.starts, append=len(n)) > 1
    trained = found.order[n[found.order] > 1]
    group = found.group[trained]
    speaks = np.zeros(len(n), np.int64)
    speaks[trained[np.append(True, group[1:] != group[:-1])[: len(group)]]] = 1
    answers = (train << 3 | several << 2 | held)[found.group] | speaks << 1
    ends = np.cumsum([len(k) for k in keys])[:-1]
    return pd.DataFrame(
        {"chunk": rows["chunk"], "shard": rows["shard"], "kinds": [int(x.sum()) for x in np.split(speaks, ends)],
         "found": [squeeze(x) for x in np.split(answers, ends)]}
    )


def by_size(answers: pd.DataFrame) -> dict[int, np.ndarray]:
    """A chunk's answers, put together from its shards."""
    out: dict[int, list] = {}
    for shard, payload in sorted(zip(answers["shard"], answers["found"])):
        out.setdefault(int(shard) >> 32, []).append(spread(payload))
    return {size: np.concatenate(parts).astype(np.int64) for size, parts in out.items()}


@dataclass
class Level:
    """The n-grams of one size in a chunk: by place their keys and numbers in all training documents; and what they are worth."""

    keys: np.ndarray
    count: np.ndarray
    #: What is added to a number where it is that of a context.
    more: np.ndarray
    #: By place whether several chunks have the n-gram, and whether a document held out has it.
    several: np.ndarray
    asked: np.ndarray
    #: A place of each of the n-grams that this chunk speaks for.
    mine: np.ndarray
    p: np.ndarray | None = None


def levels(texts: Texts, answers: dict[int, np.ndarray], train_docs: int, order: int) -> Iterator[Level | tuple[int, np.ndarray, np.ndarray]]:
    """The chunk's n-grams size by size; at the first size without an answer, what to ask: (size, keys, numbers)."""
    n, last = len(texts.words), None
    for size, ends, keys in texts.grams(order):
        found = Distinct(keys[ends])
        held = texts.held[ends].astype(np.int64)
        train, held = found.sums(1 - held), found.sums(held) > 0
        places = ends[found.examples]
        sent = np.ones(len(places), bool) if last is None else last.several[places] & last.several[places - 1]
        if size not in answers and sent.any():
            yield size, found.keys[sent], number(train, held)[sent]
            return
        answer = (train << 3) | np.where(train > 0, 2, 0) | held
        if sent.any():
            answer[sent] = answers[size]
        at = np.zeros(n, np.int64)
        at[ends] = answer[found.group]
        if size == 1:
            # A start comes before every document.
            at[texts.first] = train_docs << 3 | 5
        more = np.where(texts.place > 0, 0.5, 0.0) if size == 1 else np.zeros(n)
        last = Level(keys, at >> 3, more, (at & 4) > 0, (at & 1) > 0, places[(answer & 2) > 0])
        yield last


@dataclass
class Totals:
    tokens: int
    kinds: int
    train_docs: int

    @property
    def base(self) -> float:
        return self.tokens + 0.5 * (self.kinds + 1)

    @property
    def words(self) -> float:
        """Without training documents the end is a word of its own beside the unknown one."""
        return self.base + (0.0 if self.train_docs else 0.5)


TRAVERSED = (
    "uid array<bigint>, doc_ids array<bigint>, unnamed array<boolean>, held array<boolean>, n_tokens array<bigint>, n_known array<bigint>, "
    "base_score array<double>, score array<double>, failed array<bigint>, failed_key array<bigint>, key array<bigint>, kinds array<bigint>, "
    "n array<bigint>, more array<double>, shorter array<double>"
)


def traverse(row, answers: pd.DataFrame, totals: Totals, order: int) -> dict:
    """A chunk's documents with the weight of their arcs, the failure arcs they took, and its share in the weights of those.

    Training documents never fail, since they made the arcs; so only contexts that a document held out
    has need a failure weight. The chunk gives the arcs of these contexts that it speaks for.
    """
    texts = Texts(row)
    found: list[Level] = []
    shares = []
    for level in levels(texts, by_size(answers), totals.train_docs, order):
        if not found:
            level.p = (level.count + 0.5) / totals.words
        else:
            context = found[-1]
            level.p = np.zeros(len(level.count))
            at = np.flatnonzero(level.count > 0)
            level.p[at] = (level.count[at] - DISCOUNT) / (context.count + context.more)[at - 1]
            mine = level.mine[context.asked[level.mine - 1]]
            by = Distinct(context.keys[mine - 1])
            shares.append(
                (by.keys.view(np.int64), by.sums(np.ones(len(mine), np.int64)), by.sums(level.count[mine]),
                 context.more[mine - 1][by.examples], by.sums(context.p[mine]))
            )
        found.append(level)
    words = found[0]
    inside = texts.place > 0
    weight = np.where(inside, np.log10(words.p), 0.0)
    base = np.where(inside, np.log10((words.count + 0.5) / totals.base), 0.0)
    failed, open_ = [], inside.copy()
    for size in range(order, 1, -1):
        level, context = found[size - 1], found[size - 2]
        at = np.flatnonzero(open_ & (texts.place >= size - 1))
        arc = at[level.count[at] > 0]
        weight[arc] = np.log10(level.p[arc])
        open_[arc] = False
        missed = at[level.count[at] == 0]
        failed.append(missed[context.count[missed - 1] > 0])
    uid = (int(row["chunk"]) << PLACE_BITS) + np.arange(len(texts.first))
    keys = [found[size - 2].keys[at - 1] for size, at in zip(range(order, 1, -1), failed)]
    columns = [np.concatenate(parts) for parts in zip(*shares)] if shares else [np.empty(0, np.int64)] * 5
    return {
        "uid": uid, "doc_ids": row["doc_ids"], "unnamed": row["unnamed"], "held": row["held"], "n_tokens": row["lengths"],
        "n_known": np.add.reduceat(inside & (words.count > 0), texts.first, dtype=np.int64),
        "base_score": np.add.reduceat(base, texts.first), "score": np.add.reduceat(weight, texts.first),
        "failed": uid[texts.doc[np.concatenate(failed)]] if failed else uid[:0],
        "failed_key": np.concatenate(keys).view(np.int64) if failed else uid[:0],
        **dict(zip(("key", "kinds", "n", "more", "shorter"), columns)),
    }


def score(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """Base score and model score of every row, learned from those that are not held out.

    A null text is empty: its only token is the end. Without training documents all scores rest on
    the smoothing alone. Rows of the same doc_id are documents of their own.
    """
    ship(docs.sparkSession)
    given = docs.select(F.col("doc_id").cast("bigint"), "text").withColumn("held_out", held_out(F.col("doc_id")))
    folder = SharedFolder(docs.sparkSession, work_dir(docs.sparkSession, "scoring"))
    chunks = written(chunks_of(given), f"{folder.path}/chunks")
    sums = [F.coalesce(F.sum(c), F.lit(0)) for c in ("tokens", "train_tokens", "train_docs")]
    tokens, train_tokens, train_docs = chunks.agg(*sums).first()
    shards = 1 + tokens // SHARD_TOKENS

    def answered(asked: DataFrame) -> DataFrame:
        return asked.groupBy("shard").applyInPandas(summed, ANSWERS)

    answers = written(answered(ask_for_words(chunks, shards)), f"{folder.path}/answers-1")
    kinds = answers.agg(F.coalesce(F.sum("kinds"), F.lit(0))).first()[0]
    totals = Totals(int(train_tokens), int(kinds), int(train_docs))

    def ask(chunk: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        *_, last = levels(Texts(chunk.iloc[0]), by_size(answers), totals.train_docs, order)
        wanted = (last[0], last[1], last[2]) if isinstance(last, tuple) else (0, np.empty(0, np.uint64), np.empty(0, np.int64))
        return pd.DataFrame(asked_of_shards(int(chunk["chunk"].iloc[0]), *wanted, shards))

    def run(chunk: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([traverse(chunk.iloc[0], answers, totals, order)])

    texts = chunks.select("chunk", "doc_ids", "unnamed", "held", "lengths", "ids", "words")

    def with_answers(function, schema: str) -> DataFrame:
        return texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(function, schema)

    for size in range(2, order + 1):
        # Written size by size: what a size has shuffled is gone before the next one asks.
        answers = answers.unionByName(written(answered(with_answers(ask, ASKED)), f"{folder.path}/answers-{size}"))
    traversed = materialize(with_answers(run, TRAVERSED), "traversed")
    # Texts and answers have done their part; what follows reads the traversed documents alone.
    folder.delete("")

    shares = traversed.select(F.inline(F.arrays_zip("key", "kinds", "n", "more", "shorter")))
    context = shares.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("kinds", "n", "shorter")], F.max("more").alias("more"))
    left = (F.col("more") + DISCOUNT * F.col("kinds")) / (F.col("n") + F.col("more"))
    least = F.lit(1e-12)
    weights = context.select("key", F.log10(F.greatest(least, left) / F.greatest(least, 1 - F.col("shorter"))).alias("weight"))
    failures = traversed.select(F.inline(F.arrays_zip("failed", F.col("failed_key").alias("key"))))
    failed = failures.join(weights, "key").groupBy("failed").agg(F.sum("weight").alias("weight"))
    columns = ("uid", "doc_ids", "unnamed", "held", "n_tokens", "n_known", "base_score", "score")
    scored = traversed.select(F.inline(F.arrays_zip(*columns)))
    return scored.join(failed, scored["uid"] == failed["failed"], "left").select(
        F.when(~F.col("unnamed"), F.col("doc_ids")).alias("doc_id"),
        F.col("held").alias("held_out"), "n_tokens", "n_known", F.lit(totals.tokens).cast("bigint").alias("train_tokens"),
        "base_score", (F.col("score") + F.coalesce("weight", F.lit(0.0))).alias("score"),
    )


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
