"""Packing token sequences into windows by minimum bin slack.

A document's ids are cut into whole windows and one remainder. The remainders' lengths are
counted, and windows are planned on these counts alone: for each window a dynamic programme over
subset sums, kept as one bit set, finds the multiset of remaining lengths that fills it best. The
plan is then repeated as often as the counts allow, so its size depends on the window length, not
on the number of documents. Documents find their place by their rank within their length.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.base import map_batches, ship, table
from tidemark.session import materialize

CAPACITY = 2048
END_ID = 1
#: Pieces of text whose ids a task remembers; the memory is emptied when it is full.
MEMO = 400_000

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"

_unsafe = re.compile(r"\s ")
_cut = re.compile(r"(?<=\S)(?= )")


#: Fixed value: how the byte-level form cuts a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves, the others for the characters from 256 on, in order.
    """
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


class Encoder:
    """Token ids of whole texts, with the ids of pieces between spaces remembered.

    The byte-level pattern never lets a token run from a character that is no white space into
    a following space, so a text may be cut there and its pieces encoded one by one. A text
    with a special token's string is encoded whole. Pieces met for the first time are encoded by
    ``tiktoken`` over the vocabulary of the same file, where ids are in the order of merges: the same
    ids as by ``tokenizers``, at a fifth of the time for short strings.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        byte_of = {c: b for b, c in byte_characters().items()}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in vocabulary.items() if token not in self.special}
        self.fast = tiktoken.Encoding("pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.memo: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if _unsafe.search(text):
            pieces = _cut.split(text)
        else:
            first, *rest = text.split(" ")
            pieces = [first, *[" " + p for p in rest]]
        memo = self.memo
        try:
            return b"".join([memo[p] for p in pieces])
        except KeyError:
            if len(memo) > MEMO:
                memo.clear()
            encode = self.fast.encode_ordinary
            for p in pieces:
                if p not in memo:
                    memo[p] = array("I", encode(p)).tobytes()
            return b"".join([memo[p] for p in pieces])


_encoders: dict[str, Encoder] = {}


def forget_pieces() -> None:
    for encoder in _encoders.values():
        encoder.memo = {}


def pieces_of(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Whole windows and one remainder of every document, with the checksum of their ids.

    A null text counts as empty: its only id is the end. Rows with a null or repeated doc_id
    are documents of their own.
    """
    end = np.array([END_ID], "<u4").tobytes()

    def cut(rows: dict) -> dict:
        encoder = _encoders.get(tokenizer_path)
        if encoder is None:
            encoder = _encoders[tokenizer_path] = Encoder(tokenizer_path)
        out = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")}
        for doc_id, text in zip(rows["doc_id"], rows["text"]):
            ids = encoder.encode(text or "") + end
            n = len(ids) // 4
            for start in range(0, n, capacity):
                part = ids[4 * start : 4 * (start + capacity)]
                out["doc_id"].append(doc_id)
                out["start"].append(start)
                out["length"].append(len(part) // 4)
                out["ids_crc32"].append(zlib.crc32(part))
                out["doc_tokens"].append(n)
        return out

    return map_batches(docs.select(F.col("doc_id").cast("bigint"), "text"), cut, PIECES, forget_pieces)


def best_fill(counts: Counter, capacity: int) -> Counter:
    """The multiset of available lengths whose sum is nearest to ``capacity`` from below.

    The largest length is taken first, as minimum bin slack does. Bit s of ``sums`` says that s
    can be reached; the bit set before each length is kept, and going back through them yields
    how often each length is used. Counts are split into powers of two, so a length costs a
    number of shifts that is logarithmic in its count.
    """
    largest = max(counts)
    room = capacity - largest
    chosen = Counter({largest: 1})
    rest = [(x, min(c - (x == largest), room // x)) for x, c in sorted(counts.items(), reverse=True) if x <= room]
    full, sums, steps = (1 << (room + 1)) - 1, 1, []
    for length, count in rest:
        bundle = 1
        while count > 0 and not sums >> room & 1:
            take = min(bundle, count)
            steps.append((sums, length, take))
            sums |= sums << length * take & full
            count -= take
            bundle *= 2
    left = sums.bit_length() - 1
    for before, length, take in reversed(steps):
        if not before >> left & 1:
            left -= length * take
            chosen[length] += take
    return chosen


def plan_windows(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Counter, int]]:
    """(multiset of lengths, number of windows filled so) until no length is left."""
    left, plan = Counter({k: v for k, v in counts.items() if v}), []
    while left:
        chosen = best_fill(left, capacity)
        times = min(left[x] // n for x, n in chosen.items())
        for x, n in chosen.items():
            left[x] -= n * times
            if not left[x]:
                del left[x]
        plan.append((chosen, times))
    return plan


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with its sequence and its offset there.

    The lengths counted on the driver are at most ``capacity`` numbers. Ranks within a length
    are taken in slices of that length, so that one length shared by most documents is spread.
    An empty table gives no rows.
    """
    spark = docs.sparkSession
    pieces = materialize(
        pieces_of(docs, tokenizer_path, capacity).withColumn("uid", F.monotonically_increasing_id()), "pieces"
    )
    rest = pieces.where(F.col("length") < capacity)
    slices = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rest = rest.withColumn("slice", F.pmod(F.xxhash64("uid"), F.lit(slices)))
    per_slice = rest.groupBy("length", "slice").agg(F.count("*").alias("n"))
    counts = {r[0]: r[1] for r in per_slice.groupBy("length").agg(F.sum("n")).collect()}
    plan = plan_windows(counts, capacity)

    # For each length: the ranks from which on a plan holds, and what it says.
    places: dict[int, list[tuple]] = {}
    used: Counter = Counter()
    sequence = 0
    for chosen, times in plan:
        offset = 0
        for length in sorted(chosen, reverse=True):
            n = chosen[length]
            places.setdefault(length, []).append((used[length], sequence, n, offset))
            used[length] += n * times
            offset += n * length
        sequence += times
    ranges = {x: np.array(p, np.int64).T for x, p in places.items()}

    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_slice.select("length", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = rest.withColumn(
        "in_slice", F.row_number().over(Window.partitionBy("length", "slice").orderBy("uid")) - 1
    ).join(starts, ["length", "slice"])
    ranked = ranked.select(*PIECE_COLUMNS, (F.col("before") + F.col("in_slice")).alias("rank"))

    def place(rows: dict) -> dict:
        length, rank = np.array(rows["length"], np.int64), np.array(rows["rank"], np.int64)
        seq, off = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        for x in np.unique(length):
            at = np.flatnonzero(length == x)
            first, base, n, offset = ranges[int(x)]
            k = np.searchsorted(first, rank[at], "right") - 1
            inside = rank[at] - first[k]
            seq[at] = base[k] + inside // n[k]
            off[at] = offset[k] + inside % n[k] * x
        return {**{c: rows[c] for c in PIECE_COLUMNS}, "sequence_id": seq, "offset": off}

    placed = map_batches(ranked, place, f"{PIECES}, sequence_id bigint, offset bigint")
    whole = pieces.where(F.col("length") == capacity).select(
        *PIECE_COLUMNS, (F.lit(sequence) + F.col("uid")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
    return whole.unionByName(placed)


PIECE_COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return pack(table(spark, sf_dir, "documents"), tokenizer_path())
