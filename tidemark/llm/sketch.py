"""Count-min sketches that tell which hashes may occur more than once.

Counters stop at two, so a sketch answers only "at most once" (certain) or "perhaps more". Each
task sketches the hashes of its own partition, as sorted lists of the counters they touch; the
partition sketches are merged block by block. Merged, one bit for each counter is left.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import mixed, ship
from tidemark.session import materialize

#: Rows of counters, and counters in each row for each expected hash.
DEPTH = 2
WIDTH_FACTOR = 4
#: At most so many counters in a row. It bounds what is sent to the executors: 64 MiB for each
#: row. Beyond it more hashes pass for repeated; none that is repeated is ever missed.
MAX_WIDTH = 1 << 29
BLOCK = 1 << 21
#: Hashes a task sketches at a time.
BUFFER = 1_000_000

SEEDS = np.array([0x8CB92BA72F3D8DD7, 0xD6E8FEB86659FD93], np.uint64)


def width_for(expected: int) -> int:
    return min(MAX_WIDTH, max(BLOCK, 1 << int(expected * WIDTH_FACTOR - 1).bit_length()))


def counters(hashes: np.ndarray, row: int, width: int) -> np.ndarray:
    return (mixed(hashes ^ SEEDS[row]) & np.uint64(width - 1)).astype(np.int64)


def packed(cells: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(block, counters touched in it, each with whether more than once), sorted and compressed."""
    cells = np.sort(cells)
    first = np.ones(len(cells), bool)
    first[1:] = cells[1:] != cells[:-1]
    starts = np.flatnonzero(first)
    cells, twice = cells[starts], np.diff(np.append(starts, len(first))) > 1
    ends = np.searchsorted(cells, np.arange(0, cells[-1] + BLOCK + 1, BLOCK)) if len(cells) else np.array([0])
    for block, (a, b) in enumerate(zip(ends, ends[1:])):
        if b > a:
            gaps = np.diff(cells[a:b] - block * BLOCK, prepend=0).astype("<u4")
            code = gaps << np.uint32(1) | twice[a:b].astype("<u4")
            planes = code.view(np.uint8).reshape(-1, 4).T
            yield block, zlib.compress(np.ascontiguousarray(planes).tobytes(), 1)


def unpacked(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zlib.decompress(payload), np.uint8).reshape(4, -1)
    code = np.ascontiguousarray(planes.T).reshape(-1).view("<u4")
    return np.cumsum(code >> np.uint32(1), dtype=np.int64), (code & np.uint32(1)).astype(np.uint8) + np.uint8(1)


MERGED = pa.schema([("row", pa.int32()), ("block", pa.int32()), ("bits", pa.binary())])


def merge(batches):
    """Counters of each block over all partitions, as bits that say which reached two.

    The payloads of a block follow each other and are added up one by one, so memory does not
    grow with their number.
    """

    def merged(key, counts):
        bits = zlib.compress(np.packbits(counts == 2, bitorder="little").tobytes(), 1)
        return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((*key, bits), MERGED)], schema=MERGED)

    key, counts = None, None
    for batch in batches:
        for row, block, payload in zip(*batch.columns):
            here = row.as_py(), block.as_py()
            if here != key:
                if key is not None:
                    yield merged(key, counts)
                key, counts = here, np.zeros(BLOCK, np.uint8)
            at, times = unpacked(payload.as_py())
            counts[at] = np.minimum(counts[at] + times, 2)
    if key is not None:
        yield merged(key, counts)


class Repeated:
    """The merged sketch: which of these hashes were perhaps counted more than once?"""

    def __init__(self, blocks: dict[tuple[int, int], bytes], width: int):
        self.blocks, self.width, self.rows = blocks, width, None

    def __getstate__(self):
        """Travels compressed; a worker unpacks it once."""
        return {"blocks": self.blocks, "width": self.width, "rows": None}

    def unpack(self) -> None:
        self.rows = [np.zeros(self.width // 8, np.uint8) for _ in range(DEPTH)]
        for (row, block), payload in self.blocks.items():
            bits = np.frombuffer(zlib.decompress(payload), np.uint8)
            self.rows[row][block * BLOCK // 8 :][: len(bits)] = bits
        self.blocks = {}

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        if self.rows is None:
            self.unpack()
        found = np.ones(len(hashes), bool)
        for row, bits in enumerate(self.rows):
            cell = counters(hashes, row, self.width)
            found &= (bits[cell >> 3] >> (cell & 7).astype(np.uint8) & 1).astype(bool)
        return found


def repeated(docs: DataFrame, hashes: Callable[[str], np.ndarray], expected: int) -> Broadcast:
    """A broadcast ``Repeated`` of ``hashes(text)`` over all rows; its size is bounded, see MAX_WIDTH."""
    spark = docs.sparkSession
    ship(spark)
    width = width_for(expected)

    def flush(buffer: list[np.ndarray]) -> pa.RecordBatch:
        every = np.concatenate(buffer)
        rows = [(row, block, payload) for row in range(DEPTH) for block, payload in packed(counters(every, row, width))]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())],
            names=["row", "block", "payload"],
        )

    def sketch(batches):
        buffer, size = [], 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                h = hashes(text)
                buffer.append(h)
                size += len(h)
                if size >= BUFFER:
                    yield flush(buffer)
                    buffer, size = [], 0
        if size:
            yield flush(buffer)

    parts = docs.select("text").mapInArrow(sketch, "row int, block int, payload binary")
    in_order = parts.repartition("row", "block").sortWithinPartitions("row", "block")
    # Written by all tasks, then read in few partitions: an iterator runs a job for each.
    merged = materialize(in_order.mapInArrow(merge, "row int, block int, bits binary"), "sketch")
    blocks = {(r["row"], r["block"]): bytes(r["bits"]) for r in merged.toLocalIterator()}
    return spark.sparkContext.broadcast(Repeated(blocks, width))


def expected_words(docs: DataFrame) -> int:
    """A rough number of words, for the size of a sketch: one in six characters."""
    return int(docs.agg(F.sum(F.length("text"))).first()[0] or 0) // 6
