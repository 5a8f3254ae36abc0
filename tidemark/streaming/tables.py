"""Parquet tables a stream writes batch by batch: replay-safe, compacted, under one manifest.

What belongs to a table is what its newest manifest names, a small file that appears whole or not
at all. Data that a crash left behind is never read. The folders of old batches are merged in
steps of ``fanout``, so a table of n batches has some ``fanout * log(n)`` folders.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.streaming.files import SharedFolder

# Folders that are merged into one, and bytes of a merged file.
FANOUT = 16
FILE_BYTES = 128 << 20
# Versions of the manifest that are kept, with the data they name, for readers that began with them.
KEPT_VERSIONS = 4
# Batches whose notes are kept: a repeated batch looks up the one before it.
KEPT_NOTES = 3


@dataclass(frozen=True)
class Entry:
    """A folder of the table with the rows of the batches from ``first`` to ``last``."""

    folder: str
    first: int
    last: int
    level: int = 0


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    entries: tuple[Entry, ...] = ()
    # Rows that hold until the next batch is written, and the batch they follow.
    provisional: Entry | None = None
    horizon: int | None = None
    # What the newest batches noted beside their rows: (batch, value).
    notes: tuple[tuple[int, int | None], ...] = ()
    # Folders no longer named, with the version that dropped them.
    retired: tuple[tuple[str, int], ...] = ()

    @property
    def last(self) -> int:
        return max((e.last for e in self.entries), default=-1)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> Manifest:
        raw = json.loads(text)
        return cls(
            raw["version"],
            tuple(Entry(**e) for e in raw["entries"]),
            Entry(**raw["provisional"]) if raw["provisional"] else None,
            raw["horizon"],
            tuple((b, v) for b, v in raw["notes"]),
            tuple((f, v) for f, v in raw["retired"]),
        )


def due_for_merging(entries: Iterable[Entry], fanout: int) -> tuple[Entry, ...]:
    """The oldest ``fanout`` adjacent entries of one level; none if no level has as many.

    The newest batch is left alone: it is the one a restarted stream may write again.
    """
    run: list[Entry] = []
    for entry in sorted(entries, key=lambda e: e.first)[:-1]:
        run = [*run, entry] if run and run[-1].level == entry.level else [entry]
        if len(run) == fanout:
            return tuple(run)
    return ()


class BatchTable:
    """Rows with the ``batch_id`` that brought them. Writing a batch again replaces what it wrote before.

    Batches come one after the other; a number left out is an error, since its rows would be
    missing without a trace. ``keep`` limits the table to the newest batches.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: StructType, fanout: int = FANOUT, keep: int | None = None
    ) -> None:
        if fanout < 2:
            raise ValueError("fanout must be at least 2")
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.fanout = fanout
        self.keep = keep
        self._folder = SharedFolder(spark, self.path)

    # The manifest.

    def manifest(self) -> Manifest:
        versions = self._versions()
        return Manifest.from_json(self._folder.read(f"manifest/{versions[-1]:012d}")) if versions else Manifest()

    def _versions(self) -> list[int]:
        return sorted(int(n) for n in self._folder.names("manifest") if n.isdigit())

    def _commit(self, old: Manifest, new: Manifest) -> Manifest:
        """Make ``new`` the table, unless someone else has changed it since ``old``."""
        version = old.version + 1
        named = {e.folder for e in new.entries} | ({new.provisional.folder} if new.provisional else set())
        before = {e.folder for e in old.entries} | ({old.provisional.folder} if old.provisional else set())
        retired = [*old.retired, *((f, version) for f in sorted(before - named))]
        gone = [f for f, dropped in retired if dropped <= version - KEPT_VERSIONS]
        new = replace(new, version=version, retired=tuple(r for r in retired if r[0] not in gone))
        self._folder.create(f"manifest/{version:012d}", new.to_json())
        for folder in gone:
            self._folder.delete(folder)
        for old_version in self._versions():
            if old_version <= version - KEPT_VERSIONS:
                self._folder.delete(f"manifest/{old_version:012d}")
        return new

    # Writing.

    def _store(self, rows: DataFrame, name: str) -> str:
        folder = f"data/{name}-{uuid.uuid4().hex}"
        rows.select(*self.schema.fieldNames(), "batch_id").write.parquet(f"{self.path}/{folder}")
        return folder

    def write(self, rows: DataFrame, batch_id: int, note: int | None = None) -> None:
        """Make ``rows`` those of the batch. A ``note`` becomes visible together with them."""
        now = self.manifest()
        if batch_id > now.last + 1:
            raise ValueError(f"{self.path}: batch {batch_id} comes after {now.last}, those between are missing")
        written = [e for e in now.entries if e.first <= batch_id <= e.last]
        if any(e.level for e in written):
            raise ValueError(f"{self.path}: batch {batch_id} has been merged with others and cannot be replaced")
        folder = self._store(rows.withColumn("batch_id", F.lit(batch_id).cast("bigint")), f"{batch_id:09d}")
        entries = [e for e in now.entries if e not in written] + [Entry(folder, batch_id, batch_id)]
        if self.keep is not None:
            entries = [e for e in entries if e.last > max(now.last, batch_id) - self.keep]
        entries.sort(key=lambda e: e.first)
        notes = (*(n for n in now.notes if batch_id - KEPT_NOTES < n[0] < batch_id), (batch_id, note))
        # Provisional rows held until this batch.
        now = self._commit(now, replace(now, entries=tuple(entries), notes=notes, provisional=None))
        while merging := due_for_merging(now.entries, self.fanout):
            now = self._merge(now, merging)

    def write_provisional(self, rows: DataFrame, after: int) -> None:
        """Rows that belong to the table until batch ``after + 1`` is written; earlier ones are replaced."""
        now = self.manifest()
        if now.last != after:
            raise ValueError(f"{self.path}: the table ends with batch {now.last}, not {after}")
        folder = self._store(rows.withColumn("batch_id", F.lit(after + 1).cast("bigint")), "provisional")
        self._commit(now, replace(now, provisional=Entry(folder, after + 1, after + 1)))

    def _merge(self, now: Manifest, merging: tuple[Entry, ...]) -> Manifest:
        size = sum(self._folder.size(e.folder) for e in merging)
        rows = self._merged(self._load(merging), now.horizon).coalesce(1 + size // FILE_BYTES)
        first, last = merging[0].first, merging[-1].last
        whole = Entry(self._store(rows, f"{first:09d}-{last:09d}"), first, last, merging[0].level + 1)
        kept = [e for e in now.entries if e not in merging]
        return self._commit(now, replace(now, entries=tuple(sorted([*kept, whole], key=lambda e: e.first))))

    def _merged(self, rows: DataFrame, horizon: int | None) -> DataFrame:
        return rows

    def vacuum(self) -> list[str]:
        """Delete data that no kept manifest names, left by a crash. Not while the stream runs."""
        now = self.manifest()
        named = {e.folder for e in now.entries} | {f for f, _ in now.retired}
        named |= {now.provisional.folder} if now.provisional else set()
        orphans = [n for n in (f"data/{n}" for n in self._folder.names("data")) if n not in named]
        for folder in orphans:
            self._folder.delete(folder)
        return orphans

    # Reading.

    def note(self, batch_id: int) -> int | None:
        """What a batch noted; an error if it is not among the newest."""
        notes = dict(self.manifest().notes)
        if batch_id not in notes:
            raise ValueError(f"{self.path}: batch {batch_id} is missing, there are {sorted(notes)}")
        return notes[batch_id]

    def _load(self, entries: Iterable[Entry]) -> DataFrame:
        with_batch = StructType([*self.schema.fields, StructField("batch_id", LongType())])
        folders = [f"{self.path}/{e.folder}" for e in entries]
        if not folders:
            return self.spark.createDataFrame([], with_batch)
        return self.spark.read.schema(with_batch).parquet(*folders)

    def _all(self) -> tuple[DataFrame, int | None]:
        now = self.manifest()
        return self._load([*now.entries, *([now.provisional] if now.provisional else [])]), now.horizon

    def read(self) -> DataFrame:
        """All rows, with ``batch_id``."""
        return self._all()[0]

    def read_before(self, batch_id: int) -> DataFrame:
        """The rows of all earlier batches, whether or not this one has been written before."""
        return self._load(e for e in self.manifest().entries if e.last < batch_id)

    def read_batches(self, batch_ids: Iterable[int]) -> DataFrame:
        """The rows of these batches, as far as they exist; folders of others are not even listed."""
        wanted = sorted(set(batch_ids))
        found = [e for e in self.manifest().entries if any(e.first <= i <= e.last for i in wanted)]
        return self._load(found).where(F.col("batch_id").isin(wanted))


@dataclass(frozen=True)
class Keys:
    """Key columns, and how the other columns of a key are combined: ``sum``, ``max`` or ``last``."""

    key: tuple[str, ...]
    combine: dict[str, str] = field(default_factory=dict)
    # A column of event time in the key; rows at or below the table's horizon are dropped.
    expires: str | None = None


class KeyedTable(BatchTable):
    """One row for each key, built from what batches add to it.

    Merging folders combines the rows of a key, so the table grows with its keys, not with the
    batches that touched them. Keys that can no longer change are dropped by raising the horizon.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: Keys, fanout: int = FANOUT) -> None:
        super().__init__(spark, path, schema, fanout)
        self.keys = keys

    def _merged(self, rows: DataFrame, horizon: int | None) -> DataFrame:
        if horizon is not None and self.keys.expires is not None:
            rows = rows.where(F.col(self.keys.expires) > horizon)
        how = {"sum": F.sum, "max": F.max, "last": lambda c: F.max_by(c, "batch_id")}
        columns = [how[way](name).alias(name) for name, way in self.keys.combine.items()]
        return rows.groupBy(*self.keys.key).agg(*columns, F.max("batch_id").alias("batch_id"))

    def read(self) -> DataFrame:
        """One row for each key, with the batch that last touched it."""
        return self._merged(*self._all())

    def read_before(self, batch_id: int) -> DataFrame:
        return self._merged(super().read_before(batch_id), self.manifest().horizon)

    def expire(self, horizon: int) -> None:
        """Drop keys at or below ``horizon``, now from what is read and later from what is stored."""
        if self.keys.expires is None:
            raise ValueError("the table has no column that expires")
        now = self.manifest()
        if now.horizon is None or horizon > now.horizon:
            self._commit(now, replace(now, horizon=horizon))
