"""Tables written batch by batch: replays, gaps, merging, expiry, and what a crash leaves."""

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.schemas import ACCESS_LOG
from tidemark.streaming.tables import BatchTable, Entry, KeyedTable, Keys, due_for_merging

SCHEMA = StructType([StructField("k", StringType()), StructField("w", LongType()), StructField("n", LongType())])


def rows(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


def content(df):
    return sorted(tuple(r) for r in df.collect())


def test_readable_before_the_first_batch(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "t"), ACCESS_LOG)
    assert table.read().count() == 0
    assert table.read_batches([0, 7]).count() == 0
    assert len(ACCESS_LOG.fields) == 5, "reading must not change the shared schema"


def test_a_repeated_batch_replaces_itself_and_a_gap_is_an_error(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "t"), SCHEMA)
    table.write(rows(spark, ("a", 1, 1)), 0)
    table.write(rows(spark, ("b", 1, 1)), 1)
    table.write(rows(spark, ("c", 1, 1)), 1)
    assert content(table.read()) == [("a", 1, 1, 0), ("c", 1, 1, 1)]
    assert content(table.read_batches([1, 9])) == [("c", 1, 1, 1)]
    assert content(table.read_before(1)) == [("a", 1, 1, 0)]
    with pytest.raises(ValueError, match="missing"):
        table.write(rows(spark), 3)
    with pytest.raises(ValueError, match="missing"):
        BatchTable(spark, str(tmp_path / "new"), SCHEMA).write(rows(spark), 5)


def test_folders_stay_few_however_many_batches():
    entries, most = [], 0
    for batch in range(1000):
        entries.append(Entry(f"f{batch}", batch, batch))
        while merging := due_for_merging(entries, 16):
            entries = [e for e in entries if e not in merging]
            entries.append(Entry("m", merging[0].first, merging[-1].last, merging[0].level + 1))
        entries.sort(key=lambda e: e.first)
        assert [e.first for e in entries[1:]] == [e.last + 1 for e in entries[:-1]]
        most = max(most, len(entries))
    assert most <= 3 * 16 + 1 and entries[-1].level == 0


def test_merging_keeps_rows_and_deletes_what_it_read(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "t"), SCHEMA, fanout=3)
    for batch in range(14):
        table.write(rows(spark, ("a", batch, batch)), batch)
        assert content(table.read()) == [("a", b, b, b) for b in range(batch + 1)]
    assert len(table.manifest().entries) <= 7
    stored = list((tmp_path / "t" / "data").iterdir())
    assert len(stored) < 14, "folders that were merged are gone"
    assert len(list((tmp_path / "t" / "manifest").glob("[0-9]*"))) <= 4
    with pytest.raises(ValueError, match="merged"):
        table.write(rows(spark), 2)
    table.write(rows(spark, ("z", 0, 0)), 13)
    assert content(table.read_batches([12, 13])) == [("a", 12, 12, 12), ("z", 0, 0, 13)]


def test_keys_are_combined_and_expire(spark, tmp_path):
    keys = Keys(("k", "w"), {"n": "sum"}, expires="w")
    table = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, keys, fanout=2)
    for batch in range(7):
        table.write(rows(spark, ("a", 10, 1), ("b", batch, 1)), batch)
    expected = [("a", 10, 7, 6)] + [("b", b, 1, b) for b in range(7)]
    assert content(table.read()) == expected
    assert sum(spark.read.parquet(str(tmp_path / "t" / e.folder)).count() for e in table.manifest().entries) < 14
    table.expire(3)
    table.expire(1)
    assert content(table.read()) == [r for r in expected if r[1] > 3]
    for batch in range(7, 12):
        table.write(rows(spark, ("a", 10, 1)), batch)
    assert content(table.read()) == [("a", 10, 12, 11)] + [r for r in expected[1:] if r[1] > 3]
    left = [r for e in table.manifest().entries if e.level for r in content(spark.read.parquet(str(tmp_path / "t" / e.folder)))]
    assert min(r[1] for r in left) > 3, "merged folders no longer hold what has expired"


@pytest.mark.parametrize("way, expected", [("max", 9), ("last", 2)])
def test_other_ways_to_combine(spark, tmp_path, way, expected):
    table = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, Keys(("k", "w"), {"n": way}), fanout=2)
    for batch, n in enumerate((5, 9, 2)):
        table.write(rows(spark, ("a", 1, n)), batch)
    assert content(table.read()) == [("a", 1, expected, 2)]


def test_provisional_rows_hold_until_the_next_batch(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "t"), SCHEMA)
    table.write(rows(spark, ("a", 1, 1)), 0)
    table.write_provisional(rows(spark, ("p", 1, 1)), 0)
    table.write_provisional(rows(spark, ("q", 1, 1)), 0)
    assert content(table.read().drop("batch_id")) == [("a", 1, 1), ("q", 1, 1)]
    with pytest.raises(ValueError, match="ends with batch"):
        table.write_provisional(rows(spark), 4)
    table.write(rows(spark, ("b", 1, 1)), 1)
    assert content(table.read().drop("batch_id")) == [("a", 1, 1), ("b", 1, 1)]


def test_only_the_newest_batches_are_kept_on_request(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "t"), SCHEMA, keep=2)
    for batch in range(5):
        table.write(rows(spark, ("a", batch, 1)), batch)
    assert content(table.read()) == [("a", 3, 1, 3), ("a", 4, 1, 4)]


def test_data_without_a_manifest_is_not_read_and_can_be_swept(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "t"), SCHEMA)
    table.write(rows(spark, ("a", 1, 1)), 0)
    table._store(rows(spark, ("lost", 1, 1)).selectExpr("*", "1L AS batch_id"), "000000001")
    assert content(table.read()) == [("a", 1, 1, 0)]
    assert len(table.vacuum()) == 1 and table.vacuum() == []
    assert content(table.read()) == [("a", 1, 1, 0)]


def test_a_second_writer_is_refused(spark, tmp_path):
    one, two = (BatchTable(spark, str(tmp_path / "t"), SCHEMA) for _ in range(2))
    seen = one.manifest()
    two.write(rows(spark, ("a", 1, 1)), 0)
    with pytest.raises(Exception, match="exists|Exists"):
        one._commit(seen, seen)
    assert content(one.read()) == [("a", 1, 1, 0)]
