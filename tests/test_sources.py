import pytest
from helpers import ms
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.sources import access_log, behavior
from tidemark.sources.access_log import read_access_log
from tidemark.sources.behavior import read_behavior
from tidemark.sources.marketing import read_marketing


def write(tmp_path, *lines, end="\n"):
    path = tmp_path / "input.txt"
    path.write_bytes(end.join(lines).encode() + end.encode())
    return str(path)


def test_behaviour_file(spark, tmp_path):
    path = write(tmp_path, "543462,1715,1464116,pv,1511658000", "+1,-2,3,,1511658001,EXTRA,,")
    rows = read_behavior(spark, path).select("*", F.unix_millis("ts").alias("at")).drop("ts").collect()
    assert sorted(map(tuple, rows)) == [
        (1, -2, 3, "", 1511658001000),
        (543462, 1715, 1464116, "pv", 1511658000000),
    ]


def test_carriage_returns_end_a_line_only_before_a_newline(spark, tmp_path):
    path = write(tmp_path, "1,2,3,pv,1511658000", "1,2,3,p\rv,1511658000", end="\r\n")
    assert sorted(r.behavior for r in read_behavior(spark, path).collect()) == ["p\rv", "pv"]


BAD = {
    "1,2,3,pv": "too few fields",
    "1,2,3,pv,": "too few fields",
    ",,,,": "too few fields",
    "": "too few fields",
    "x,2,3,pv,1": "user_id",
    " 1,2,3,pv,1": "user_id",
    "1,2.0,3,pv,1": "item_id",
    "1,9223372036854775808,3,pv,1": "item_id",
    "1,2,2147483648,pv,1": "category_id",
    "1,2,3,pv,1 ": "timestamp",
    "1,2,3,pv,9223372036854775807": "timestamp",
}


def test_bad_behaviour_lines_are_set_aside_with_a_reason(spark, tmp_path):
    path = write(tmp_path, *BAD, "1,2,3,pv,1")
    parsed = read_behavior(spark, path, "quarantine")
    assert {r.line: r.reason for r in parsed.rejects.collect()} == BAD
    assert parsed.records.count() == 1


@pytest.mark.parametrize("line", ["1,2,3,pv", "x,2,3,pv,1"])
def test_failfast_fails_even_when_only_counting(spark, tmp_path, line):
    path = write(tmp_path, "1,2,3,pv,1", line)
    with pytest.raises(PySparkException, match="malformed line"):
        read_behavior(spark, path).count()
    with pytest.raises(PySparkException, match="malformed line"):
        read_behavior(spark, path).where(F.col("behavior") == "buy").select("item_id").collect()


def test_access_log_file(spark, tmp_path):
    path = write(tmp_path, "83.149.9.216 - - 17/05/2015:10:05:03 +0000 GET /reset.css", "1.1.1.1 u - 17/05/2015:10:05:03 x POST /a more")
    rows = read_access_log(spark, path).select("*", F.unix_millis("ts").alias("at")).drop("ts").collect()
    at = ms("2015-05-17T10:05:03")
    assert sorted(map(tuple, rows)) == [
        ("1.1.1.1", "u", "POST", "/a", at),
        ("83.149.9.216", "-", "GET", "/reset.css", at),
    ]


def test_log_time_zone(spark, tmp_path):
    path = write(tmp_path, "1.1.1.1 - - 17/05/2015:10:05:03 +0000 GET /a")
    (row,) = read_access_log(spark, path, zone="Asia/Shanghai").select(F.unix_millis("ts").alias("at")).collect()
    assert row.at == ms("2015-05-17T02:05:03")


BAD_LOG = {
    "1.1.1.1 - - 17/05/2015:10:05:03 +0000 GET ": "too few fields",
    " ": "too few fields",
    "": "too few fields",
    "1.1.1.1 - - 32/05/2015:10:05:03 +0000 GET /a": "time",
    "1.1.1.1 - - 17/05/2015:10:05:03junk +0000 GET /a": "time",
    "1.1.1.1 - -  17/05/2015:10:05:03 +0000 GET /a": "time",
}


def test_bad_log_lines_are_set_aside_with_a_reason(spark, tmp_path):
    parsed = read_access_log(spark, write(tmp_path, *BAD_LOG), "quarantine")
    assert {r.line: r.reason for r in parsed.rejects.collect()} == BAD_LOG
    assert parsed.records.count() == 0


def test_unknown_mode(spark, tmp_path):
    for records in (behavior.records, access_log.records):
        with pytest.raises(ValueError):
            records(spark.createDataFrame([("",)], "value string"), "lenient")


def test_marketing_time_is_in_milliseconds(spark, tmp_path):
    path = str(tmp_path / "marketing")
    raw = spark.createDataFrame([(1, "CLICK", "weibo", 1_700_000_000_123)], "user_id bigint, behavior string, channel string, timestamp bigint")
    for fmt in ("parquet", "json"):
        raw.write.format(fmt).save(f"{path}-{fmt}")
        (row,) = read_marketing(spark, f"{path}-{fmt}", fmt).select("channel", F.unix_millis("ts").alias("at")).collect()
        assert tuple(row) == ("weibo", 1_700_000_000_123)
