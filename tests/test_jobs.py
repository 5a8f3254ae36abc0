"""The jobs from text files to results."""

import os
from datetime import datetime, timezone

import pytest
from helpers import as_counter, ms, running_max, window_ends

from tidemark import __main__ as command
from tidemark.operators.lateness import LatePages
from tidemark.sources.access_log import land_access_log
from tidemark.sources.lines import ARRIVAL

START = ms("2015-05-17T10:00:00")


def log_line(url, at):
    time = datetime.fromtimestamp(at / 1000, timezone.utc).strftime("%d/%m/%Y:%H:%M:%S")
    return f"10.0.0.1 u - {time} +0000 GET {url}"


@pytest.fixture
def logs(tmp_path):
    """Two files; the one named last came first."""
    first = [("/a", START), ("/b", START + 664_000), ("/a", START + 3_000), ("/c.css", START), ("/b", START + 700_000)]
    second = [("/late", START), ("/b", START + 640_000), ("/b", START + 1_500_000)]
    folder = tmp_path / "logs"
    folder.mkdir()
    for name, rows, stamp in (("b.log", first, 1_700_000_000), ("a.log", second, 1_700_009_000)):
        (folder / name).write_text("\n".join(log_line(*r) for r in rows) + "\n")
        os.utime(folder / name, (stamp, stamp))
    return str(folder), first + second


def test_landed_lines_keep_their_order(spark, logs, tmp_path):
    folder, rows = logs
    landed = land_access_log(spark, folder, str(tmp_path / "landed"))
    assert [r.url for r in landed.orderBy(*ARRIVAL).collect()] == [url for url, _ in rows]
    seen = running_max([(i, t) for i, (_, t) in enumerate(rows)])
    expected = {}
    for (url, t), newest in zip(rows, seen):
        for end in window_ends(t, 600_000, 5_000):
            if not url.endswith(".css") and (newest is None or newest < end + 65_000):
                expected[url, end] = expected.get((url, end), 0) + 1
    pages = LatePages(landed, ARRIVAL)
    assert as_counter(pages.final_counts(), "url") == expected
    assert [(r.url, r.running_max_ms) for r in pages.late_rows().collect()] == [("/late", START + 700_000)]


def test_order_within_a_file_of_many_blocks(spark, tmp_path):
    path = tmp_path / "one.log"
    path.write_text("".join(log_line(f"/{i}", START + i * 1_000) + "\n" for i in range(3_000)))
    limit = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "20000")
    try:
        landed = land_access_log(spark, str(path), str(tmp_path / "landed"))
        assert landed.select("block").distinct().count() > 5
        assert [r.url for r in landed.orderBy(*ARRIVAL).collect()] == [f"/{i}" for i in range(3_000)]
    finally:
        spark.conf.set(limit, before)


def test_every_job_runs_from_files(spark, logs, tmp_path, capsys):
    behavior = tmp_path / "behavior.csv"
    behavior.write_text(f"1,7,1,pv,{START // 1000}\n2,7,1,pv,{START // 1000}\n1,8,1,buy,{START // 1000}\n")
    marketing = str(tmp_path / "marketing")
    spark.createDataFrame(
        [(1, "CLICK", "weibo", START)], "user_id bigint, behavior string, channel string, timestamp bigint"
    ).write.parquet(marketing)
    inputs = {"hot-pages": logs[0], "late-pages": logs[0], "channels": marketing}
    rows = {}
    for job in command.JOBS:
        out = str(tmp_path / f"out-{job}")
        command.main([job, inputs.get(job, str(behavior)), "--out", out])
        rows[job] = spark.read.parquet(out).collect()
    hour = ms("2015-05-17T11:00:00")
    assert [tuple(r) for r in rows["page-views"]] == [("pv", hour, 2)]
    assert [tuple(r) for r in rows["unique-visitors"]] == [("uv", hour, 2)]
    assert [tuple(r) for r in rows["unique-visitors-bitmap"]] == [(hour, 2)]
    assert [tuple(r) for r in rows["channels"]] == [("weibo", "CLICK", "2015-05-17 11:00:00", 1)]
    assert len(rows["hot-items"]) == 12 and all("商品ID = 7 热门度 = 2" in r.report for r in rows["hot-items"])
    assert [r.url for r in rows["late-pages"]] == ["/late"]
    assert any("NO 1: URL = /b Page View = 2" in r.report for r in rows["hot-pages"])
    command.main(["page-views", str(behavior)])
    assert "pv" in capsys.readouterr().out


def test_every_job_runs_as_a_stream(spark, logs, tmp_path, capsys):
    """What is open at the end is included, and a second run goes on with the files that came since."""
    folder = tmp_path / "behavior"
    folder.mkdir()
    (folder / "1.csv").write_text(f"1,7,1,pv,{START // 1000}\n2,7,1,pv,{START // 1000}\n1,8,1,buy,{START // 1000}\n")
    marketing = str(tmp_path / "marketing")
    spark.createDataFrame(
        [(1, "CLICK", "weibo", START)], "user_id bigint, behavior string, channel string, timestamp bigint"
    ).coalesce(1).write.parquet(marketing)
    inputs = {"hot-pages": logs[0], "late-pages": logs[0], "channels": marketing}
    assert command.STREAM_JOBS.keys() == command.JOBS.keys()

    def run(job):
        places = ["--out", str(tmp_path / f"stream-{job}"), "--checkpoint", str(tmp_path / f"checkpoint-{job}")]
        command.main([job, inputs.get(job, str(folder)), *places])
        return capsys.readouterr().out

    shown = {job: run(job) for job in command.STREAM_JOBS}
    hour = ms("2015-05-17T11:00:00")
    assert f"|pv  |{hour}|2    |" in shown["page-views"] and f"|uv  |{hour}|2    |" in shown["unique-visitors"]
    assert f"|{hour}|2       |" in shown["unique-visitors-bitmap"]
    assert "2015-05-17 11:00:00" in shown["channels"] and "商品ID = 7 热门度 = 2" in shown["hot-items"]
    assert "/late" in shown["late-pages"] and "NO 1: URL = /" in shown["hot-pages"]
    (folder / "2.csv").write_text(f"3,7,1,pv,{START // 1000}\n4,7,1,pv,{START // 1000 + 3600}\n")
    again = run("page-views")
    assert f"|pv  |{hour}|3    |" in again and f"|pv  |{hour + 3_600_000}|1    |" in again
    with pytest.raises(SystemExit):
        command.main(["page-views", str(folder), "--checkpoint", "x"])
