"""What must not grow faster than the input: candidate pairs, and what is kept on disk beside the tables in use."""

from __future__ import annotations

import time
from pathlib import Path

import numpy as np
from pyspark.sql import functions as F

from tidemark import session
from tidemark.llm import jaccard, scoring
from tidemark.streaming.files import SharedFolder


def differing_bits(a, b):
    return sum(int(x).bit_count() for x in (a ^ b).view(np.uint64))


def test_bitmaps_tell_large_sets_apart():
    """Sets of four times as many members as a bitmap has bits, with half of the members in common."""
    rng = np.random.default_rng(5)
    a = rng.integers(0, 2**63, 2000).astype(np.uint64)
    b = np.concatenate([a[:1000], rng.integers(0, 2**63, 1000).astype(np.uint64)])
    assert differing_bits(jaccard.bitmap(a), jaccard.bitmap(b)) > 10 * 4000 / 190


def test_pairs_below_the_limit_leave_before_their_overlap_is_counted(spark):
    """Of a group of variants none links; two that do are found."""
    rng = np.random.default_rng(6)
    base = rng.integers(0, 2**62, 400)
    sets = {}
    for k in range(40):
        sets[k] = base.copy()
        sets[k][rng.choice(400, 35, replace=False)] = rng.integers(0, 2**62, 35)
    sets[40] = sets[39].copy()
    sets[40][:10] = rng.integers(0, 2**62, 10)
    rows = [(k, 400, s.tolist(), jaccard.bitmap(s.view(np.uint64), jaccard.WIDE).tolist()) for k, s in sets.items()]
    given = spark.createDataFrame(rows, "doc_id bigint, n bigint, members array<bigint>, wide array<bigint>")
    wide = given.select("doc_id", "n", jaccard.bits_of("wide", jaccard.WIDE))
    pairs = wide.toDF("a", "na", "bitsa").join(wide.toDF("b", "nb", "bitsb"), F.col("a") < F.col("b"))
    assert pairs.where(jaccard.near("a", "b", 90, jaccard.WIDE)).count() <= 3
    cut = given.select("doc_id", F.lit(0).alias("fragment"), F.col("members").alias("segment"))
    found = jaccard.links(pairs.drop("bitsa", "bitsb"), cut, wide, 90).collect()
    assert [(r["a"], r["b"]) for r in found] == [(39, 40)]


def test_written_tables_keep_no_shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()

    def files():
        return {p.name for d in folders for p in Path(d.getPath()).rglob("shuffle_*.data")}

    setting, kept = spark.conf.get(session.FREE_SHUFFLES, None), files()
    tens = spark.range(1000).repartition(7).groupBy((F.col("id") % 10).alias("k")).count()
    written = session.materialize(tens, "small")
    deadline = time.monotonic() + 20
    while files() - kept and time.monotonic() < deadline:
        time.sleep(0.2)
    assert not files() - kept
    assert written.count() == 10 and spark.conf.get(session.FREE_SHUFFLES, None) == setting


def test_scoring_keeps_neither_texts_nor_answers(spark, monkeypatch):
    """Each size's answers are written before the next asks, and all is gone once documents are traversed."""
    paths = []
    monkeypatch.setattr(scoring, "written", lambda df, path: (paths.append(path), session.written(df, path))[1])
    docs = spark.createDataFrame([(k, f"one two three w{k % 4} w{k % 3}") for k in range(20)], "doc_id bigint, text string")
    scored = scoring.score(docs)
    assert [path.rsplit("/", 1)[1] for path in paths] == ["chunks", "answers-1", "answers-2", "answers-3"]
    assert not any(SharedFolder(spark, path).names("") for path in paths)
    assert scored.count() == 20
