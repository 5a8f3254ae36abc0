"""A corpus in five stages, each written as Parquet and read again before the next one starts.

Quality rules, one document of each group of near copies, benchmark decontamination, masking of
personal data, packing. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark.llm import decontamination, jaccard, packing, pii, quality  # noqa: E402
from tidemark.llm.base import table  # noqa: E402
from tidemark.session import work_dir  # noqa: E402


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without their boilerplate lines."""
    return quality.keep(docs)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id."""
    return jaccard.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with marks in place of personal data."""
    return pii.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in training sequences."""
    return packing.pack(docs, packing.tokenizer_path())


STAGES = [
    ("quality rules", quality_stage),
    ("n-gram Jaccard join", near_copies_stage),
    ("benchmark decontamination", decontamination_stage),
    ("personal data", personal_data_stage),
    ("packing", packing_stage),
]

#: Similarity, trained models and tokens are not expressed in SQL; a brute-force version tests run().
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of the documents that are left, as ``packing`` returns them.

    Documents without a text fail the quality rules. Rows without a doc_id are copies of nothing and
    stay if the rules keep them; rows of one doc_id stay or go as copies together. Columns beside
    those of ``documents`` are kept up to the last stage. Empty tables give an empty result.
    """
    docs = table(spark, sf_dir, "documents").withColumn("doc_id", F.col("doc_id").cast("bigint"))
    for _, stage in STAGES:
        path = work_dir(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
