"""The corpus pipeline: operators of ``gridloom.llm`` applied one after the other.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as
Parquet and read again as the next one's ``docs``. All stages but the last return rows with
the columns of ``documents`` as they were. Empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridloom.functions.storage import scratch_path
from gridloom.llm import copies, mixing, near, pieces, quality
from gridloom.llm.common import table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return copies.exact_dedup(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near.near_dedup(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it."""
    return mixing.mix_rows(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of the token ids of every document, and digest of the decoded text."""
    return pieces.encode_decode(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", without_copies),
    ("near dedup", without_near_copies),
    ("mixing", mixed),
    ("sentencepiece", encoded),
]
# Near copies and a trained classifier cannot be said in SQL; tests hold run() to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written to shared storage and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
