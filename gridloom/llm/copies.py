"""Exact duplicates by a content sort.

Texts are range-partitioned by a sort key of bounded size - their first characters, then
their digest - whose splitters Spark samples; an external sort brings equal texts side by
side, and neighbours are compared in full. A group of very many copies is dealt into
buckets by document, so that no task gets it whole. All DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.columns import require
from .common import fitting, quoted

HEAD = 32
# Copies of one text in one bucket, about.
HOT_ROWS = 256


def _grouped(docs: DataFrame, id_col: str, text_col: str, payload: bool, hot_rows: int) -> DataFrame:
    require(docs, id_col, text_col)
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    held = [F.struct(*map(quoted, docs.columns)).alias("row")] if payload else []
    rows = docs.select(quoted(id_col).alias("doc_id"), text.alias("text"), *held)
    rows = rows.withColumn("sha", F.sha2("text", 256))
    counted = docs.select(F.sha2(text, 256).alias("sha"), quoted(id_col).alias("doc_id"))
    # Counted before any text moves; added up where the rows are.
    hot = (
        counted.groupBy("sha").agg(F.count("*").alias("all_rows"), F.max("doc_id").alias("all_top"))
        .filter(F.col("all_rows") > hot_rows)
    )
    salted = rows.join(fitting(hot), "sha", "left").withColumn(
        "bucket",
        F.coalesce(F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("all_rows") / hot_rows).cast("bigint")), F.lit(0)),
    )
    key = ["head", "sha", "bucket"]
    ranged = salted.withColumn("head", F.substring("text", 1, HEAD)).repartitionByRange(*key)
    same = Window.partitionBy(*key, "text")
    order = same.orderBy(F.col("doc_id").desc_nulls_last())
    placed = ranged.select(
        "*",
        F.row_number().over(order).alias("place"),
        F.first("doc_id").over(order).alias("top"),
        F.count("*").over(same).alias("n"),
    )
    is_hot = F.col("all_rows").isNotNull()
    keep = F.when(is_hot, F.col("all_top")).otherwise(F.col("top"))
    return placed.select(
        "doc_id", keep.alias("keep_id"),
        F.when(is_hot, F.col("all_rows")).otherwise(F.col("n")).alias("group_size"),
        ((F.col("place") == 1) & F.col("top").eqNullSafe(keep)).alias("kept"),
        F.col("sha").alias("text_sha256"),
        *(["row"] if payload else []),
    )


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``, one row per row of ``docs``.

    Of equal texts the row with the largest id stays (NULL ids come last); of rows that
    repeat the same id and text exactly one. A NULL text is an empty one. An empty table
    gives an empty one; other columns are left out. Buckets of one hot group are tied by
    their SHA-256; within a bucket, and for all other texts, whole texts are compared.
    """
    return _grouped(docs, id_col, text_col, False, hot_rows)


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they were."""
    kept = _grouped(docs, id_col, text_col, True, hot_rows).filter("kept")
    return kept.select("row.*")


ORACLE_SQL = """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC) = 1 AS kept,
           sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """
