"""Binary learners used for several classes: one fit per class, scores put side by side."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, functions as F

PARALLEL_FITS = 4


def binary_label(train: DataFrame, index: int) -> DataFrame:
    return train.withColumn("label", (F.col("label") == F.lit(float(index))).cast("double"))


def in_parallel(fit, items: list):
    """Independent fits submitted together, so that small stages share the cluster."""
    with ThreadPoolExecutor(max_workers=PARALLEL_FITS) as pool:
        return list(pool.map(fit, items))


def normalised(scores: str) -> Column:
    """Class scores as probabilities that sum to one; all-zero scores become even."""
    total = F.aggregate(scores, F.lit(0.0), lambda a, v: a + v)
    return F.transform(
        scores, lambda v: F.when(total > 0, v / total).otherwise(F.lit(1.0) / F.size(scores))
    )
