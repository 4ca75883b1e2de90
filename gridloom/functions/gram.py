"""Sums over all pairs of many columns in one scan, for correlations of wide tables."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .storage import cut_lineage

# Columns whose pairs one scan adds up: six tables of 8 MB in a task. Wider tables take a scan
# for each pair of blocks of half as many.
SCAN_COLUMNS = 1_000
# Rows that are looked at for a value near the middle of each column.
CENTRE_ROWS = 1_000
# Rows multiplied at a time, and columns whose sums leave a task in one batch.
_ROWS, _SLICE = 2_000, 64
# A spread below this share of the squares is not told from a constant by sums.
DOUBT = 1e-9

_SUMS = ("n", "x", "y", "xx", "yy", "xy")


def _centres(numbers: DataFrame) -> list[float]:
    """Any value does; one near the mean keeps the sums exact."""
    near = numbers.limit(CENTRE_ROWS).agg(*[F.avg(c).alias(c) for c in numbers.columns]).first()
    return [float(v) if v is not None and math.isfinite(v) else 0.0 for v in near]


def _block_sums(left: list[int], right: list[int], centres: list[float]):
    """Function over batches whose columns are ``left`` and then the others of ``right``.

    Gives the pairs ``a < b`` with the number of rows that hold both, and in those the sums of
    both, of their squares and of their products.
    """
    same = left == right
    own = np.array([centres[i] for i in (left if same else left + right)])
    split = len(left)

    def masked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        held = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns])
        values = np.column_stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in batch.columns])
        return np.where(held, values - own, 0.0), held.astype(float)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for whole in batches:
            for low in range(0, whole.num_rows, _ROWS):
                values, held = masked(whole.slice(low, _ROWS))
                x, m = values[:, :split], held[:, :split]
                y, k = (x, m) if same else (values[:, split:], held[:, split:])
                new = [m.T @ k, x.T @ k, m.T @ y, (x * x).T @ k, m.T @ (y * y), x.T @ y]
                sums = new if sums is None else [a + b for a, b in zip(sums, new)]
        if sums is None:
            return
        for low in range(0, split, _SLICE):
            rows = np.arange(low, min(low + _SLICE, split))
            a, b = np.meshgrid(np.array(left)[rows], np.array(right), indexing="ij")
            upper = a < b
            columns = [pa.array(a[upper].astype("int32")), pa.array(b[upper].astype("int32"))]
            columns += [pa.array(s[rows][upper]) for s in sums]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", *_SUMS])

    return add


def pair_sums(numbers: DataFrame, scan_columns: int = SCAN_COLUMNS) -> DataFrame:
    """``a, b`` (places of the columns) and the sums over the rows that hold both, in doubles.

    Values are taken from a centre of their column. Each task adds up its own rows; what it
    gives grows with the pairs of columns alone and is added up by Spark.
    """
    names, centres = numbers.columns, _centres(numbers)
    width = len(names)
    size = width if width <= scan_columns else max(1, scan_columns // 2)
    blocks = [list(range(low, min(low + size, width))) for low in range(0, width, size)]
    found = None
    for i, left in enumerate(blocks):
        for right in blocks[i:]:
            chosen = left if left == right else left + right
            schema = "a int, b int, " + ", ".join(f"{s} double" for s in _SUMS)
            part = numbers.select(*[names[c] for c in chosen]).mapInArrow(_block_sums(left, right, centres), schema)
            found = part if found is None else found.unionByName(part)
    return found.groupBy("a", "b").agg(*[F.sum(s).alias(s) for s in _SUMS])


def pair_correlations(numbers: DataFrame, scan_columns: int = SCAN_COLUMNS) -> tuple[DataFrame, list[tuple[int, int]]]:
    """``a, b, correlation`` (Pearson, over rows that hold both), and the pairs left to be computed
    from the rows: nearly constant ones, or with values that are not finite.

    A pair without two rows, or with a side that never leaves the centre, has NULL.
    """
    width = len(numbers.columns)
    spread = lambda s, ss: F.col(ss) - F.try_divide(F.col(s) * F.col(s), F.col("n"))
    shaky = lambda s, ss: spread(s, ss) <= F.lit(DOUBT) * F.col(ss)
    finite = F.abs(F.col("xx") + F.col("yy")) < F.lit(math.inf)
    flat = (F.col("n") < 2) | (F.col("xx") == 0) | (F.col("yy") == 0)
    both = F.col("xy") - F.try_divide(F.col("x") * F.col("y"), F.col("n"))
    sums = pair_sums(numbers, scan_columns).select(
        "a", "b",
        F.when(flat, F.lit(False)).otherwise(shaky("x", "xx") | shaky("y", "yy") | ~finite | F.isnan("xy")).alias("doubtful"),
        F.when(~flat, F.try_divide(both, F.sqrt(spread("x", "xx")) * F.sqrt(spread("y", "yy")))).alias("correlation"),
    )
    sums = cut_lineage(sums)
    doubtful = [(r["a"], r["b"]) for r in sums.filter("doubtful").select("a", "b").collect()]
    start = numbers.sparkSession.range(width - 1).select(F.col("id").cast("int").alias("a"))
    pairs = start.select("a", F.explode(F.sequence(F.col("a") + 1, F.lit(width - 1))).alias("b"))
    rows = pairs.join(sums, ["a", "b"], "left").filter(~F.coalesce(F.col("doubtful"), F.lit(False)))
    return rows.select("a", "b", "correlation"), doubtful
