"""Exact k nearest neighbours between two tables, without comparing all pairs.

Training rows are grouped around sampled pivots. The triangle inequality tells, for every
query row, which groups can hold one of its k neighbours; the row is sent to those only.
Groups and query batches are split to a bounded size, every task keeps the k best of its
group, and the k best of those are the answer. (The pivot bounds follow Lu, Shen, Chen and
Ooi, "Efficient Processing of k Nearest Neighbor Joins using MapReduce", VLDB 2012.)
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..functions.sampling import key_hash
from ..functions.storage import cut_lineage

# Rows per group of training rows, and per batch of query rows, in one task.
CELL_ROWS = 10_000
MAX_PIVOTS = 1_024
# Rows that one task compares with all pivots, and pairs that one task compares.
TASK_ROWS, TASK_PAIRS = 10_000, 50_000_000
MAX_TASKS = 10_000
_BLOCK_CELLS = 4_000_000


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances by plain differences (exact for whole numbers)."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        d = a[:, j, None] - b[None, :, j]
        out += d * d
    return out


def _matrix(column: pd.Series) -> np.ndarray:
    return np.vstack(column.to_numpy()) if len(column) else np.zeros((0, 0))


def _drop_spare_copies(train: DataFrame, k: int) -> DataFrame:
    """Of rows at the very same point only the k with the smallest keys can be neighbours."""
    order = Window.partitionBy("x").orderBy("key", "y")
    return train.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= k).drop("_r")


def _pivots(train: DataFrame, count: int) -> np.ndarray:
    rows = train.select("x", key_hash(["key"], 0).alias("h"), "key").orderBy("h", "key").limit(count)
    return np.array([r[0] for r in rows.select("x").collect()], dtype=float)


def _in_cells(train: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Adds the nearest pivot and the distance to it."""

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch) == 0:
                continue
            points = _matrix(batch["x"])
            cells, far = [], []
            for block in np.array_split(points, max(1, len(points) * len(pivots) // _BLOCK_CELLS)):
                d = _distances(block, pivots)
                cells.append(d.argmin(axis=1))
                far.append(np.sqrt(d.min(axis=1)))
            yield batch.assign(
                cell=np.concatenate(cells).astype(np.int32), reach=np.concatenate(far)
            )

    schema = T.StructType(
        [*train.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("reach", T.DoubleType())]
    )
    return train.mapInPandas(assign, schema)


def _visits(test: DataFrame, pivots: np.ndarray, radius: np.ndarray, near: np.ndarray, k: int) -> DataFrame:
    """One row per query row and group that may hold one of its neighbours."""

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        between = np.sqrt(_distances(pivots, pivots))
        for batch in batches:
            if len(batch) == 0:
                continue
            step = max(1, _BLOCK_CELLS // near.size)
            for start in range(0, len(batch), step):
                part = batch.iloc[start : start + step]
                d = np.sqrt(_distances(_matrix(part["x"]), pivots))
                upper = (d[:, :, None] + near[None, :, :]).reshape(len(part), -1)
                limit = np.partition(upper, k - 1, axis=1)[:, k - 1] if upper.shape[1] >= k else np.full(len(part), np.inf)
                limit = limit * (1 + 1e-9) + 1e-12
                home = d.argmin(axis=1)
                gap = between[home]
                with np.errstate(divide="ignore", invalid="ignore"):
                    plane = (d * d - (d.min(axis=1) ** 2)[:, None]) / (2 * gap)
                plane = np.where(gap > 0, plane * (1 - 1e-9), 0.0)
                lower = np.maximum(d - radius[None, :], plane)
                row, cell = np.nonzero((lower <= limit[:, None]) & (radius >= 0)[None, :])
                yield part.iloc[row].assign(cell=cell.astype(np.int32))

    schema = T.StructType([*test.schema.fields, T.StructField("cell", T.IntegerType())])
    return test.mapInPandas(spread, schema)


def _per_cell(counts: dict[int, int], size: int) -> F.Column:
    """How many pieces the rows of a cell are split into (one, unless listed)."""
    pieces = {c: math.ceil(n / size) for c, n in counts.items() if n > size}
    if not pieces:
        return F.lit(1)
    table = F.create_map(*[F.lit(v) for pair in pieces.items() for v in pair])
    return F.coalesce(F.element_at(table, F.col("cell")), F.lit(1))


def _local_best(k: int):
    def best(train: pd.DataFrame, test: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"test_key": [], "train_key": [], "distance2": [], "y": []})
        if len(train) == 0 or len(test) == 0:
            return empty
        # Sorted by key and value, and ranked by place: of equal distances the smaller key wins.
        train = train.sort_values(["key", "y"], kind="stable")
        points, keys, y = _matrix(train["x"]), train["key"].to_numpy(), train["y"].to_numpy()
        queries, names = _matrix(test["x"]), test["key"].to_numpy()
        out_row, out_at, out_d = [], [], []
        step = max(1, _BLOCK_CELLS // len(points))
        for start in range(0, len(queries), step):
            d = _distances(queries[start : start + step], points)
            if len(points) > k:
                kth = np.partition(d, k - 1, axis=1)[:, k - 1]
            else:
                kth = np.full(len(d), np.inf)
            row, close = np.nonzero(d <= kth[:, None])
            order = np.lexsort((close, d[row, close], row))
            row, close = row[order], close[order]
            best = np.arange(len(row)) - np.searchsorted(row, row) < k
            row, close = row[best], close[best]
            out_row.append(start + row)
            out_at.append(close)
            out_d.append(d[row, close])
        row, at = np.concatenate(out_row), np.concatenate(out_at)
        return pd.DataFrame(
            {"test_key": names[row], "train_key": keys[at], "distance2": np.concatenate(out_d), "y": y[at]}
        )

    return best


def nearest(
    train: DataFrame, test: DataFrame, k: int = 5, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """``test_key, rank, train_key, distance, y``: the k nearest training rows of each row.

    ``train`` has ``key, x, y`` and ``test`` has ``key, x``: a key, the point as
    array<double>, the value to learn. Equal distances go to the smaller training key, equal
    keys to the smaller value. Training rows may share a key; test rows that share key and
    point are answered once.
    """
    train = cut_lineage(_drop_spare_copies(train.select("key", "x", "y"), k))
    asked = cut_lineage(
        test.select("key", "x").distinct().withColumn("_number", F.monotonically_increasing_id())
    )
    # Rows are small and their work is not, so tasks are made by rows and not by bytes.
    test = asked.select(F.col("_number").alias("key"), "x").repartition(asked.count() // TASK_ROWS + 1)
    n = train.count()
    if n == 0:
        raise ValueError("There are no training rows to search.")
    pivots = _pivots(train, max(1, min(MAX_PIVOTS, n // cell_rows)))
    placed = cut_lineage(_in_cells(train.repartition(n // TASK_ROWS + 1), pivots))
    order = Window.partitionBy("cell").orderBy("reach", "key")
    closest = (
        placed.select("cell", "reach", "key")
        .withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= k)
        .select("cell", "_r", "reach").collect()  # at most MAX_PIVOTS x k rows
    )
    near = np.full((len(pivots), k), np.inf)
    for cell, r, reach in closest:
        near[cell, r - 1] = reach
    radius = np.full(len(pivots), -1.0)
    sizes = {}
    for cell, size, reach in (
        placed.groupBy("cell").agg(F.count("*"), F.max("reach")).collect()
    ):
        sizes[cell], radius[cell] = size, reach
    visits = cut_lineage(_visits(test, pivots, radius, near, k))
    if len(pivots) == 1:
        queries = {0: test.count()}
    else:
        queries = {r[0]: r[1] for r in visits.groupBy("cell").count().collect()}

    chunks, batches = _per_cell(sizes, cell_rows), _per_cell(queries, cell_rows)
    spread = F.conv(F.substring(F.md5(F.col("key").cast("string")), 9, 8), 16, 10).cast("bigint")
    left = placed.select("*", F.pmod(spread, chunks).cast("int").alias("chunk")).select(
        "key", "x", "y", "cell", "chunk",
        F.explode(F.sequence(F.lit(0), (batches - 1).cast("int"))).alias("batch"),
    )
    right = visits.select("*", F.pmod(spread, batches).cast("int").alias("batch")).select(
        "key", "x", "cell", "batch",
        F.explode(F.sequence(F.lit(0), (chunks - 1).cast("int"))).alias("chunk"),
    )
    group = ["cell", "chunk", "batch"]
    groups = sum(math.ceil(sizes[c] / cell_rows) * math.ceil(q / cell_rows) for c, q in queries.items() if c in sizes)
    pairs = sum(sizes[c] * q for c, q in queries.items() if c in sizes)
    tasks = max(1, min(groups, pairs // TASK_PAIRS + 1, MAX_TASKS))
    left, right = left.repartition(tasks, *group), right.repartition(tasks, *group)
    schema = T.StructType(
        [
            T.StructField("test_key", test.schema["key"].dataType),
            T.StructField("train_key", train.schema["key"].dataType),
            T.StructField("distance2", T.DoubleType()),
            T.StructField("y", train.schema["y"].dataType),
        ]
    )
    found = left.groupBy(*group).cogroup(right.groupBy(*group)).applyInPandas(_local_best(k), schema)
    order = Window.partitionBy("test_key").orderBy("distance2", "train_key", "y")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    ranked = ranked.join(asked.select("_number", "key"), F.col("test_key") == F.col("_number"))
    return ranked.select(
        F.col("key").alias("test_key"), "rank", "train_key", F.sqrt("distance2").alias("distance"), "y"
    )


def weighted(neighbours: DataFrame, weights: str = "uniform") -> DataFrame:
    """Adds ``w``: one each, or one over the distance; exact matches win outright."""
    if weights == "uniform":
        return neighbours.withColumn("w", F.lit(1.0))
    if weights != "distance":
        raise ValueError(f"Unknown weights `{weights}`.")
    exact = F.min("distance").over(Window.partitionBy("test_key")) == 0
    w = F.when(exact, (F.col("distance") == 0).cast("double")).otherwise(
        F.try_divide(F.lit(1.0), F.col("distance"))
    )
    return neighbours.withColumn("w", w)


def vote(neighbours: DataFrame, classes: list, weights: str = "uniform") -> DataFrame:
    """``test_key, prediction, probability``; equal votes go to the first class."""
    votes = weighted(neighbours, weights).groupBy("test_key").agg(
        F.array(
            *[F.coalesce(F.sum(F.when(F.col("y") == F.lit(c), F.col("w"))), F.lit(0.0)) for c in classes]
        ).alias("votes"),
        F.sum("w").alias("all_votes"),
    )
    names = F.array(*[F.lit(c) for c in classes])
    best = F.array_position("votes", F.array_max("votes")).cast("int") - 1
    return votes.select(
        "test_key", F.get(names, best).alias("prediction"),
        F.transform("votes", lambda v: v / F.col("all_votes")).alias("probability"),
    )


def average(neighbours: DataFrame, weights: str = "uniform") -> DataFrame:
    """``test_key, prediction``: the weighted mean of the neighbours' values."""
    return weighted(neighbours, weights).groupBy("test_key").agg(
        (F.sum(F.col("w") * F.col("y")) / F.sum("w")).alias("prediction")
    )
