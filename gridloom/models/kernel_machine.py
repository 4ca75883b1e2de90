"""The exact kernel margin classifier, trained by decomposition over a distributed table.

The dual problem has one variable per row and a kernel value per pair of rows. No pair is
kept: the table holds each point's variable and its gradient. A round takes the points that
violate the optimality conditions most - a bounded number, from both ends of the order -
solves the problem of those points alone, and adds what changed to the gradient of every
point, one scan. The rounds end when no pair of points violates the conditions by more than
``tolerance``, which the gradients of all points tell. Rows at the same point with the same
class are one variable with their number as weight, so copies cost nothing.

Several classes are told apart in pairs, each pair of classes by a machine of its own, and
the votes are counted.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.sampling import key_hash
from ..functions.storage import cut_lineage
from .one_vs_rest import in_parallel

KERNELS = ["rbf", "linear", "poly", "sigmoid"]
POLY_DEGREE = 3
TOLERANCE = 1e-3
# Points that one round takes; fewer where they are wide (cells of all points of a round).
WORKING_SET, WORKING_CELLS = 1_000, 4_000_000
MAX_ROUNDS = 500
# Support vectors that a machine may have: they live on the driver and travel to the tasks.
MAX_SUPPORT = 50_000
CALIBRATION_FOLDS = 3
# Below this a pair of points counts as equal for the kernel (it may be indefinite).
_FLAT = 1e-12


def kernel_values(a: np.ndarray, b: np.ndarray, kernel: str, gamma: float) -> np.ndarray:
    """The kernel of every row of ``a`` with every row of ``b``."""
    inner = a @ b.T
    if kernel == "linear":
        return inner
    if kernel == "poly":
        return (gamma * inner) ** POLY_DEGREE
    if kernel == "sigmoid":
        return np.tanh(gamma * inner)
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2.0 * inner
    return np.exp(-gamma * np.maximum(square, 0.0))


def scale_gamma(train: DataFrame) -> float:
    """One over (number of features x variance of all feature cells)."""
    found = train.select(Summarizer.metrics("mean", "normL2", "count").summary(F.col("features")).alias("s")).first()["s"]
    mean, n = np.asarray(found["mean"].toArray()), found["count"]
    square = float(np.sum(np.asarray(found["normL2"].toArray()) ** 2)) / max(1, n * len(mean))
    variance = square - float(mean.mean()) ** 2
    return 1.0 / (len(mean) * variance) if variance > 0 else 1.0


def solve(kernel: np.ndarray, y: np.ndarray, cap: np.ndarray, alpha: np.ndarray, grad: np.ndarray, tolerance: float) -> np.ndarray:
    """New variables of a few points: pairs are moved until none violates the conditions.

    The first of a pair is the worst point, the second the one that gains most with it.
    """
    alpha, grad, diagonal = alpha.copy(), grad.copy(), np.diag(kernel)
    while True:
        value = -y * grad
        can_rise = np.where(y > 0, alpha < cap, alpha > 0)
        can_fall = np.where(y > 0, alpha > 0, alpha < cap)
        if not can_rise.any() or not can_fall.any():
            return alpha
        i = int(np.argmax(np.where(can_rise, value, -np.inf)))
        gap = value[i] - value
        if np.where(can_fall, gap, -np.inf).max() < tolerance:
            return alpha
        bend = np.maximum(diagonal[i] + diagonal - 2.0 * kernel[i], _FLAT)
        j = int(np.argmax(np.where(can_fall & (gap > 0), gap * gap / bend, -np.inf)))
        room_i = cap[i] - alpha[i] if y[i] > 0 else alpha[i]
        room_j = alpha[j] if y[j] > 0 else cap[j] - alpha[j]
        step = min(gap[j] / bend[j], room_i, room_j)
        # A variable that meets its bound is set to it, so that no rest of a sum keeps it open.
        alpha[i] = (cap[i] if y[i] > 0 else 0.0) if step == room_i else alpha[i] + y[i] * step
        alpha[j] = (0.0 if y[j] > 0 else cap[j]) if step == room_j else alpha[j] - y[j] * step
        grad += y * step * (kernel[i] - kernel[j])


@dataclass
class KernelMachine:
    """``sum(weights * kernel(vectors, x)) - offset`` is above 0 for the positive class."""

    vectors: np.ndarray
    weights: np.ndarray
    offset: float
    kernel: str
    gamma: float
    gap: float
    rounds: int

    def margin(self, features: str = "features") -> Column:
        vectors, weights, offset, kernel, gamma = self.vectors, self.weights, self.offset, self.kernel, self.gamma

        @F.pandas_udf("double")
        def value(x: pd.Series) -> pd.Series:
            if len(x) == 0 or len(weights) == 0:
                return pd.Series(np.full(len(x), -offset))
            return pd.Series(kernel_values(np.vstack(x.to_numpy()), vectors, kernel, gamma) @ weights - offset)

        return value(vector_to_array(features))


def _points(train: DataFrame, c: float) -> DataFrame:
    """One variable per point and class: ``id, x, y, cap, alpha, grad``."""
    counted = train.select(vector_to_array("features").alias("x"), (F.col("label") * 2.0 - 1.0).alias("y"))
    counted = counted.groupBy("x", "y").agg((F.count("*") * F.lit(float(c))).alias("cap"))
    return cut_lineage(counted.select(
        F.monotonically_increasing_id().alias("id"), "x", "y", "cap",
        F.lit(0.0).alias("alpha"), F.lit(-1.0).alias("grad"),
    ))


def _worst(points: DataFrame, half: int) -> tuple[list, list]:
    """The points that should rise most and those that should fall most, worst first."""
    value = (-F.col("y") * F.col("grad")).alias("value")
    positive = F.col("y") > 0
    below, above = F.col("alpha") < F.col("cap"), F.col("alpha") > 0
    rise = points.filter((positive & below) | (~positive & above)).select("*", value)
    fall = points.filter((positive & above) | (~positive & below)).select("*", value)
    return (
        rise.orderBy(F.col("value").desc(), "id").limit(half).collect(),
        fall.orderBy(F.col("value").asc(), "id").limit(half).collect(),
    )


def _moved(points: DataFrame, ids: np.ndarray, alphas: np.ndarray, x: np.ndarray, change: np.ndarray, kernel: str, gamma: float) -> DataFrame:
    """The table after a round: new variables, and their effect on every gradient."""
    order = np.argsort(ids)
    ids, alphas = ids[order], alphas[order]

    def step(batches):
        for rows in batches:
            if len(rows) and len(change):
                signed = kernel_values(np.vstack(rows["x"].to_numpy()), x, kernel, gamma) @ change
                rows["grad"] = rows["grad"] + rows["y"] * signed
                at = np.minimum(np.searchsorted(ids, rows["id"].to_numpy()), len(ids) - 1)
                rows["alpha"] = np.where(ids[at] == rows["id"].to_numpy(), alphas[at], rows["alpha"].to_numpy())
            yield rows

    return cut_lineage(points.mapInPandas(step, points.schema))


def _offset(points: DataFrame) -> float:
    """The mean over free points, or the middle of what bound points allow."""
    value = F.col("y") * F.col("grad")
    positive, low, high = F.col("y") > 0, F.col("alpha") <= 0, F.col("alpha") >= F.col("cap")
    found = points.agg(
        F.avg(F.when(~low & ~high, value)).alias("free"),
        F.min(F.when((positive & low) | (~positive & high), value)).alias("upper"),
        F.max(F.when((positive & high) | (~positive & low), value)).alias("lower"),
    ).first()
    if found["free"] is not None:
        return float(found["free"])
    ends = [v for v in (found["lower"], found["upper"]) if v is not None]
    return float(sum(ends) / len(ends)) if ends else 0.0


def fit_kernel_machine(
    train: DataFrame, kernel: str = "rbf", c: float = 1.0, gamma: float | None = None,
    tolerance: float = TOLERANCE, working_set: int = WORKING_SET, max_rounds: int = MAX_ROUNDS,
    max_support: int = MAX_SUPPORT,
) -> KernelMachine:
    """``train`` has ``features`` (vector) and ``label`` (1 or 0). ``gamma`` defaults to ``scale_gamma``.

    A round reads the whole table once and brings at most ``working_set`` points to the
    driver. Rows of one class only give the machine of that class (offset of a bound point).
    More than ``max_support`` support vectors, or no end after ``max_rounds``, is an error.
    """
    if kernel not in KERNELS:
        raise ValueError(f"Unknown kernel `{kernel}`.")
    gamma = scale_gamma(train) if gamma is None and kernel != "linear" else float(gamma or 1.0)
    points, gap = _points(train, c), 0.0
    for turn in range(max_rounds + 1):
        first = points.select(F.size("x")).first()
        half = max(1, min(working_set, WORKING_CELLS // max(1, first[0] if first else 1)) // 2)
        rise, fall = _worst(points, half)
        gap = rise[0]["value"] - fall[0]["value"] if rise and fall else 0.0
        if gap < tolerance:
            break
        if turn == max_rounds:
            raise RuntimeError(f"The margin still misses its conditions by {gap:.3g} after {max_rounds} rounds; raise `max_rounds`.")
        taken = list({row["id"]: row for row in (*rise, *fall)}.values())
        ids, x = np.array([row["id"] for row in taken]), np.array([row["x"] for row in taken])
        y, cap, alpha, grad = (np.array([row[name] for row in taken]) for name in ("y", "cap", "alpha", "grad"))
        # The points of a round are solved closer than the whole, else a round might not move.
        new = solve(kernel_values(x, x, kernel, gamma), y, cap, alpha, grad, tolerance / 10)
        changed = new != alpha
        points = _moved(points, ids, new, x[changed], (y * (new - alpha))[changed], kernel, gamma)
    support = points.filter("alpha > 0").select("x", (F.col("y") * F.col("alpha")).alias("w"))
    found = support.limit(max_support + 1).collect()
    if len(found) > max_support:
        raise ValueError(f"More than {max_support} support vectors; raise `max_support` or take the approximate machine.")
    width = len(found[0]["x"]) if found else 0
    return KernelMachine(
        np.array([row["x"] for row in found]).reshape(len(found), width), np.array([row["w"] for row in found]),
        _offset(points), kernel, gamma, gap, turn,
    )


@dataclass
class KernelVotes:
    """A machine per pair of classes; the class with most votes wins, of equals the first."""

    classes: int
    machines: dict[tuple[int, int], KernelMachine]
    curves: dict[tuple[int, int], tuple[float, float]] = field(default_factory=dict)
    coefficients: np.ndarray | None = None

    def score(self, df: DataFrame) -> DataFrame:
        pairs = list(self.machines)
        margins = df.withColumn("_margins", F.array(*[self.machines[p].margin() for p in pairs]))
        margin = {p: F.col("_margins")[i] for i, p in enumerate(pairs)}
        chance = {p: 1.0 / (1.0 + F.exp(-(F.lit(a) * margin[p] + F.lit(b)))) for p, (a, b) in self.curves.items()}

        def total(of: dict, k: int, flip) -> Column:
            mine = [of[p] if p[0] == k else flip(of[p]) for p in pairs if k in p]
            return sum(mine[1:], mine[0])

        votes = [total({p: (margin[p] > 0).cast("int") for p in pairs}, k, lambda v: 1 - v) for k in range(self.classes)]
        even = 2.0 / (self.classes * (self.classes - 1))
        shares = [total(chance, k, lambda v: 1.0 - v) * F.lit(even) for k in range(self.classes)]
        scored = margins.withColumn("_votes", F.array(*votes)).withColumn("probability", F.array(*shares))
        best = F.array_position("_votes", F.array_max("_votes")) - 1
        kept = [c for c in df.columns if c != "features"]
        return scored.select(*kept, best.cast("double").alias("prediction"), "probability")


def fit_kernel_votes(train: DataFrame, classes: list, kernel: str = "rbf", c: float = 1.0, seed: int = 42) -> KernelVotes:
    """``train`` has ``_key``, ``features`` and ``label`` (class number).

    Probabilities: a logistic curve per pair of classes, fitted to margins of rows that the
    machine had not seen; a class's share is the mean over its pairs.
    """
    gamma = scale_gamma(train) if kernel != "linear" else 1.0
    fold = F.pmod(key_hash(["_key"], seed + 1), F.lit(CALIBRATION_FOLDS))
    rows = cut_lineage(train.select("features", "label", fold.alias("_fold")))
    pairs = list(itertools.combinations(range(len(classes)), 2))

    def of(pair: tuple[int, int]) -> DataFrame:
        two = rows.filter(F.col("label").isin(float(pair[0]), float(pair[1])))
        return two.withColumn("label", (F.col("label") == float(pair[0])).cast("double"))

    def fit_one(job: tuple[tuple[int, int], int | None]) -> KernelMachine:
        pair, left_out = job
        part = of(pair) if left_out is None else of(pair).filter(F.col("_fold") != left_out)
        return fit_kernel_machine(part, kernel, c, gamma)

    def curve(pair: tuple[int, int]) -> tuple[float, float]:
        unseen = None
        for left_out in range(CALIBRATION_FOLDS):
            held = of(pair).filter(F.col("_fold") == left_out).select(
                array_to_vector(F.array(machines[pair, left_out].margin())).alias("features"), "label"
            )
            unseen = held if unseen is None else unseen.unionByName(held)
        fitted = LogisticRegression(maxIter=50, regParam=0.0, family="binomial").fit(unseen)
        return float(fitted.coefficients[0]), float(fitted.intercept)

    jobs = [(pair, left_out) for pair in pairs for left_out in (None, *range(CALIBRATION_FOLDS))]
    machines = dict(zip(jobs, in_parallel(fit_one, jobs)))
    curves = dict(zip(pairs, in_parallel(curve, pairs)))
    single = machines[pairs[0], None] if kernel == "linear" and len(pairs) == 1 else None
    return KernelVotes(
        len(classes), {pair: machines[pair, None] for pair in pairs}, curves,
        None if single is None else single.weights @ single.vectors,
    )
