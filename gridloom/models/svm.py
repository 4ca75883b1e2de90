"""Support vector classification with linear, rbf, poly and sigmoid kernels.

Kernel solvers need all pairs of rows. Here the kernel is replaced by an explicit feature
map - random Fourier features for rbf, sampled landmarks (Nystroem) for poly and sigmoid -
and a linear margin classifier is trained on it. Probabilities are a logistic curve fitted
to margins that the classifier gave to rows it had not seen.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from ..functions.sampling import key_hash
from .one_vs_rest import binary_label, in_parallel, normalised

KERNELS = ["rbf", "linear", "poly", "sigmoid"]
FOURIER_FEATURES = 256
LANDMARKS = 128
CALIBRATION_FOLDS = 3
POLY_DEGREE = 3
ROWS_PER_TASK = 20_000
_MAX_ITER = 50


def _scale_gamma(train: DataFrame) -> tuple[float, int]:
    """One over (number of features x variance of all feature cells)."""
    row = train.select(
        Summarizer.metrics("mean", "normL2", "count").summary(F.col("features")).alias("s")
    ).first()["s"]
    n, width = row["count"], len(row["mean"])
    square = float(np.sum(np.asarray(row["normL2"].toArray()) ** 2)) / (n * width)
    variance = square - float(np.mean(row["mean"].toArray())) ** 2
    return (1.0 / (width * variance) if variance > 0 else 1.0), width


def _fourier_map(gamma: float, width: int, seed: int):
    rng = np.random.default_rng(seed)
    directions = rng.normal(0.0, math.sqrt(2.0 * gamma), (width, FOURIER_FEATURES))
    phases = rng.uniform(0.0, 2.0 * math.pi, FOURIER_FEATURES)
    scale = math.sqrt(2.0 / FOURIER_FEATURES)
    return lambda x: scale * np.cos(x @ directions + phases)


def _landmark_map(train: DataFrame, kernel: str, gamma: float, seed: int):
    rows = (
        train.select(vector_to_array("features").alias("x"), key_hash(["_key"], seed).alias("h"), "_key")
        .orderBy("h", "_key").limit(LANDMARKS).collect()
    )
    marks = np.array([r["x"] for r in rows])

    def product(a, b):
        inner = gamma * (a @ b.T)
        return inner**POLY_DEGREE if kernel == "poly" else np.tanh(inner)

    values, vectors = np.linalg.eigh(product(marks, marks))
    keep = values > 1e-8 * max(values.max(), 1e-12)
    root = vectors[:, keep] / np.sqrt(values[keep])
    return lambda x: product(x, marks) @ root


def _mapped(df: DataFrame, feature_map) -> DataFrame:
    if feature_map is None:
        return df

    @F.pandas_udf("array<double>")
    def explicit(x: pd.Series) -> pd.Series:
        if len(x) == 0:
            return pd.Series([], dtype=object)
        return pd.Series(list(feature_map(np.vstack(x.to_numpy()))))

    return df.withColumn("features", array_to_vector(explicit(vector_to_array("features"))))


@dataclass
class SupportVectors:
    feature_map: object
    models: list
    curves: list[tuple[float, float]]
    coefficients: np.ndarray | None

    def score(self, df: DataFrame) -> DataFrame:
        scored = _mapped(df, self.feature_map)
        raw = []
        for i, model in enumerate(self.models):
            model = model.copy()
            model.setPredictionCol(f"_p{i}").setRawPredictionCol(f"_m{i}")
            scored = model.transform(scored)
            raw.append(vector_to_array(f"_m{i}")[1])
        chance = [
            F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(a) * m + F.lit(b))))
            for m, (a, b) in zip(raw, self.curves)
        ]
        if len(raw) == 1:
            margins = F.array(-raw[0], raw[0])
            chances = F.array(F.lit(1.0) - chance[0], chance[0])
        else:
            margins, chances = F.array(*raw), F.array(*chance)
        scored = scored.withColumn("_margins", margins).withColumn("_chances", chances)
        best = F.array_position("_margins", F.array_max("_margins")) - 1
        return scored.select(
            *[c for c in df.columns if c != "features"],
            best.cast("double").alias("prediction"), normalised("_chances").alias("probability"),
        )


def fit_svm(train: DataFrame, classes: list, kernel: str = "rbf", c: float = 1.0, seed: int = 42) -> SupportVectors:
    """``train`` has ``_key``, ``features`` and ``label`` (class number)."""
    if kernel not in KERNELS:
        raise ValueError(f"Unknown kernel `{kernel}`.")
    feature_map = None
    if kernel != "linear":
        gamma, width = _scale_gamma(train)
        feature_map = (
            _fourier_map(gamma, width, seed) if kernel == "rbf" else _landmark_map(train, kernel, gamma, seed)
        )
    fold = F.pmod(key_hash(["_key"], seed + 1), F.lit(CALIBRATION_FOLDS))
    # Rows at the same point with the same class and fold are one row with their number as weight.
    points = train.select("features", "label", fold.alias("_fold")).groupBy("features", "label", "_fold")
    points = points.agg(F.count("*").cast("double").alias("weight")).persist()
    n, size = points.agg(F.sum("weight"), F.count("*")).first()
    # Every iteration is a job over this table: few rows need few tasks, and no task has
    # many, however few parts the input has. Rows are dealt out before the map makes them wide.
    mapped = _mapped(points.repartition(size // ROWS_PER_TASK + 1), feature_map).persist()

    def machine(rows: DataFrame):
        learner = LinearSVC(maxIter=_MAX_ITER, regParam=1.0 / (c * n), standardization=False, weightCol="weight")
        return learner.fit(rows)

    def fit_one(job: tuple[int, int | None]):
        index, left_out = job
        rows = binary_label(mapped, index)
        return machine(rows if left_out is None else rows.filter(F.col("_fold") != left_out))

    def curve(index: int) -> tuple[float, float]:
        """A logistic curve over margins of rows that the machine had not seen."""
        unseen = None
        for fold in range(CALIBRATION_FOLDS):
            held = binary_label(mapped.filter(F.col("_fold") == fold), index)
            part = machines[index, fold].transform(held).select(
                array_to_vector(F.array(vector_to_array("rawPrediction")[1])).alias("features"), "label", "weight"
            )
            unseen = part if unseen is None else unseen.unionByName(part)
        fitted = LogisticRegression(maxIter=_MAX_ITER, regParam=0.0, family="binomial", weightCol="weight").fit(unseen)
        return float(fitted.coefficients[0]), float(fitted.intercept)

    positives = [1] if len(classes) == 2 else list(range(len(classes)))
    jobs = [(i, fold) for i in positives for fold in (None, *range(CALIBRATION_FOLDS))]
    try:
        machines = dict(zip(jobs, in_parallel(fit_one, jobs)))
        curves = in_parallel(curve, positives)
    finally:
        mapped.unpersist()
        points.unpersist()
    models = [machines[i, None] for i in positives]
    single = kernel == "linear" and len(models) == 1
    return SupportVectors(
        feature_map, models, curves,
        np.asarray(models[0].coefficients.toArray()) if single else None,
    )
