"""The models by name, their parameters, and how each is fitted on Spark.

A training table has ``_key``, ``features`` (vector) and ``label`` (class number or value).
A fitted model's ``score`` drops ``features`` and adds ``prediction`` and, for classifiers,
``probability`` (array<double> in class order).
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, functions as F

from . import neighbors
from .kernel_machine import KernelVotes, fit_kernel_votes
from .svm import SupportVectors, fit_svm
from .trees import Rule, fit_boosting, fit_forest, fit_tree


@dataclass
class MLModel:
    """A fitted pyspark.ml model."""

    model: object

    def score(self, df: DataFrame) -> DataFrame:
        scored = self.model.transform(df)
        kept = [c for c in df.columns if c != "features"]
        extra = []
        if "probability" in scored.columns:
            extra = [vector_to_array("probability").alias("probability")]
        return scored.select(*kept, "prediction", *extra)

    @property
    def weights(self) -> np.ndarray | None:
        """Tree importances, or the one coefficient vector of a linear model."""
        last = self.model.stages[-1] if hasattr(self.model, "stages") else self.model
        if hasattr(last, "featureImportances"):
            return np.asarray(last.featureImportances.toArray())
        if getattr(last, "numClasses", 2) == 2 and hasattr(last, "coefficients"):
            return np.abs(last.coefficients.toArray())
        return None


@dataclass
class VectorMachine:
    machine: SupportVectors | KernelVotes

    def score(self, df: DataFrame) -> DataFrame:
        return self.machine.score(df)

    @property
    def weights(self) -> np.ndarray | None:
        found = self.machine.coefficients
        return None if found is None else np.abs(found)


@dataclass
class Neighbours:
    """The training rows are the model."""

    train: DataFrame
    k: int
    how: str
    classes: list | None
    weights: None = None

    def score(self, df: DataFrame) -> DataFrame:
        # Searched once per point: rows at the same point have the same answer.
        points = df.select(_point()).distinct()
        found = neighbors.nearest(self.train, points.select(F.col("x").alias("key"), "x"), self.k)
        if self.classes is None:
            answer = neighbors.average(found, self.how)
        else:
            answer = neighbors.vote(found, [float(i) for i in range(len(self.classes))], self.how)
        kept = [c for c in df.columns if c != "features"]
        return df.select(*kept, _point()).join(answer, F.col("x") == F.col("test_key")).drop("x", "test_key")


def _point():
    return vector_to_array("features").alias("x")


@dataclass(frozen=True)
class Spec:
    """A model on offer: defaults, the parameters for which 0 means unlimited, the fit."""

    defaults: dict
    fit: Callable
    unlimited: tuple[str, ...] = ()
    choices: dict = field(default_factory=dict)

    def values(self, given: dict | None) -> dict:
        given = given or {}
        unknown = set(given) - set(self.defaults)
        if unknown:
            raise ValueError(f"Unknown parameter(s): {', '.join(sorted(unknown))}")
        values = {k: given.get(k, v) for k, v in self.defaults.items()}
        for k in self.unlimited:
            values[k] = None if values[k] == 0 else values[k]
        for k, allowed in self.choices.items():
            if values[k] not in allowed:
                raise ValueError(f"`{k}` must be one of {allowed}.")
        return values


def _logistic(train, classes, v, seed):
    learner = LogisticRegression(
        maxIter=v["max_iter"], regParam=1.0 / (v["C"] * train.count()), elasticNetParam=0.0,
        standardization=False, family="binomial" if len(classes) == 2 else "multinomial", tol=1e-8,
    )
    return MLModel(learner.fit(train))


def _knn(train, classes, v, seed):
    points = train.select(F.col("_key").alias("key"), _point(), F.col("label").alias("y"))
    return Neighbours(points, v["n_neighbors"], v["weights"], classes)


def _tree_classifier(train, classes, v, seed):
    criterion = "entropy" if v["criterion"] == "entropy" else "variance"
    return fit_tree(train, classes, Rule(v["max_depth"], v["min_samples_split"], criterion, seed=seed))


def _forest_classifier(train, classes, v, seed):
    first = train.select("features").first()
    some = max(1, math.isqrt(len(first.features))) if first else 1
    return fit_forest(train, classes, v["n_estimators"], Rule(v["max_depth"], subset=some, seed=seed))


def _bayes(train, classes, v, seed):
    return MLModel(NaiveBayes(modelType="gaussian").fit(train))


def _svm(train, classes, v, seed):
    fit = fit_kernel_votes if v["solver"] == "exact" else fit_svm
    return VectorMachine(fit(train, classes, v["kernel"], v["C"], seed=seed))


def _boosting(train, classes, v, seed):
    return fit_boosting(train, classes, v["n_estimators"], v["learning_rate"], Rule(v["max_depth"], seed=seed))


def _linear(train, classes, v, seed):
    learner = LinearRegression(fitIntercept=v["fit_intercept"], regParam=0.0, solver="auto")
    return MLModel(learner.fit(train))


def _ridge(train, classes, v, seed):
    n, spread = train.agg(F.count("label"), F.stddev_samp("label")).first()
    # MLlib scales the penalty by the spread of the label and by the number of rows.
    learner = LinearRegression(
        solver="l-bfgs", elasticNetParam=0.0, standardization=False, maxIter=1000, tol=1e-12,
        regParam=v["alpha"] * (spread or 0.0) / n,
    )
    return MLModel(learner.fit(train))


def _lasso(train, classes, v, seed):
    learner = LinearRegression(
        solver="l-bfgs", elasticNetParam=1.0, standardization=False, maxIter=v["max_iter"],
        tol=1e-12, regParam=v["alpha"],
    )
    return MLModel(learner.fit(train))


def _tree_regressor(train, classes, v, seed):
    return fit_tree(train, classes, Rule(v["max_depth"], v["min_samples_split"], seed=seed))


def _forest_regressor(train, classes, v, seed):
    return fit_forest(train, classes, v["n_estimators"], Rule(v["max_depth"], seed=seed))


_WEIGHTS = {"weights": ["uniform", "distance"]}

# Names, parameters and defaults of the models on offer.
CLASSIFIERS: dict[str, Spec] = {
    "Logistic Regression": Spec({"max_iter": 1000, "C": 1.0}, _logistic),
    "K-Nearest Neighbors": Spec({"n_neighbors": 5, "weights": "uniform"}, _knn, choices=_WEIGHTS),
    "Decision Tree": Spec(
        {"criterion": "gini", "max_depth": 0, "min_samples_split": 2}, _tree_classifier,
        ("max_depth",), {"criterion": ["gini", "entropy"]},
    ),
    "Random Forest": Spec({"n_estimators": 100, "max_depth": 0}, _forest_classifier, ("max_depth",)),
    "Naive Bayes": Spec({}, _bayes),
    "Support Vector Machine": Spec(
        {"kernel": "rbf", "C": 1.0, "solver": "mapped"}, _svm, (),
        {"kernel": ["rbf", "linear", "poly", "sigmoid"], "solver": ["mapped", "exact"]},
    ),
    "Gradient Boosting": Spec(
        {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 3}, _boosting,
        ("max_depth",),
    ),
}

REGRESSORS: dict[str, Spec] = {
    "Linear Regression": Spec({"fit_intercept": True}, _linear),
    "Ridge Regression": Spec({"alpha": 1.0}, _ridge),
    "Lasso Regression": Spec({"alpha": 1.0, "max_iter": 1000}, _lasso),
    "Decision Tree Regressor": Spec(
        {"max_depth": 0, "min_samples_split": 2}, _tree_regressor, ("max_depth",)
    ),
    "Random Forest Regressor": Spec(
        {"n_estimators": 100, "max_depth": 0}, _forest_regressor, ("max_depth",)
    ),
    "Gradient Boosting Regressor": Spec(
        {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 3}, _boosting,
        ("max_depth",),
    ),
    "KNN Regressor": Spec({"n_neighbors": 5, "weights": "uniform"}, _knn, choices=_WEIGHTS),
}


def default_params(name: str) -> dict:
    return dict({**CLASSIFIERS, **REGRESSORS}[name].defaults)


def fit_model(model, train: DataFrame, classes: list | None, params: dict | None, seed: int):
    """``model``: a name from the tables above, or a function that makes a pyspark.ml Estimator."""
    if callable(model):
        estimator = model()
        if estimator.hasParam("seed"):
            estimator = estimator.copy({estimator.getParam("seed"): seed})
        return MLModel(estimator.fit(train))
    table = REGRESSORS if classes is None else CLASSIFIERS
    if model not in table:
        raise ValueError(f"Unknown model `{model}`. Choose one of: {', '.join(table)}.")
    spec = table[model]
    return spec.fit(train, classes, spec.values(params), seed)
