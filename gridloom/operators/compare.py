"""Comparing models on one split and one preparation."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.columns import col, existing
from ..models.one_vs_rest import in_parallel
from ..models.registry import CLASSIFIERS, REGRESSORS, fit_model
from ..models.training import _finish, class_list, prepare_rows
from ..sources.writers import rounded
from . import metrics
from .clean import drop_missing_target
from .prepare import fit_features
from .split import SPLIT, TEST, TRAIN, split_train_test


@dataclass
class Comparison:
    """``table``: one row per model. ``scored``: each model's test rows, persisted.

    ``close()``, or the end of a ``with`` block, gives the memory back.
    """

    table: DataFrame
    scored: dict[str, DataFrame]
    classes: list | None
    models: dict = field(default_factory=dict)

    def close(self) -> None:
        for scored in self.scored.values():
            scored.unpersist()

    def __enter__(self) -> Comparison:
        return self

    def __exit__(self, *_) -> None:
        self.close()


def _line(name: str, scored: DataFrame, classes: list | None) -> tuple:
    if classes is None:
        row = metrics.regression_metrics(scored).first()
        return name, row["mae"], row["rmse"], row["r2"]
    row = metrics.classification_metrics(scored, n_classes=len(classes)).first()
    auc = metrics.roc_auc_brief(scored, classes).first()[0] if "probability" in scored.columns else None
    return name, row["accuracy"], row["precision"], row["recall"], row["f1"], auc


def _compare(df, features, target, names, params, keys, test_size, seed, stratify, classify, preparer):
    if not names:
        raise ValueError("The list of models is empty.")
    if not existing(df, features):
        raise ValueError("No feature column was given.")
    df = drop_missing_target(df, target)
    split = split_train_test(df, target, keys, test_size, seed, stratify)
    train_rows = F.col(SPLIT) == TRAIN
    classes = class_list(split.filter(train_rows), target) if classify else None
    _, rows = prepare_rows(split, features, target, keys, classes, train_rows, [SPLIT], preparer)
    rows = rows.persist()
    try:
        train, test = rows.filter(train_rows), rows.filter(F.col(SPLIT) == TEST)

        def one(name: str):
            fitted = fit_model(name, train, classes, (params or {}).get(name), seed)
            scored = _finish(fitted.score(test), ["_key", SPLIT], classes).persist()
            try:
                return name, fitted, scored, _line(name, scored, classes)
            except BaseException:
                scored.unpersist()
                raise

        done = in_parallel(one, list(names))
    finally:
        rows.unpersist()
    schema = (
        "model string, accuracy double, precision double, recall double, f1 double, auc double"
        if classify
        else "model string, mae double, rmse double, r2 double"
    )
    table = df.sparkSession.createDataFrame([line for *_, line in done], schema)
    return Comparison(table, {n: s for n, _, s, _ in done}, classes, {n: f for n, f, _, _ in done})


def compare_classifiers(
    df: DataFrame, features: list[str], target: str, models: list[str] | None = None,
    params: dict[str, dict] | None = None, keys: list[str] | None = None, test_size: float = 0.2,
    random_state: int = 42, stratify: bool = True, preparer=fit_features,
) -> Comparison:
    """Accuracy, precision, recall, F1 and AUC of every model on the same rows."""
    names = list(CLASSIFIERS) if models is None else models
    return _compare(df, features, target, names, params, keys, test_size, random_state, stratify, True, preparer)


def compare_regressors(
    df: DataFrame, features: list[str], target: str, models: list[str] | None = None,
    params: dict[str, dict] | None = None, keys: list[str] | None = None, test_size: float = 0.2,
    random_state: int = 42, preparer=fit_features,
) -> Comparison:
    """MAE, RMSE and R2 of every model on the same rows."""
    names = list(REGRESSORS) if models is None else models
    return _compare(df, features, target, names, params, keys, test_size, random_state, False, False, preparer)


def _by_merit(table: DataFrame) -> list:
    order = ["accuracy", "f1"] if "accuracy" in table.columns else ["r2"]
    return [*[F.desc(c) for c in order], F.asc("model")]


def ranked(table: DataFrame) -> DataFrame:
    """Adds ``place``: accuracy then F1, or R2; equal ones by name. One row per model."""
    place = F.row_number().over(Window.orderBy(*_by_merit(table))).cast("bigint")
    return table.withColumn("place", place)


def best_model(table: DataFrame) -> DataFrame:
    return table.orderBy(*_by_merit(table)).limit(1).select("model")


def metrics_long(table: DataFrame) -> DataFrame:
    """``model, metric, value`` without the scores a model does not have."""
    names = [c for c in table.columns if c != "model"]
    return table.unpivot("model", names, "metric", "value").filter("value is not null")


def rounded_table(table: DataFrame, digits: int = 4) -> DataFrame:
    return rounded(table, digits)


def roc_overlay(scored: DataFrame) -> DataFrame:
    """ROC points per model from ``model, class, score, positive`` rows."""
    return metrics.roc_points(scored, ("model", "class"))


def overlay_rows(comparison: Comparison) -> DataFrame | None:
    """The rows behind an overlay; None unless all models are binary with probabilities."""
    classes = comparison.classes
    if classes is None or len(classes) != 2:
        return None
    if any("probability" not in s.columns for s in comparison.scored.values()):
        return None
    pieces = None
    for name, scored in comparison.scored.items():
        rows = metrics.one_vs_rest(scored, classes, "actual", "probability")
        rows = rows.filter(col("class") == str(classes[1])).withColumn("model", F.lit(name))
        pieces = rows if pieces is None else pieces.unionByName(rows)
    return pieces
