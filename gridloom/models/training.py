"""Train, score and cross-validate: split, prepare on train only, fit, predict everywhere."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.columns import as_number, col, existing, is_numeric
from ..operators import metrics
from ..operators.clean import drop_missing_target
from ..operators.prepare import FeatureTable, fit_features
from ..operators.profile import MAX_TARGET_CLASSES, type_name
from ..operators.split import SPLIT, TEST, TRAIN, assign_folds, split_train_test
from .one_vs_rest import in_parallel
from .registry import fit_model

# Classes a model is trained for unless the caller allows more: each has a slot in the
# probability array.
MAX_MODEL_CLASSES = 1_000


def validate_classification_target(df: DataFrame, target: str) -> DataFrame:
    """One row per class (``class, count``) with ``n_classes, missing, data_type``; or an error."""
    if target not in df.columns:
        raise ValueError(f"The table has no column `{target}`.")
    seen = df.groupBy(col(target).alias("c")).agg(F.count("*").alias("n"))
    facts = seen.agg(
        F.count("c").alias("classes"),
        F.coalesce(F.sum(F.when(F.col("c").isNull(), F.col("n"))), F.lit(0)).alias("missing"),
    ).first()
    if facts["classes"] == 0:
        raise ValueError(f"`{target}` is NULL in every row.")
    if facts["classes"] < 2:
        raise ValueError(f"`{target}` always has the same value; there is nothing to tell apart.")
    dtype = df.schema[target].dataType
    if is_numeric(dtype) and facts["classes"] > MAX_TARGET_CLASSES:
        raise ValueError(
            f"`{target}` has {facts['classes']} different numbers: too many classes, this is a "
            "target for regression."
        )
    return seen.filter("c is not null").select(
        F.col("c").cast("string").alias("class"), F.col("n").alias("count"),
        F.lit(facts["classes"]).cast("bigint").alias("n_classes"),
        F.lit(facts["missing"]).cast("bigint").alias("missing"),
        F.lit(type_name(dtype)).alias("data_type"),
    )


def validate_regression_target(df: DataFrame, target: str) -> DataFrame:
    """One row: n_values, missing, n_unique, min, max, mean, data_type; or an error."""
    if target not in df.columns:
        raise ValueError(f"The table has no column `{target}`.")
    dtype = df.schema[target].dataType
    y = col(target)
    if not is_numeric(dtype) and not isinstance(dtype, T.BooleanType):
        if df.filter(y.isNotNull()).isEmpty():
            raise ValueError(f"`{target}` is NULL in every row.")
        raise ValueError(f"`{target}` holds no numbers; it is a target for classification.")
    v = as_number(df, target)
    facts = df.select(v.alias("v")).groupBy("v").agg(F.count("*").alias("n")).agg(
        F.sum(F.when(F.col("v").isNotNull(), F.col("n"))).alias("n_values"),
        F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("missing"),
        F.count("v").alias("n_unique"), F.min("v").alias("min"), F.max("v").alias("max"),
        F.try_divide(F.sum(F.col("v") * F.col("n")), F.sum(F.when(F.col("v").isNotNull(), F.col("n"))).cast("double")).alias("mean"),
        F.lit(type_name(dtype)).alias("data_type"),
    )
    row = facts.first()
    if not row["n_unique"]:
        raise ValueError(f"`{target}` is NULL in every row.")
    if row["min"] == row["max"]:
        raise ValueError(f"`{target}` never varies; a regression on it is pointless.")
    return df.sparkSession.createDataFrame([row], facts.schema)


def class_list(df: DataFrame, target: str, limit: int = MAX_MODEL_CLASSES) -> list:
    rows = df.select(col(target)).filter(col(target).isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"`{target}` has more than {limit} classes; allow more with `max_classes`.")
    return sorted(r[0] for r in rows)


def encode_labels(df: DataFrame, target: str, classes: list, name: str = "label") -> DataFrame:
    """Adds the place of the label among the sorted classes."""
    return df.withColumn(name, _class_number(col(target), classes))


def _class_number(value: Column, classes: list) -> Column:
    """A class that is not in the list (it may turn up in testing) gets no number."""
    names = F.array(*[F.lit(c) for c in classes])
    return F.nullif(F.array_position(names, value), F.lit(0)).cast("double") - 1


def _class_value(number: Column, classes: list) -> Column:
    names = F.array(*[F.lit(c) for c in classes])
    return F.get(names, number.cast("int"))


def _row_key(keys: list[str] | None, features: list[str]) -> Column:
    """What rows are ordered and dealt by: the caller's keys, else the features alone."""
    keys = keys or features
    return col(keys[0]) if len(keys) == 1 else F.to_json(F.struct(*map(col, keys)))


@dataclass
class Trained:
    """A fitted model and its prepared rows, both sides scored at most once.

    Scored tables hold ``keys, split, actual, predicted`` and, for classifiers,
    ``probability``. Prepared rows and scored sides stay persisted for the reports made
    from them until ``close()``, or the end of a ``with`` block; later reads compute anew.
    """

    model: object
    features: FeatureTable
    classes: list | None
    rows: DataFrame
    keep: list[str]
    _sides: dict = field(default_factory=dict, repr=False)

    def _side(self, side: str) -> DataFrame:
        if side not in self._sides:
            rows = self.rows.filter(F.col(SPLIT) == side)
            self._sides[side] = _finish(self.model.score(rows), self.keep, self.classes).persist()
        return self._sides[side]

    def close(self) -> None:
        for held in (self.rows, *self._sides.values()):
            held.unpersist()

    def __enter__(self) -> Trained:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    @property
    def train(self) -> DataFrame:
        return self._side(TRAIN)

    @property
    def test(self) -> DataFrame:
        return self._side(TEST)

    @property
    def scored(self) -> DataFrame:
        return self.train.unionByName(self.test)

    @property
    def metrics(self) -> DataFrame:
        if self.classes is None:
            return metrics.regression_metrics(self.test)
        return metrics.classification_metrics(self.test, n_classes=len(self.classes))

    @property
    def report(self) -> DataFrame:
        return metrics.classification_report(self.test, self.classes)

    @property
    def confusion(self) -> DataFrame:
        return metrics.confusion_matrix(self.test, self.classes)

    @property
    def predictions(self) -> DataFrame:
        kept = [c for c in self.keep if c != SPLIT]
        return metrics.prediction_frame(self.test, "actual", "predicted", kept)

    @property
    def scores(self) -> DataFrame:
        task = "regression" if self.classes is None else "classification"
        return metrics.generalisation(self.scored, task)

    def predict(self, df: DataFrame, keys: list[str]) -> DataFrame:
        """Score another table: ``keys, prediction`` and one probability per class."""
        wide = df.select("*", _row_key(keys, keys).alias("_key"))
        scored = self.model.score(self.features.vectors(wide, [*dict.fromkeys([*keys, "_key"])]))
        if self.classes is None:
            return scored.select(*map(col, keys), "prediction")
        return scored.select(
            *map(col, keys), _class_value(F.col("prediction"), self.classes).alias("prediction"),
            *(["probability"] if "probability" in scored.columns else []),
        )


def class_probabilities(predicted: DataFrame, keys: list[str], classes: list) -> DataFrame:
    """Long form: one row per scored row and class."""
    names = F.array(*[F.lit(str(c)) for c in classes])
    return predicted.select(
        *map(col, keys), F.posexplode("probability").alias("_i", "probability")
    ).select(*map(col, keys), F.get(names, F.col("_i")).alias("class"), "probability")


def feature_importance(model, names: list[str], spark) -> DataFrame | None:
    """``feature, importance`` in descending order; None if the model cannot be read."""
    weights = getattr(model, "weights", None)
    if weights is None or not names or len(weights) != len(names):
        return None
    rows = [(n, float(w)) for n, w in zip(names, weights)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def prepare_rows(
    df: DataFrame, features: list[str], target: str, keys: list[str] | None, classes: list | None,
    train_rows: Column, keep: list[str], preparer=fit_features,
) -> tuple[FeatureTable, DataFrame]:
    """Learn the preparation from the rows of ``train_rows``; vectors and label for all."""
    chosen = [c for c in existing(df, features) if c != target]
    if not chosen:
        raise ValueError("No feature column was given.")
    table = preparer(df.filter(train_rows), chosen)
    if table is None:
        raise ValueError("The features are all empty or of types that cannot be used.")
    label = as_number(df, target) if classes is None else _class_number(col(target), classes)
    wide = df.select(
        "*", _row_key(keys, chosen).alias("_key"), label.alias("label"), col(target).alias("_actual")
    )
    return table, table.vectors(wide, [*dict.fromkeys([*keep, "_key", "label", "_actual"])])


def _finish(scored: DataFrame, keep: list[str], classes: list | None) -> DataFrame:
    if classes is None:
        return scored.select(*keep, F.col("label").alias("actual"), F.col("prediction").alias("predicted"))
    extra = ["probability"] if "probability" in scored.columns else []
    return scored.select(
        *keep, F.col("_actual").alias("actual"),
        _class_value(F.col("prediction"), classes).alias("predicted"), *extra,
    )


def _train(
    df, features, target, model, params, keys, test_size, seed, stratify, classify, preparer, max_classes=MAX_MODEL_CLASSES
) -> Trained:
    df = drop_missing_target(df, target)
    if df.isEmpty():
        raise ValueError(f"`{target}` is NULL in every row.")
    wanted = [*dict.fromkeys([*(keys or []), *existing(df, features), target])]
    split = split_train_test(df.select(*map(col, wanted)) if keys else df, target, keys, test_size, seed, stratify)
    train_rows = F.col(SPLIT) == TRAIN
    classes = class_list(split.filter(train_rows), target, max_classes) if classify else None
    keep = [*(keys or []), SPLIT]
    table, rows = prepare_rows(split, features, target, keys, classes, train_rows, keep, preparer)
    # Learners read their rows several times, and so do the reports after them.
    rows.persist()
    try:
        fitted = fit_model(model, rows.filter(train_rows), classes, params, seed)
    except BaseException:
        rows.unpersist()
        raise
    return Trained(fitted, table, classes, rows, keep)


def train_classifier(
    df: DataFrame, features: list[str], target: str, model="Logistic Regression",
    params: dict | None = None, keys: list[str] | None = None, test_size: float = 0.2,
    random_state: int = 42, stratify: bool = False, preparer=fit_features,
    max_classes: int = MAX_MODEL_CLASSES,
) -> Trained:
    """Drop rows without a target, split, learn preparation and model on train, score all.

    More than ``max_classes`` classes are refused. A preparer with a higher bound on
    categories is ``functools.partial(fit_features, max_categories=...)``.
    """
    return _train(
        df, features, target, model, params, keys, test_size, random_state, stratify, True, preparer, max_classes
    )


def train_regressor(
    df: DataFrame, features: list[str], target: str, model="Linear Regression",
    params: dict | None = None, keys: list[str] | None = None, test_size: float = 0.2,
    random_state: int = 42, preparer=fit_features,
) -> Trained:
    return _train(df, features, target, model, params, keys, test_size, random_state, False, False, preparer)


def cross_validate(
    df: DataFrame, features: list[str], target: str, model, params: dict | None = None,
    keys: list[str] | None = None, task: str = "classification", n_folds: int = 5,
    random_state: int = 42, preparer=fit_features, max_classes: int = MAX_MODEL_CLASSES,
) -> DataFrame:
    """``fold, score``: accuracy or R2 of each fold, with a preparation learned per fold."""
    df = drop_missing_target(df, target)
    classify = task == "classification"
    used = [*dict.fromkeys([*(keys or []), *existing(df, features), target])]
    df = df.select(*map(col, used)) if keys else df
    # Dealt once and held: every fold reads the rows several times, and keys are costly to hash.
    folds = assign_folds(df, keys, n_folds, random_state, target if classify else None).persist()

    def one(fold: int) -> tuple[int, float]:
        inside = F.col("fold") != fold
        _, data = prepare_rows(folds, features, target, keys, classes, inside, ["fold"], preparer)
        fitted = fit_model(model, data.filter(inside), classes, params, random_state)
        held = _finish(fitted.score(data.filter(~inside)), ["fold"], classes)
        if classify:
            hit = (F.col("actual") == F.col("predicted")).cast("double")
            return fold, float(held.agg(F.avg(hit)).first()[0])
        return fold, float(metrics.regression_metrics(held).first()["r2"])

    try:
        classes = class_list(folds, target, max_classes) if classify else None
        rows = in_parallel(one, list(range(n_folds)))
    finally:
        folds.unpersist()
    return df.sparkSession.createDataFrame(rows, "fold int, score double")
