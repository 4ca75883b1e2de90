"""Learned preparation: fitted on the training side, applied unchanged to any table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import (
    as_number, categorical_feature_columns, col, existing, numeric_columns,
)
from ..functions.ordering import WINDOW_ROWS, join_codes, value_codes
from ..functions.quantiles import DISTINCT_LIMIT, column_quantiles
from ..functions.storage import cut_lineage
from .clean import (
    MAX_ONE_HOT, apply_fill_values, apply_scaler, category_counts, fit_categories,
    fit_fill_values, fit_scaler,
)

# The category lists of a model's features are held on the driver.
MAX_MODEL_CATEGORIES = 100_000
NULL_CATEGORY = "nan"


@dataclass(frozen=True)
class Preparation:
    """Fitted impute, encode and scale steps.

    One-hot categories are lists, as each makes a column; ordinal codes are tables.
    """

    fills: dict[str, object] = field(default_factory=dict)
    categories: dict[str, list[str]] = field(default_factory=dict)
    null_category: dict[str, bool] = field(default_factory=dict)
    codes: dict[str, DataFrame] = field(default_factory=dict)
    method: str = "one-hot"
    scaler: dict[str, tuple[float, float]] = field(default_factory=dict)
    imputed: tuple[str, ...] = ()

    def apply(self, df: DataFrame) -> DataFrame:
        """Imputed, encoded and scaled columns first, untouched columns after them."""
        filled = apply_scaler(apply_fill_values(df, self.fills), self.scaler)
        encoded = [c for c in (self.categories or self.codes) if c in df.columns]
        for c, codes in self.codes.items():
            if c in df.columns:
                filled = join_codes(filled, c, codes, f"_code_{c}")
        first = [c for c in self.imputed if c in df.columns and c not in encoded]
        scaled = [c for c in self.scaler if c in df.columns and c not in first]
        rest = [c for c in df.columns if c not in {*first, *encoded, *scaled}]
        out = [col(c) for c in first]
        for c in encoded:
            out += self._encoded(c)
        return filled.select(*out, *map(col, scaled), *map(col, rest))

    def _encoded(self, c: str) -> list[Column]:
        text = col(c).cast("string")
        if self.method == "one-hot":
            names = self.categories[c] + ([NULL_CATEGORY] if self.null_category.get(c) else [])
            shown = F.coalesce(text, F.lit(NULL_CATEGORY)) if self.null_category.get(c) else text
            return [
                F.coalesce((shown == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}_{v}")
                for v in names
            ]
        code = F.coalesce(col(f"_code_{c}"), F.lit(-1))
        return [F.when(text.isNotNull(), code).alias(c)]


def fit_preparation(
    train: DataFrame,
    impute_columns: list[str] | None = None,
    impute_strategy: str = "median",
    impute_fill_value=None,
    encode_columns: list[str] | None = None,
    encode_method: str = "one-hot",
    scale_columns: list[str] | None = None,
    scale_method: str = "StandardScaler",
    max_categories: int = MAX_ONE_HOT,
    distinct_limit: int = DISTINCT_LIMIT,
) -> Preparation | None:
    """Learn from the training rows only. None when no step was asked for.

    A column that is both imputed and scaled is imputed first and comes out once.
    """
    impute = existing(train, impute_columns)
    encode = existing(train, encode_columns)
    scale = existing(train, scale_columns)
    if not (impute or encode or scale):
        return None
    fills: dict[str, object] = {}
    if impute:
        fills, _ = fit_fill_values(train, impute, impute_strategy, impute_fill_value, distinct_limit)
    filled = apply_fill_values(train, fills)
    if encode_method != "one-hot":
        codes = {}
        for c in encode:
            codes[c] = cut_lineage(value_codes(filled, col(c).cast("string"), WINDOW_ROWS))
        scaler = fit_scaler(filled, scale, scale_method, distinct_limit) if scale else {}
        return Preparation(fills, codes=codes, method=encode_method, scaler=scaler, imputed=tuple(impute))
    categories = fit_categories(filled, encode, max_categories)
    nulls = {}
    if encode:
        seen = filled.agg(
            *[F.count(F.when(col(c).isNull(), 1)).alias(f"m{i}") for i, c in enumerate(encode)]
        ).first()
        nulls = {c: seen[i] > 0 for i, c in enumerate(encode)}
    scaler = fit_scaler(filled, scale, scale_method, distinct_limit) if scale else {}
    return Preparation(fills, categories, nulls, {}, encode_method, scaler, tuple(impute))


@dataclass(frozen=True)
class FeatureTable:
    """The default model features: standardised numbers and one-hot text."""

    medians: dict[str, float]
    scaler: dict[str, tuple[float, float]]
    modes: dict[str, str]
    categories: dict[str, list[str]]

    @property
    def numeric(self) -> list[str]:
        return list(self.medians)

    @property
    def names(self) -> list[str]:
        """Names of the expanded features, in vector order."""
        return [f"numeric__{c}" for c in self.medians] + [
            f"categorical__{c}_{v}" for c, values in self.categories.items() for v in values
        ]

    def _number(self, df: DataFrame, c: str) -> Column:
        shift, divisor = self.scaler[c]
        return (F.coalesce(as_number(df, c), F.lit(self.medians[c])) - F.lit(shift)) / F.lit(divisor)

    def columns(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """One column per feature, next to the columns in ``keep``."""
        out = [self._number(df, c).alias(f"numeric__{c}") for c in self.medians]
        for c, values in self.categories.items():
            text = F.coalesce(col(c), F.lit(self.modes[c]))
            out += [(text == F.lit(v)).cast("int").alias(f"categorical__{c}_{v}") for v in values]
        return df.select(*map(col, keep), *out)

    def vectors(self, df: DataFrame, keep: list[str], name: str = "features") -> DataFrame:
        """The same features as one (sparse where it pays) vector column."""
        numbers = [self._number(df, c).alias(f"_x{i}") for i, c in enumerate(self.medians)]
        texts = [
            F.coalesce(col(c), F.lit(self.modes[c])).alias(f"_t{i}")
            for i, c in enumerate(self.categories)
        ]
        wide = df.select(*map(col, keep), *numbers, *texts)
        inputs = [f"_x{i}" for i in range(len(numbers))]
        if texts:
            raw = [f"_t{i}" for i in range(len(texts))]
            codes = [f"_i{i}" for i in range(len(texts))]
            hot = [f"_o{i}" for i in range(len(texts))]
            indexed = wide
            for source, code, labels in zip(raw, codes, self.categories.values()):
                indexed = StringIndexerModel.from_labels(
                    labels, inputCol=source, outputCol=code, handleInvalid="keep"
                ).transform(indexed)
            # "keep" adds a last slot for unseen text; dropping it leaves all zeros there.
            encoder = OneHotEncoder(inputCols=codes, outputCols=hot, dropLast=True)
            wide = encoder.fit(indexed).transform(indexed)
            inputs += hot
        assembled = VectorAssembler(inputCols=inputs, outputCol=name).transform(wide)
        return assembled.select(*map(col, keep), name)


def fit_features(
    train: DataFrame,
    features: list[str],
    max_categories: int = MAX_MODEL_CATEGORIES,
    distinct_limit: int = DISTINCT_LIMIT,
) -> FeatureTable | None:
    """Median-impute and standardise numbers, mode-impute and one-hot encode text.

    Other column types are left out, and so is a column with no value in training.
    None when nothing is left.
    """
    chosen = train.select(*map(col, existing(train, features)))
    numbers, texts = numeric_columns(chosen), categorical_feature_columns(chosen)
    medians, scaler = _fit_numbers(chosen, numbers, distinct_limit) if numbers else ({}, {})
    counts = category_counts(chosen, texts, max_categories)
    counts = {c: found for c, found in counts.items() if found}
    modes = {c: min(found, key=lambda v: (-found[v], v)) for c, found in counts.items()}
    categories = {c: sorted(found) for c, found in counts.items()}
    if not (medians or categories):
        return None
    return FeatureTable(medians, scaler, modes, categories)


def _fit_numbers(df: DataFrame, columns: list[str], distinct_limit: int):
    """Medians, and mean and spread of the columns as they are once the holes are filled.

    Filling m holes with the median moves mean and variance in a known way, so the table
    is not read again after the medians are known.
    """
    extra = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(columns):
        x = as_number(df, c)
        extra += [
            F.avg(x).alias(f"a{i}"), F.var_pop(x).alias(f"v{i}"),
            (F.min(x) < F.max(x)).alias(f"varies{i}"),
        ]
    found, seen = column_quantiles(df, columns, [0.5], distinct_limit, extra)
    medians, scaler = {}, {}
    for i, c in enumerate(columns):
        if found[c][0] is None:
            continue
        n, median = seen[f"_n{i}"], found[c][0]
        holes = seen["rows"] - n
        mean = (n * seen[f"a{i}"] + holes * median) / (n + holes)
        variance = (
            n * (seen[f"v{i}"] + (seen[f"a{i}"] - mean) ** 2) + holes * (median - mean) ** 2
        ) / (n + holes)
        medians[c] = median
        scaler[c] = (mean, variance**0.5 if seen[f"varies{i}"] and variance > 0 else 1.0)
    return medians, scaler


def input_defaults(df: DataFrame, features: list[str], limit: int = 50,
                   distinct_limit: int = DISTINCT_LIMIT) -> DataFrame:
    """Defaults of a prediction form: the median of a number, the sorted values of a text."""
    chosen = df.select(*map(col, existing(df, features)))
    numbers, texts = numeric_columns(chosen), categorical_feature_columns(chosen)
    medians, _ = column_quantiles(chosen, numbers, [0.5], distinct_limit) if numbers else ({}, None)
    values = fit_categories(chosen, texts, limit)
    rows = [(c, "numeric", medians[c][0], None) for c in numbers]
    rows += [(c, "text", None, ",".join(values[c])) for c in texts]
    return df.sparkSession.createDataFrame(
        rows, "feature string, kind string, median double, choices string"
    )
