"""Cleaning: missing values, duplicates, outliers, category encoding, scaling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.columns import as_number, col, existing, is_numeric, rows_of
from ..functions.ordering import WINDOW_ROWS, join_codes, value_codes
from ..functions.quantiles import DISTINCT_LIMIT, column_quantiles
from .profile import value_counts

# The names the strategies and methods go by.
MISSING_STRATEGIES = ["drop rows", "drop columns", "mean", "median", "mode", "constant"]
ENCODING_METHODS = ["one-hot", "label"]
SCALING_METHODS = ["StandardScaler", "MinMaxScaler", "RobustScaler"]
OUTLIER_THRESHOLD = 1.5
# A table gets one new column per category; more than this is an error, not a cut.
MAX_ONE_HOT = 1_000


def drop_missing_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    names = existing(df, columns)
    return df.dropna("any", subset=names) if names else df


def drop_missing_target(df: DataFrame, target: str) -> DataFrame:
    return df.filter(col(target).isNotNull())


def replace_columns(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    """Swap columns for expressions in one projection, order kept."""
    return df.select(*[new[c].alias(c) if c in new else col(c) for c in df.columns])


def fit_fill_values(
    df: DataFrame,
    columns: list[str],
    strategy: str,
    fill_value=None,
    distinct_limit: int = DISTINCT_LIMIT,
) -> tuple[dict[str, object], list[str]]:
    """The value that fills each column, and a warning for each column left alone."""
    names = existing(df, columns)
    fills: dict[str, object] = {}
    warnings = []
    numbers = [c for c in names if is_numeric(df.schema[c].dataType)]
    if strategy in ("mean", "median"):
        for c in names:
            if c not in numbers:
                warnings.append(f"`{c}` holds no numbers, so it has no {strategy}.")
        if strategy == "median":
            medians, _ = column_quantiles(df, numbers, [0.5], distinct_limit)
            fills = {c: medians[c][0] for c in numbers}
        elif numbers:
            row = df.agg(*[F.avg(as_number(df, c)).alias(f"a{i}") for i, c in enumerate(numbers)]).first()
            fills = {c: row[i] for i, c in enumerate(numbers)}
    elif strategy == "mode":
        fills = column_modes(df, names)
    elif strategy == "constant":
        fills = {c: _typed_constant(df, c, fill_value) for c in names}
    else:
        raise ValueError(f"Unknown strategy `{strategy}`.")
    for c in [c for c, v in fills.items() if v is None]:
        warnings.append(f"`{c}` is NULL throughout; nothing to fill it with.")
        del fills[c]
    return fills, warnings


def column_modes(df: DataFrame, columns: list[str]) -> dict[str, object]:
    """Most frequent value per column, the smallest of ties.

    Values are counted in one shuffle, never kept in one aggregation buffer.
    """
    if not columns:
        return {}
    counts = value_counts(df, columns)
    typed = []
    for c in columns:
        # Ties are ordered in the column's own type: 9 before 10.
        value = F.when(F.col("column") == c, F.col("value").cast(df.schema[c].dataType))
        order = F.struct((-F.col("n")).alias("n"), value.alias("v"))
        typed.append(F.min_by(value, F.when(F.col("column") == c, order)))
    row = counts.agg(*[t.alias(f"m{i}") for i, t in enumerate(typed)]).first()
    return {c: row[i] for i, c in enumerate(columns)}


def _typed_constant(df: DataFrame, c: str, value):
    """The constant in the column's own type; a value that does not fit is an error."""
    if value is None:
        return None
    dtype = df.schema[c].dataType
    try:
        if isinstance(dtype, (T.FloatType, T.DoubleType)):
            return float(value)
        if is_numeric(dtype):
            number = float(value)
            if number != int(number) and not isinstance(dtype, T.DecimalType):
                raise ValueError(value)
            return number if isinstance(dtype, T.DecimalType) else int(number)
    except (TypeError, ValueError):
        raise ValueError(f"{value!r} cannot fill column `{c}` of type {dtype.simpleString()}.") from None
    return value


def apply_fill_values(df: DataFrame, fills: dict[str, object]) -> DataFrame:
    """Fill NULLs with learned values. A fractional fill widens a whole-number column."""
    new = {}
    for c, value in fills.items():
        if c not in df.columns:
            continue
        dtype = df.schema[c].dataType
        if isinstance(value, float) and is_numeric(dtype) and not isinstance(dtype, T.DecimalType):
            new[c] = F.coalesce(col(c).cast("double"), F.lit(value))
        else:
            new[c] = F.coalesce(col(c), F.lit(value).cast(dtype))
    return replace_columns(df, new) if new else df


def handle_missing(
    df: DataFrame,
    columns: list[str],
    strategy: str = "median",
    fill_value=None,
    distinct_limit: int = DISTINCT_LIMIT,
    warnings: list[str] | None = None,
) -> DataFrame:
    """Apply one of ``MISSING_STRATEGIES`` to the selected columns.

    What could not be filled is told in a line each, added to ``warnings`` if it is given.
    """
    if strategy not in MISSING_STRATEGIES:
        raise ValueError(f"Unknown strategy `{strategy}`.")
    names = existing(df, columns)
    if not names:
        return df
    if strategy == "drop rows":
        return drop_missing_rows(df, names)
    if strategy == "drop columns":
        return df.drop(*names)
    fills, told = fit_fill_values(df, names, strategy, fill_value, distinct_limit)
    if warnings is not None:
        warnings += told
    return apply_fill_values(df, fills)


def remove_duplicates(df: DataFrame) -> DataFrame:
    """One row of each set of equal rows; NULLs are equal."""
    return df.dropDuplicates()


def outlier_limits(
    df: DataFrame,
    columns: list[str],
    threshold: float = OUTLIER_THRESHOLD,
    distinct_limit: int = DISTINCT_LIMIT,
) -> dict[str, tuple[float, float]]:
    """Lower and upper limit per column by the IQR rule."""
    names = existing(df, columns)
    quartiles, _ = column_quantiles(df, names, [0.25, 0.75], distinct_limit)
    limits = {}
    for c in names:
        q1, q3 = quartiles[c]
        if q1 is None:
            limits[c] = (None, None)
        else:
            limits[c] = (q1 - threshold * (q3 - q1), q3 + threshold * (q3 - q1))
    return limits


def outside(df: DataFrame, c: str, limits: tuple[float, float]) -> Column:
    """Below the lower or above the upper limit; a NULL is not outside."""
    low, high = limits
    if low is None:
        return F.lit(False)
    x = as_number(df, c)
    return F.coalesce((x < F.lit(low)) | (x > F.lit(high)), F.lit(False))


def outlier_mask(df: DataFrame, columns: list[str], threshold: float = OUTLIER_THRESHOLD,
                 distinct_limit: int = DISTINCT_LIMIT) -> DataFrame:
    """The table with one boolean ``<column>_outlier`` per selected column."""
    limits = outlier_limits(df, columns, threshold, distinct_limit)
    return df.select("*", *[outside(df, c, lim).alias(f"{c}_outlier") for c, lim in limits.items()])


def outlier_counts(df: DataFrame, columns: list[str], threshold: float = OUTLIER_THRESHOLD,
                   distinct_limit: int = DISTINCT_LIMIT) -> DataFrame:
    limits = outlier_limits(df, columns, threshold, distinct_limit)
    wide = df.agg(
        *[F.count(F.when(outside(df, c, lim), 1)).alias(f"o{i}") for i, (c, lim) in enumerate(limits.items())]
    )
    return wide.select(
        rows_of([{"column": F.lit(c), "outliers": F.col(f"o{i}")} for i, c in enumerate(limits)])
    )


def remove_outliers(df: DataFrame, columns: list[str], threshold: float = OUTLIER_THRESHOLD,
                    distinct_limit: int = DISTINCT_LIMIT) -> DataFrame:
    """Drop rows that are outside in any selected column; rows with NULLs stay."""
    limits = outlier_limits(df, columns, threshold, distinct_limit)
    if not limits:
        return df
    return df.filter(~reduce(Column.__or__, [outside(df, c, lim) for c, lim in limits.items()]))


def category_counts(df: DataFrame, columns: list[str], limit: int) -> dict[str, dict[str, int]]:
    """Every value of each text column with its count. More than ``limit`` values is an error."""
    names = existing(df, columns)
    if not names:
        return {}
    rows = value_counts(df, names).limit(limit * len(names) + 1).collect()
    found: dict[str, dict[str, int]] = {c: {} for c in names}
    for c, value, n in rows:
        found[c][value] = n
    wide = [c for c in names if len(found[c]) > limit]
    if wide or len(rows) > limit * len(names):
        raise ValueError(f"Too many distinct values to encode: {', '.join(wide or names)}.")
    return found


def fit_categories(df: DataFrame, columns: list[str], limit: int) -> dict[str, list[str]]:
    """Sorted distinct values of each column, as text."""
    return {c: sorted(v) for c, v in category_counts(df, columns, limit).items()}


def one_hot_columns(categories: dict[str, list[str]]) -> list[Column]:
    """0/1 int columns ``<column>_<value>``; NULL and unseen values give all zeros."""
    return [
        F.coalesce((col(c).cast("string") == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}_{v}")
        for c, values in categories.items()
        for v in values
    ]


def encode_categorical(
    df: DataFrame,
    columns: list[str],
    method: str = "one-hot",
    max_categories: int = MAX_ONE_HOT,
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """One-hot columns at the end, or the place of the value among the sorted ones (NULL -1)."""
    names = existing(df, columns)
    if not names:
        return df
    if method == "one-hot":
        categories = fit_categories(df, names, max_categories)
        kept = [col(c) for c in df.columns if c not in names]
        return df.select(*kept, *one_hot_columns(categories))
    if method != "label":
        raise ValueError(f"Unknown encoding `{method}`.")
    result = df
    for c in names:
        codes = value_codes(df, col(c), window_rows)
        codes = codes.withColumn("_v", F.col("_v").cast("string"))
        joined = join_codes(result, c, codes, "_code")
        result = joined.select(
            *[
                F.coalesce("_code", F.lit(-1)).alias(c) if n == c else col(n)
                for n in result.columns
            ]
        )
    return result


def missing_guard(df: DataFrame, columns: list[str], what: str) -> None:
    """One scan; raises when any of the columns holds a NULL."""
    if not columns:
        return
    row = df.agg(*[F.count(F.when(col(c).isNull(), 1)).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    holes = [c for i, c in enumerate(columns) if row[i]]
    if holes:
        raise ValueError(f"NULLs in {', '.join(holes)}: fill or drop them before you {what} the column.")


def fit_scaler(
    df: DataFrame,
    columns: list[str],
    method: str = "StandardScaler",
    distinct_limit: int = DISTINCT_LIMIT,
    refuse_missing: bool = False,
) -> dict[str, tuple[float, float]]:
    """``{column: (shift, divisor)}``; a constant column divides by one.

    The check for missing values, if asked for, is part of the same scan.
    """
    names = existing(df, columns)
    if method not in SCALING_METHODS:
        raise ValueError(f"Unknown scaling method `{method}`.")
    aggs = [F.count(F.when(col(c).isNull(), 1)).alias(f"m{i}") for i, c in enumerate(names)]
    if method == "RobustScaler":
        q, row = column_quantiles(df, names, [0.25, 0.5, 0.75], distinct_limit, aggs)
        found = {c: (q[c][1], None if q[c][0] is None else q[c][2] - q[c][0]) for c in names}
    else:
        for i, c in enumerate(names):
            x = as_number(df, c)
            if method == "StandardScaler":
                # A constant column has spread zero, whatever rounding says.
                spread = F.when(F.min(x) < F.max(x), F.stddev_pop(x)).otherwise(F.lit(0.0))
                aggs += [F.avg(x).alias(f"s{i}"), spread.alias(f"d{i}")]
            else:
                aggs += [F.min(x).alias(f"s{i}"), (F.max(x) - F.min(x)).alias(f"d{i}")]
        row = df.agg(*aggs).first() if aggs else {}
        found = {c: (row[f"s{i}"], row[f"d{i}"]) for i, c in enumerate(names)}
    holes = [c for i, c in enumerate(names) if row[f"m{i}"]]
    if refuse_missing and holes:
        raise ValueError(f"NULLs in {', '.join(holes)}: fill or drop them before you scale the column.")
    return {c: (s, d if d else 1.0) for c, (s, d) in found.items() if s is not None}


def apply_scaler(df: DataFrame, scaler: dict[str, tuple[float, float]]) -> DataFrame:
    return replace_columns(
        df, {c: (as_number(df, c) - F.lit(s)) / F.lit(d) for c, (s, d) in scaler.items() if c in df.columns}
    )


def scale_numeric(
    df: DataFrame,
    columns: list[str],
    method: str = "StandardScaler",
    distinct_limit: int = DISTINCT_LIMIT,
) -> DataFrame:
    """Scale columns that have no missing values."""
    names = existing(df, columns)
    if not names:
        return df
    return apply_scaler(df, fit_scaler(df, names, method, distinct_limit, refuse_missing=True))


def removed_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """``removed_rows, kept_rows`` of a cleaning step."""
    one = F.lit(1)
    a = before.agg(F.count(F.lit(1)).alias("before")).withColumn("_one", one)
    b = after.agg(F.count(F.lit(1)).alias("kept_rows")).withColumn("_one", one)
    return a.join(b, "_one").select((F.col("before") - F.col("kept_rows")).alias("removed_rows"), "kept_rows")
