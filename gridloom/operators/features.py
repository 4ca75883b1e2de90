"""Feature engineering: arithmetic, transforms, bins, date and text parts, selection."""

from __future__ import annotations

import math
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.columns import as_number, col, existing, is_numeric, numeric_columns, pearson, require
from ..functions.quantiles import DISTINCT_LIMIT, column_quantiles
from .clean import missing_guard

# The names that operations, parts and new columns go by.
NUMERIC_OPERATIONS = {"sum": "plus", "difference": "minus", "product": "times", "ratio": "over"}
MATH_SUFFIXES = {"log": "_log", "sqrt": "_sqrt", "square": "_squared"}
BINNING_METHODS = ["equal width", "quantile"]
DATETIME_PARTS = ["year", "month", "day", "weekday"]
TEXT_PARTS = ["length", "word count"]

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType)


def _wide(df: DataFrame, name: str) -> Column:
    """Small integers as bigint, so that sums and products do not overflow."""
    dtype = df.schema[name].dataType
    return col(name).cast("bigint") if isinstance(dtype, _INTEGRAL) else col(name)


def _add(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    """New columns at the end; a name that exists is replaced where it stands."""
    kept = [new[c].alias(c) if c in new else col(c) for c in df.columns]
    return df.select(*kept, *[x.alias(c) for c, x in new.items() if c not in df.columns])


def _refuse(df: DataFrame, checks: dict[str, Column], message: str) -> None:
    """One scan over all checks; raises for the columns where a row meets one."""
    if not checks:
        return
    row = df.agg(*[F.count(F.when(bad, 1)).alias(f"b{i}") for i, bad in enumerate(checks.values())]).first()
    hit = [c for i, c in enumerate(checks) if row[i]]
    if hit:
        raise ValueError(message.format(", ".join(hit)))


def create_numeric_feature(
    df: DataFrame, col_a: str, col_b: str, operation: str = "sum", name: str | None = None,
    on_zero: str = "error",
) -> DataFrame:
    """Combine two numeric columns. A zero divisor is an error, or NULL if asked for."""
    require(df, col_a, col_b)
    if operation not in NUMERIC_OPERATIONS:
        raise ValueError(f"`{operation}` is no arithmetic operation.")
    name = name or f"{col_a}_{NUMERIC_OPERATIONS[operation]}_{col_b}"
    a, b = _wide(df, col_a), _wide(df, col_b)
    if operation == "sum":
        result = a + b
    elif operation == "difference":
        result = a - b
    elif operation == "product":
        result = a * b
    else:
        if on_zero == "error":
            _refuse(df, {col_b: b == 0}, "Division by zero: {} holds zeros.")
        result = F.try_divide(as_number(df, col_a), as_number(df, col_b))
    return _add(df, {name: result})


def apply_math_transform(df: DataFrame, columns: list[str], method: str = "log") -> DataFrame:
    """``<column>_log``, ``_sqrt`` or ``_squared``, the originals kept."""
    if method not in MATH_SUFFIXES:
        raise ValueError(f"Unknown transform `{method}`.")
    names = existing(df, columns)
    suffix = MATH_SUFFIXES[method]
    if method == "log":
        _refuse(df, {c: col(c) <= 0 for c in names}, "No logarithm for {}: zero or negative values.")
        return _add(df, {c + suffix: F.ln(as_number(df, c)) for c in names})
    if method == "sqrt":
        _refuse(df, {c: col(c) < 0 for c in names}, "No square root for {}: negative values.")
        return _add(df, {c + suffix: F.sqrt(as_number(df, c)) for c in names})
    return _add(df, {c + suffix: _wide(df, c) * _wide(df, c) for c in names})


def bin_edges(
    df: DataFrame, column: str, n_bins: int, method: str, distinct_limit: int = DISTINCT_LIMIT
) -> list[float]:
    """n+1 edges of right-closed bins; equal quantile edges are merged."""
    x = as_number(df, column)
    if method == "quantile":
        probs = [i / n_bins for i in range(n_bins + 1)]
        found = column_quantiles(df, [column], probs, distinct_limit)[0][column]
        if found[0] is None:
            raise ValueError(f"`{column}` has no value to bin.")
        return list(dict.fromkeys(found))
    if method != "equal width":
        raise ValueError(f"Unknown binning method `{method}`.")
    lo, hi = df.agg(F.min(x), F.max(x)).first()
    if lo is None:
        raise ValueError(f"`{column}` has no value to bin.")
    if lo == hi:
        slack = 0.001 * abs(lo) if lo != 0 else 0.001
        lo, hi = lo - slack, hi + slack
        return [lo + (hi - lo) * i / n_bins for i in range(n_bins)] + [hi]
    edges = [lo + i * ((hi - lo) / n_bins) for i in range(n_bins)] + [hi]
    edges[0] -= 0.001 * (hi - lo)
    return edges


def _show(x: float, digits: int) -> float:
    """Rounded to so many digits, counted from the first one that is not zero."""
    if x == 0 or not math.isfinite(x):
        return x
    if abs(x) < 1:
        digits += -int(math.floor(math.log10(abs(x)))) - 1
    return round(x, digits)


def interval_labels(edges: list[float]) -> list[str]:
    """Texts like ``(24.979, 35.0]``, with as many digits as it takes to tell edges apart."""
    for digits in range(3, 20):
        shown = [_show(e, digits) for e in edges]
        if len(set(shown)) == len(shown):
            break
    shown[0] -= 10.0**-digits
    shown[0] = round(shown[0], 15)
    return [f"({a}, {b}]" for a, b in zip(shown, shown[1:])]


def bin_numeric(
    df: DataFrame,
    column: str,
    n_bins: int = 4,
    method: str = "equal width",
    labels: list[str] | None = None,
    distinct_limit: int = DISTINCT_LIMIT,
) -> DataFrame:
    """``<column>_binned`` (interval text or label) and ``<column>_bin`` (1-based number)."""
    require(df, column)
    edges = bin_edges(df, column, n_bins, method, distinct_limit)
    bins = max(len(edges) - 1, 1)
    if labels is not None and len(labels) != bins:
        raise ValueError(f"{bins} bins need as many labels.")
    texts = labels or (interval_labels(edges) if len(edges) > 1 else [f"({edges[0]}, {edges[0]}]"])
    x = as_number(df, column)
    number = F.lit(1)
    for edge in edges[1:-1]:
        number = number + (x > F.lit(edge)).cast("int")
    shown = F.get(F.array(*[F.lit(t) for t in texts]), F.col("_bin") - 1)
    numbered = df.withColumn("_bin", F.when(x.isNotNull(), number))
    return _add(numbered, {f"{column}_binned": shown, f"{column}_bin": F.col("_bin")}).drop("_bin")


def parsed_time(df: DataFrame, column: str) -> Column:
    """A date or time column as it is; text parsed, NULL where it is not a date."""
    if isinstance(df.schema[column].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return col(column)
    return col(column).cast("string").try_cast("timestamp_ntz")


def extract_datetime_features(df: DataFrame, column: str, parts: list[str]) -> DataFrame:
    """``<column>_year``, ``_month``, ``_day``, ``_weekday`` (Monday is 0)."""
    require(df, column)
    when = parsed_time(df, column)
    if df.agg(F.count(when)).first()[0] == 0:
        raise ValueError(f"No value of `{column}` reads as a date.")
    makers = {"year": F.year, "month": F.month, "day": F.dayofmonth, "weekday": F.weekday}
    return _add(df, {f"{column}_{p}": makers[p](when) for p in parts})


def extract_text_features(
    df: DataFrame, column: str, parts: list[str], null_text: str | None = None
) -> DataFrame:
    """``<column>_length`` and ``_word_count``. NULL stays NULL unless a text stands for it."""
    require(df, column)
    text = col(column).cast("string")
    if null_text is not None:
        text = F.coalesce(text, F.lit(null_text))
    new = {}
    if "length" in parts:
        new[f"{column}_length"] = F.length(text)
    if "word count" in parts:
        new[f"{column}_word_count"] = F.regexp_count(text, F.lit(r"(?U)\S+"))
    return _add(df, new)


def create_interaction(df: DataFrame, col_a: str, col_b: str) -> DataFrame:
    require(df, col_a, col_b)
    return _add(df, {f"{col_a}_x_{col_b}": _wide(df, col_a) * _wide(df, col_b)})


def create_polynomial_features(df: DataFrame, columns: list[str], degree: int = 2) -> DataFrame:
    """All products of the columns from degree two up, named like ``a_pow2_x_b``."""
    names = existing(df, columns)
    if not names:
        return df
    missing_guard(df, names, "expand")
    new = {}
    for size in range(2, degree + 1):
        for term in combinations_with_replacement(names, size):
            powers = {c: term.count(c) for c in term}
            label = "_x_".join(c if k == 1 else f"{c}_pow{k}" for c, k in powers.items())
            product = as_number(df, term[0])
            for c in term[1:]:
                product = product * as_number(df, c)
            new[label] = product
    return _add(df, new)


def low_variance_columns(df: DataFrame, columns: list[str], threshold: float = 0.0) -> list[str]:
    """Columns whose population variance is not above the threshold, from one scan."""
    names = existing(df, columns)
    if not names:
        return []
    missing_guard(df, names, "measure the variance of")
    aggs = []
    for i, c in enumerate(names):
        x = as_number(df, c)
        # Rounding noise must not make a constant column look as if it varied.
        spread = F.least(F.var_pop(x), F.max(x) - F.min(x)) if threshold == 0 else F.var_pop(x)
        aggs.append(spread.alias(f"v{i}"))
    row = df.agg(*aggs).first()
    low = [c for i, c in enumerate(names) if row[i] is None or row[i] <= threshold]
    if len(low) == len(names):
        raise ValueError("Every column is below the variance threshold.")
    return low


def select_by_variance(df: DataFrame, columns: list[str], threshold: float = 0.0) -> DataFrame:
    return df.drop(*low_variance_columns(df, columns, threshold))


def target_correlations(df: DataFrame, target: str) -> dict[str, float | None]:
    """Correlation of every numeric feature with the target (NULL: undefined), one scan."""
    if target not in df.columns:
        raise ValueError(f"The table has no column `{target}`.")
    dtype = df.schema[target].dataType
    if not is_numeric(dtype) and not isinstance(dtype, T.BooleanType):
        raise ValueError(f"`{target}` holds no numbers to correlate with.")
    features = [c for c in numeric_columns(df) if c != target]
    if not features:
        return {}
    y = as_number(df, target)
    row = df.agg(*[pearson(as_number(df, c), y).alias(f"r{i}") for i, c in enumerate(features)]).first()
    return {c: row[i] for i, c in enumerate(features)}


def weak_columns(df: DataFrame, target: str, threshold: float = 0.2) -> list[str]:
    """Numeric features whose correlation with the target is weak or undefined."""
    return [c for c, r in target_correlations(df, target).items() if r is None or abs(r) < threshold]


def correlation_choice(df: DataFrame, target: str, threshold: float = 0.2) -> DataFrame:
    """``feature, correlation, kept``: what ``select_by_correlation`` decides by."""
    found = target_correlations(df, target)
    rows = [(c, r, r is not None and abs(r) >= threshold) for c, r in found.items()]
    return df.sparkSession.createDataFrame(rows, "feature string, correlation double, kept boolean")


def select_by_correlation(df: DataFrame, target: str, threshold: float = 0.2) -> DataFrame:
    return df.drop(*weak_columns(df, target, threshold))


def operation_effect(before: DataFrame, after: DataFrame) -> DataFrame:
    """``change, column, filled``: added and removed columns and their non-null cells."""
    pieces = []
    for frame, other, change in ((after, before, "added"), (before, after, "removed")):
        names = [c for c in frame.columns if c not in other.columns]
        if not names:
            continue
        wide = frame.agg(*[F.count(col(c)).alias(f"n{i}") for i, c in enumerate(names)])
        cells = [
            F.struct(F.lit(change).alias("change"), F.lit(c).alias("column"), F.col(f"n{i}").alias("filled"))
            for i, c in enumerate(names)
        ]
        pieces.append(wide.select(F.inline(F.array(*cells))))
    if not pieces:
        return before.sparkSession.createDataFrame([], "change string, column string, filled bigint")
    return pieces[0] if len(pieces) == 1 else pieces[0].unionByName(pieces[1])
