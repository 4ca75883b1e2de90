"""Column and table profiles: statistics, missing cells, distinct values, duplicates."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.columns import (
    as_number, categorical_columns, categorical_feature_columns, col, is_numeric,
    numeric_columns, pearson, rows_of,
)
from ..functions.gram import pair_correlations
from ..functions.quantiles import DISTINCT_LIMIT, column_quantiles

# What the reports call wide and how deep the rankings go.
HIGH_CARDINALITY = 50
TOP_CORRELATIONS = 10
MAX_TARGET_CLASSES = 20
WORST_MISSING = 3
# Correlation expressions in one aggregate.
PAIRS_PER_SCAN = 200

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATING = (T.FloatType, T.DoubleType)


def type_name(dtype: T.DataType) -> str:
    return dtype.simpleString()


def dataframe_info(df: DataFrame) -> DataFrame:
    """One row per column: its type, and the table's row and column counts."""
    spec = [
        {
            "column": F.lit(f.name),
            "data_type": F.lit(type_name(f.dataType)),
            "rows": F.col("n"),
            "columns": F.lit(len(df.columns)),
        }
        for f in df.schema.fields
    ]
    return df.agg(F.count(F.lit(1)).alias("n")).select(rows_of(spec))


def numeric_stats(df: DataFrame, distinct_limit: int = DISTINCT_LIMIT) -> DataFrame:
    """count, mean, std, min, quartiles, max and missing of each numeric column."""
    columns = numeric_columns(df)
    schema = (
        "column string, count bigint, mean double, std double, min double, q25 double, "
        "q50 double, q75 double, max double, missing bigint"
    )
    extra = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(columns):
        x = as_number(df, c)
        extra += [
            F.avg(x).alias(f"mean{i}"), F.stddev_samp(x).alias(f"std{i}"),
            F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}"),
        ]
    quartiles, seen = column_quantiles(df, columns, [0.25, 0.5, 0.75], distinct_limit, extra)
    rows = []
    for i, c in enumerate(columns):
        n = seen[f"_n{i}"]
        rows.append(
            (
                c, n, seen[f"mean{i}"], seen[f"std{i}"], seen[f"min{i}"], *quartiles[c],
                seen[f"max{i}"], seen["rows"] - n,
            )
        )
    return df.sparkSession.createDataFrame(rows, schema)


def _family(dtype: T.DataType) -> tuple[str, str]:
    """Distinct values are counted on fixed-width keys where the type allows."""
    if isinstance(dtype, _WHOLE):
        return "bigint", "whole"
    if isinstance(dtype, _FLOATING):
        return "double", "floating"
    return "string", "text"


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column, value, n``: how often each non-null value occurs, values as text.

    One shuffle per type family whatever the number of columns; equal values are added up
    before the shuffle, and a frequent value is one row after it.
    """
    return _by_family(df, columns, as_text=True)


def _by_family(df: DataFrame, columns: list[str], as_text: bool) -> DataFrame | None:
    groups: dict[str, list[str]] = {}
    for c in columns:
        groups.setdefault(_family(df.schema[c].dataType)[0], []).append(c)
    result = None
    for target, names in groups.items():
        cells = []
        for i, c in enumerate(names):
            x = col(c).cast(target)
            cells.append((x + F.lit(0.0) if target == "double" else x).alias(f"c{i}"))
        ids = [f"c{i}" for i in range(len(names))]
        melted = df.select(*cells).unpivot([], ids, "_id", "value").filter("value is not null")
        counted = melted.groupBy("_id", "value").agg(F.count("*").alias("n"))
        named = F.get(F.array(*[F.lit(c) for c in names]), F.substring("_id", 2, 9).cast("int"))
        value = F.col("value").cast("string") if as_text else F.lit(1)
        piece = counted.select(named.alias("column"), value.alias("value"), "n")
        result = piece if result is None else result.unionByName(piece)
    return result


def unique_counts(df: DataFrame, approximate: bool = False) -> DataFrame:
    """``column, unique_values``: distinct non-null values of every column."""
    names = df.columns
    if approximate:
        wide = df.agg(
            *[F.approx_count_distinct(col(c)).alias(f"u{i}") for i, c in enumerate(names)]
        )
        spec = [
            {"column": F.lit(c), "unique_values": F.col(f"u{i}")} for i, c in enumerate(names)
        ]
        return wide.select(rows_of(spec))
    distinct = _by_family(df, names, as_text=False)
    counted = distinct.groupBy("column").agg(F.count("*").alias("unique_values"))
    return _with_all_columns(df, counted, "unique_values")


def _with_all_columns(df: DataFrame, counted: DataFrame, name: str) -> DataFrame:
    """Columns that hold nothing but NULL have no counted row: give them a zero."""
    zeros = df.sparkSession.createDataFrame([(c, 0) for c in df.columns], f"column string, {name} bigint")
    return counted.unionByName(zeros).groupBy("column").agg(F.sum(name).alias(name))


def categorical_stats(df: DataFrame) -> DataFrame:
    """Count, distinct values, most frequent value (smallest of ties) of non-numeric columns."""
    columns = categorical_columns(df)
    if not columns:
        return df.sparkSession.createDataFrame(
            [],
            "column string, data_type string, count bigint, unique bigint, top string, "
            "frequency bigint, missing bigint",
        )
    per_value = value_counts(df, columns)
    best = F.min_by("value", F.struct((-F.col("n")).alias("n"), "value"))
    per_column = per_value.groupBy("column").agg(
        F.count("*").alias("unique"), best.alias("top"), F.max("n").alias("frequency")
    )
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.count(col(c)).alias(f"n{i}") for i, c in enumerate(columns)]
    spec = [
        {
            "column": F.lit(c),
            "data_type": F.lit(type_name(df.schema[c].dataType)),
            "count": F.col(f"n{i}"),
            "missing": F.col("rows") - F.col(f"n{i}"),
        }
        for i, c in enumerate(columns)
    ]
    base = df.agg(*aggs).select(rows_of(spec))
    return base.join(per_column, "column", "left").select(
        "column", "data_type", "count", F.coalesce("unique", F.lit(0)).alias("unique"),
        "top", F.coalesce("frequency", F.lit(0)).alias("frequency"), "missing",
    )


def _null_counts(df: DataFrame) -> list[Column]:
    aggs = [F.count(F.lit(1)).alias("rows")]
    return aggs + [F.count(F.when(col(c).isNull(), 1)).alias(f"m{i}") for i, c in enumerate(df.columns)]


def _percent(part: Column, whole: Column) -> Column:
    return F.round(F.coalesce(F.try_divide(part * F.lit(100.0), whole), F.lit(0.0)), 2)


def missing_values(df: DataFrame) -> DataFrame:
    """``column, missing_count, missing_pct`` in one scan."""
    spec = [
        {
            "column": F.lit(c),
            "missing_count": F.col(f"m{i}"),
            "missing_pct": _percent(F.col(f"m{i}"), F.col("rows")),
        }
        for i, c in enumerate(df.columns)
    ]
    return df.agg(*_null_counts(df)).select(rows_of(spec))


def columns_with_missing(df: DataFrame) -> DataFrame:
    return missing_values(df).filter("missing_count > 0").select("column")


def worst_missing(df: DataFrame, k: int = WORST_MISSING) -> DataFrame:
    return (
        missing_values(df)
        .filter("missing_count > 0")
        .select("column", "missing_count")
        .orderBy(F.desc("missing_count"), "column")
        .limit(k)
    )


def _missing_total(df: DataFrame) -> Column:
    return sum((F.col(f"m{i}") for i in range(len(df.columns))), F.lit(0).cast("bigint"))


def missing_cells(df: DataFrame) -> DataFrame:
    return df.agg(*_null_counts(df)).select(_missing_total(df).alias("missing_cells"))


def data_quality_score(df: DataFrame) -> DataFrame:
    """Share of cells that are not NULL, 0.0 for an empty table."""
    cells = F.col("rows") * F.lit(len(df.columns))
    filled = F.lit(1.0) - F.try_divide(_missing_total(df).cast("double"), cells.cast("double"))
    return df.agg(*_null_counts(df)).select(F.coalesce(filled, F.lit(0.0)).alias("score"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat another one (NULLs equal): one shuffle, copies added up before it."""
    counted = df.groupBy(*map(col, df.columns)).agg(F.count("*").alias("_n"))
    return counted.agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows")
    )


def _constant(df: DataFrame, c: str) -> Column:
    x = col(c)
    if not _orderable(df.schema[c].dataType):
        x = F.to_json(F.struct(x))
    return F.min(x).eqNullSafe(F.max(x))


def _orderable(dtype: T.DataType) -> bool:
    return not isinstance(dtype, (T.MapType, T.VariantType))


def constant_flags(df: DataFrame) -> DataFrame:
    """``column, constant``: at most one distinct value; min = max says so in one scan."""
    wide = df.agg(*[_constant(df, c).alias(f"k{i}") for i, c in enumerate(df.columns)])
    spec = [
        {"column": F.lit(c), "constant": F.col(f"k{i}")} for i, c in enumerate(df.columns)
    ]
    return wide.select(rows_of(spec))


def constant_columns(df: DataFrame) -> DataFrame:
    return constant_flags(df).filter("constant").select("column")


def quality_report(df: DataFrame) -> DataFrame:
    """Type, missing cells, distinct values and the constant flag of every column."""
    spec = [
        {
            "column": F.lit(f.name),
            "data_type": F.lit(type_name(f.dataType)),
            "missing_count": F.col(f"m{i}"),
            "missing_pct": _percent(F.col(f"m{i}"), F.col("rows")),
        }
        for i, f in enumerate(df.schema.fields)
    ]
    missing = df.agg(*_null_counts(df)).select(rows_of(spec))
    return missing.join(unique_counts(df), "column").select(
        "column", "data_type", "missing_count", "missing_pct", "unique_values",
        (F.col("unique_values") <= 1).alias("constant"),
    )


def correlations(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``column_a, column_b, correlation`` for every pair of numeric columns.

    One scan. Above ``PAIRS_PER_SCAN`` pairs it adds up masked products of blocks of columns; the
    few pairs that sums cannot tell from constants are computed from the rows.
    """
    columns = columns or numeric_columns(df)
    if len(columns) < 2:
        raise ValueError("Correlations take two numeric columns or more.")
    pairs = list(combinations(columns, 2))
    if len(pairs) <= PAIRS_PER_SCAN:
        return _pair_by_pair(df, pairs)
    known, doubtful = pair_correlations(df.select(*[as_number(df, c).alias(f"c{i}") for i, c in enumerate(columns)]))
    names = F.array(*map(F.lit, columns))
    result = known.select(
        F.get(names, F.col("a")).alias("column_a"), F.get(names, F.col("b")).alias("column_b"), "correlation"
    )
    for start in range(0, len(doubtful), PAIRS_PER_SCAN):
        chunk = [(columns[a], columns[b]) for a, b in doubtful[start : start + PAIRS_PER_SCAN]]
        result = result.unionByName(_pair_by_pair(df, chunk))
    return result


def _pair_by_pair(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    wide = df.agg(*[pearson(as_number(df, a), as_number(df, b)).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    spec = [
        {"column_a": F.lit(a), "column_b": F.lit(b), "correlation": F.col(f"r{i}")} for i, (a, b) in enumerate(pairs)
    ]
    return wide.select(rows_of(spec))


def correlation_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Both triangles and the diagonal, in long form. The diagonal is NULL for constants."""
    columns = columns or numeric_columns(df)
    if len(columns) < 2:
        raise ValueError("Correlations take two numeric columns or more.")
    upper = correlations(df, columns)
    both = F.array(
        F.struct("column_a", "column_b", "correlation"),
        F.struct(F.col("column_b").alias("column_a"), F.col("column_a").alias("column_b"), "correlation"),
    )
    varies = [
        F.when(F.min(as_number(df, c)) < F.max(as_number(df, c)), F.lit(1.0)).alias(f"d{i}")
        for i, c in enumerate(columns)
    ]
    diagonal = [
        {"column_a": F.lit(c), "column_b": F.lit(c), "correlation": F.col(f"d{i}")}
        for i, c in enumerate(columns)
    ]
    return upper.select(F.inline(both)).unionByName(df.agg(*varies).select(rows_of(diagonal)))


def top_correlations(df: DataFrame, k: int = TOP_CORRELATIONS) -> DataFrame:
    """The strongest pairs by absolute Pearson r; undefined pairs are left out."""
    if len(numeric_columns(df)) < 2:
        return df.sparkSession.createDataFrame(
            [], "column_a string, column_b string, correlation double"
        )
    return (
        correlations(df)
        .filter("correlation is not null")
        .orderBy(F.abs("correlation").desc(), "column_a", "column_b")
        .limit(k)
    )


def eda_summary(df: DataFrame) -> DataFrame:
    """One row: sizes, missing cells, duplicates, kinds of columns, and the notable ones."""
    text = categorical_feature_columns(df)
    wide = df.agg(
        *_null_counts(df),
        *[_constant(df, c).alias(f"k{i}") for i, c in enumerate(df.columns)],
    )
    cells = F.col("rows") * F.lit(len(df.columns))
    constants = F.filter(
        F.array(*[F.when(F.col(f"k{i}"), F.lit(c)) for i, c in enumerate(df.columns)]),
        lambda c: c.isNotNull(),
    )
    base = wide.select(
        "rows",
        F.lit(len(df.columns)).alias("columns"),
        _missing_total(df).alias("missing_cells"),
        _percent(_missing_total(df), cells).alias("missing_cells_pct"),
        F.lit(len(numeric_columns(df))).alias("numeric_columns"),
        F.lit(len(categorical_columns(df))).alias("categorical_columns"),
        F.array_join(constants, ",").alias("constant_columns"),
        F.lit(1).alias("_one"),
    )
    result = base.join(duplicate_rows(df).withColumn("_one", F.lit(1)), "_one")
    if text:
        wide_text = unique_counts(df.select(*map(col, text)))
        high = wide_text.groupBy().agg(
            F.sort_array(
                F.collect_list(
                    F.when(F.col("unique_values") > HIGH_CARDINALITY, F.col("column"))
                )
            ).alias("h")
        ).select(F.array_join("h", ",").alias("high_cardinality_columns"), F.lit(1).alias("_one"))
        result = result.join(high, "_one")
    else:
        result = result.withColumn("high_cardinality_columns", F.lit(""))
    types = ",".join(f"{f.name}:{type_name(f.dataType)}" for f in df.schema.fields)
    return result.withColumn("data_types", F.lit(types)).drop("_one")


def shape_tiles(df: DataFrame) -> DataFrame:
    return eda_summary(df).select(
        "rows", "columns", "missing_cells", "duplicate_rows", "numeric_columns",
        "categorical_columns",
    )


def _six_metrics(df: DataFrame, name: str) -> DataFrame:
    wide = df.agg(*_null_counts(df)).select("*", F.lit(1).alias("_one"))
    wide = wide.join(duplicate_rows(df).withColumn("_one", F.lit(1)), "_one")
    n_numeric = len(numeric_columns(df))
    values = [
        ("Rows", F.col("rows")),
        ("Columns", F.lit(len(df.columns))),
        ("Missing cells", _missing_total(df)),
        ("Duplicate rows", F.col("duplicate_rows")),
        ("Numeric columns", F.lit(n_numeric)),
        ("Non-numeric columns", F.lit(len(df.columns) - n_numeric)),
    ]
    return wide.select(
        rows_of([{"metric": F.lit(m), name: v.cast("bigint")} for m, v in values])
    )


def compare_before_after(before: DataFrame, after: DataFrame) -> DataFrame:
    """Six table metrics side by side."""
    return _six_metrics(before, "before").join(_six_metrics(after, "after"), "metric")


def class_counts(df: DataFrame, target: str) -> DataFrame:
    """``class, count`` of a target, most frequent first."""
    return (
        df.filter(col(target).isNotNull())
        .groupBy(col(target).alias("class"))
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "class")
    )


def text_cardinalities(df: DataFrame) -> dict[str, int]:
    """Exact distinct counts of the text columns, one shuffle for all of them."""
    text = categorical_feature_columns(df)
    if not text:
        return {}
    return {r[0]: r[1] for r in unique_counts(df.select(*map(col, text))).collect()}


def default_features(df: DataFrame, target: str, limit: int = HIGH_CARDINALITY) -> list[str]:
    """All numeric columns and the text columns with few values, without the target."""
    unique = text_cardinalities(df)
    numbers = [c for c in numeric_columns(df) if c != target]
    return numbers + [
        c for c in categorical_feature_columns(df) if c != target and unique[c] <= limit
    ]


def default_target(df: DataFrame, task: str = "classification") -> str | None:
    """First text column with 2-20 classes, or first numeric column that varies."""
    if task == "classification":
        unique = text_cardinalities(df)
        fitting = [
            c for c in categorical_feature_columns(df) if 2 <= unique[c] <= MAX_TARGET_CLASSES
        ]
    else:
        numbers = numeric_columns(df)
        spread = [
            (F.min(as_number(df, c)) < F.max(as_number(df, c))).alias(f"s{i}")
            for i, c in enumerate(numbers)
        ]
        seen = df.agg(*spread).first() if numbers else ()
        fitting = [c for c, varies in zip(numbers, seen) if varies]
    return (fitting or df.columns or [None])[0]
