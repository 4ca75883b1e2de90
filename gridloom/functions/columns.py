"""Schema questions (no job) and small null-safe column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

FLOATING = (T.FloatType, T.DoubleType)


def is_numeric(dtype: T.DataType) -> bool:
    """Numbers only: booleans are not numeric."""
    return isinstance(dtype, T.NumericType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric(f.dataType)]


def categorical_columns(df: DataFrame) -> list[str]:
    """Everything that is not a number: text, booleans, dates and complex types."""
    return [f.name for f in df.schema.fields if not is_numeric(f.dataType)]


def categorical_feature_columns(df: DataFrame) -> list[str]:
    """Columns a model can encode: text only."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def existing(df: DataFrame, columns: Iterable[str] | None) -> list[str]:
    """The asked-for columns that the table has, unknown names ignored."""
    return [c for c in (columns or []) if c in df.columns]


def require(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Column(s) not found in the table: {', '.join(missing)}")


def col(name: str) -> Column:
    """Reference a column whose name may hold dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def blank_nan(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every floating column, so that one missing value is left."""
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, FLOATING)}
    if not floating:
        return df
    return df.select(
        *[
            F.when(~F.isnan(col(c)), col(c)).alias(c) if c in floating else col(c)
            for c in df.columns
        ]
    )


def as_number(df: DataFrame, name: str) -> Column:
    """A column as double; booleans count as 0/1. Negative zero becomes zero."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.BooleanType):
        return col(name).cast("int").cast("double")
    return col(name).cast("double") + F.lit(0.0)


def pearson(a: Column, b: Column) -> Column:
    """Pearson r over rows that have both values; NULL when either side is constant.

    The deviations only look at paired rows. A spread that is nothing but rounding
    noise of the values themselves counts as constant.
    """
    pa, pb = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    varies = (F.min(pa) < F.max(pa)) & (F.min(pb) < F.max(pb))
    r = F.try_divide(F.covar_pop(pa, pb), F.stddev_pop(pa) * F.stddev_pop(pb))
    return F.when(varies, r)


def rows_of(spec: list[dict[str, Column]]) -> Column:
    """One output row per dict: the long form of a wide one-row aggregate."""
    return F.inline(F.array(*[F.struct(*[c.alias(n) for n, c in row.items()]) for row in spec]))
