"""CSV writers: whole tables and small result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.columns import col


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Header, all rows and columns, one file per task; nothing is gathered into one file."""
    df.write.option("header", True).option("escape", '"').mode(mode).csv(path)
    return path


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Every fractional column rounded for display."""
    fractional = (T.FloatType, T.DoubleType, T.DecimalType)
    return df.select(
        *[
            F.round(col(f.name), digits).alias(f.name)
            if isinstance(f.dataType, fractional)
            else col(f.name)
            for f in df.schema.fields
        ]
    )


def write_result(df: DataFrame, path: str, digits: int | None = 4) -> str:
    """A report, prediction or comparison table, rounded, without an index column."""
    return write_csv(df if digits is None else rounded(df, digits), path)
