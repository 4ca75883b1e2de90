"""First, last and random rows. A table has no order of its own: the keys say which."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.columns import col
from ..functions.sampling import take_rows


def head(df: DataFrame, keys: list[str], n: int = 5) -> DataFrame:
    return df.orderBy(*map(col, keys)).limit(n)


def tail(df: DataFrame, keys: list[str], n: int = 5) -> DataFrame:
    last = df.orderBy(*[col(k).desc() for k in keys]).limit(n)
    return last.orderBy(*map(col, keys))


def random_sample(
    df: DataFrame, n: int = 5, random_state: int = 42, keys: list[str] | None = None
) -> DataFrame:
    """``n`` rows without replacement; the same seed gives the same rows."""
    return take_rows(df, n, keys, random_state)
