"""Named queries over the test tables, each with its SQL twin where SQL can say it."""

from __future__ import annotations

import textwrap
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise KeyError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = textwrap.dedent(sql).strip()
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rnd(df: DataFrame, digits: int, *names: str) -> DataFrame:
    """Round the named columns, so that the last bits of a sum do not matter."""
    return df.select(
        *[F.round(F.col(f"`{c}`"), digits).alias(c) if c in names else F.col(f"`{c}`") for c in df.columns]
    )


def when_null(condition: str, column: str):
    """The column with NULL wherever the condition holds."""
    return F.when(~F.expr(condition), F.col(column)).alias(column)


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with NULLs put in by rule, and one constant column."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        F.when(F.col("l_linenumber") != 3, F.col("l_discount") + F.lit(0.0)).alias("l_discount"),
        F.when(F.col("l_linenumber") != 5, F.col("l_tax") + F.lit(0.0)).alias("l_tax"),
        when_null("l_linenumber = 2", "l_returnflag"),
        "l_linestatus", when_null("l_linenumber = 4", "l_shipdate"),
        F.lit("x").alias("l_constant"),
    )


# The same table in SQL; used as ``WITH {DIRTY} SELECT ... FROM dirty``.
DIRTY = """dirty AS (
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
           CASE WHEN l_linenumber <> 3 THEN l_discount + 0.0::DOUBLE END AS l_discount,
           CASE WHEN l_linenumber <> 5 THEN l_tax + 0.0::DOUBLE END AS l_tax,
           CASE WHEN l_linenumber <> 2 THEN l_returnflag END AS l_returnflag,
           l_linestatus, CASE WHEN l_linenumber <> 4 THEN l_shipdate END AS l_shipdate, 'x' AS l_constant
    FROM lineitem)"""
DIRTY_COLUMNS = [
    ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
    ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
    ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
    ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz"), ("l_constant", "string"),
]
DIRTY_NUMBERS = [c for c, t in DIRTY_COLUMNS if t not in ("string", "timestamp_ntz")]
DIRTY_TEXTS = [c for c, t in DIRTY_COLUMNS if t in ("string", "timestamp_ntz")]


def each(columns, template: str) -> str:
    """UNION ALL of a SELECT per column; ``{c}`` is the column."""
    return "\n    UNION ALL ".join(template.format(c=c) for c in columns)


def hash_sql(key: str, seed: int = 42) -> str:
    return f"('0x' || substr(md5(concat_ws('-', {key}::VARCHAR, '{seed}')), 1, 8))::BIGINT"
