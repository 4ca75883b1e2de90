"""Profiling aggregates."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from ..operators import clean, profile
from ._registry import (
    DIRTY, DIRTY_COLUMNS, DIRTY_NUMBERS, DIRTY_TEXTS, dirty, each, query, rnd, table,
)
from .tables import NUMBERS, PAIR_SQL

ALL = [c for c, _ in DIRTY_COLUMNS]
TYPE_OF = dict(DIRTY_COLUMNS)
STATS_SQL = each(
    DIRTY_NUMBERS,
    "SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}::DOUBLE), 4) AS mean, "
    "round(stddev_samp({c}::DOUBLE), 4) AS std, min({c})::DOUBLE AS min, "
    "round(quantile_cont({c}::DOUBLE, 0.25), 6) AS q25, round(quantile_cont({c}::DOUBLE, 0.5), 6) AS q50, "
    "round(quantile_cont({c}::DOUBLE, 0.75), 6) AS q75, max({c})::DOUBLE AS max, "
    "count(*) - count({c}) AS missing FROM dirty",
)
MISSING_SQL = each(
    ALL,
    "SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing_count, "
    "round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 2) AS missing_pct FROM dirty",
)
UNIQUE_SQL = each(ALL, "SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS unique_values FROM dirty")
CONSTANT_SQL = each(ALL, "SELECT '{c}' AS \"column\", count(DISTINCT {c}) <= 1 AS constant FROM dirty")


@query("agg1_numeric_stats", f"WITH {DIRTY} {STATS_SQL}")
def agg1(spark, sf):
    stats = profile.numeric_stats(dirty(spark, sf))
    return rnd(rnd(stats, 4, "mean", "std"), 6, "q25", "q50", "q75")


@query(
    "agg2_categorical_stats",
    f"WITH {DIRTY} "
    + each(
        DIRTY_TEXTS,
        "SELECT '{c}' AS \"column\", CASE WHEN '{c}' = 'l_shipdate' THEN 'timestamp_ntz' ELSE 'string' END AS data_type, count({c}) AS count, "
        "count(DISTINCT {c}) AS \"unique\", "
        "(SELECT {c}::VARCHAR FROM dirty WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS top, "
        "(SELECT count(*) FROM dirty WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY 1 DESC LIMIT 1) AS frequency, "
        "count(*) - count({c}) AS missing FROM dirty",
    ),
)
def agg2(spark, sf):
    return profile.categorical_stats(dirty(spark, sf))


@query("agg3_missing_values", f"WITH {DIRTY} {MISSING_SQL}")
def agg3(spark, sf):
    return profile.missing_values(dirty(spark, sf))


@query(
    "agg4_duplicate_rows",
    """
    WITH twice AS (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_linenumber = 1)
    SELECT (SELECT count(*) FROM twice) - (SELECT count(*) FROM (SELECT DISTINCT * FROM twice)) AS duplicate_rows
    """,
)
def agg4(spark, sf):
    df = table(spark, sf, "lineitem")
    return profile.duplicate_rows(df.unionByName(df.filter("l_linenumber = 1")))


@query("agg5_unique_counts", f"WITH {DIRTY} {UNIQUE_SQL}")
def agg5(spark, sf):
    return profile.unique_counts(dirty(spark, sf))


@query("agg6_constant_columns", f"WITH {DIRTY}, k AS ({CONSTANT_SQL}) SELECT \"column\" FROM k WHERE constant")
def agg6(spark, sf):
    return profile.constant_columns(dirty(spark, sf))


@query(
    "agg7_quality_report",
    f"""
    WITH {DIRTY}, m AS ({MISSING_SQL}), u AS ({UNIQUE_SQL}), k AS ({CONSTANT_SQL}),
    t AS ({' UNION ALL '.join(f"SELECT '{c}' AS \"column\", '{t}' AS data_type" for c, t in DIRTY_COLUMNS)})
    SELECT "column", data_type, missing_count, missing_pct, unique_values, constant
    FROM t JOIN m USING ("column") JOIN u USING ("column") JOIN k USING ("column")
    """,
)
def agg7(spark, sf):
    return profile.quality_report(dirty(spark, sf))


MISSING_CELLS = " + ".join(f"(count(*) - count({c}))" for c in ALL)


@query("agg8_data_quality_score", f"WITH {DIRTY} SELECT round(1 - ({MISSING_CELLS})::DOUBLE / (count(*) * {len(ALL)}), 10) AS score FROM dirty")
def agg8(spark, sf):
    return rnd(profile.data_quality_score(dirty(spark, sf)), 10, "score")


@query("agg9_missing_cells", f"WITH {DIRTY} SELECT {MISSING_CELLS} AS missing_cells FROM dirty")
def agg9(spark, sf):
    return profile.missing_cells(dirty(spark, sf))


@query(
    "agg10_correlation_pairs",
    f"WITH {DIRTY}, pairs AS ({PAIR_SQL}) SELECT column_a, column_b, round(r, 8) AS correlation FROM pairs",
)
def agg10(spark, sf):
    return rnd(profile.correlations(dirty(spark, sf).select(*NUMBERS)), 8, "correlation")


# 24 columns of whole numbers, each with NULLs in other rows: 276 pairs.
_WIDE = [
    (f"w{k}", f"CASE WHEN l_linenumber <> {1 + k % 7} THEN (l_partkey * {k + 1} + l_suppkey) % {20 + k} + l_linenumber END")
    for k in range(24)
]


@query(
    "agg10_wide_correlations",
    "WITH wide AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in _WIDE) + " FROM lineitem), r AS (SELECT "
    + ", ".join(f"corr({a}, {b}) AS {a}_{b}" for a, b in combinations([c for c, _ in _WIDE], 2)) + " FROM wide)\n"
    + "\nUNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, round({a}_{b}, 8) AS correlation FROM r"
        for a, b in combinations([c for c, _ in _WIDE], 2)
    ),
)
def agg10_wide(spark, sf):
    wide = table(spark, sf, "lineitem").select(*[F.expr(e).alias(c) for c, e in _WIDE])
    return rnd(profile.correlations(wide), 8, "correlation")


@query(
    "agg11_top_correlations",
    f"""
    WITH {DIRTY}, pairs AS ({PAIR_SQL})
    SELECT column_a, column_b, round(r, 8) AS correlation FROM pairs WHERE r IS NOT NULL ORDER BY abs(r) DESC LIMIT 3
    """,
)
def agg11(spark, sf):
    # A constant number has no correlation with anything and must not appear.
    df = dirty(spark, sf).select(*NUMBERS, F.lit(1.5).alias("l_flat"))
    return rnd(profile.top_correlations(df, 3), 8, "correlation")


SUMMARY_CELLS = f"""
    (SELECT count(*) FROM dirty) AS rows, {len(ALL)}::INTEGER AS columns,
    (SELECT {MISSING_CELLS} FROM dirty) AS missing_cells,
    (SELECT count(*) FROM dirty) - (SELECT count(*) FROM (SELECT DISTINCT * FROM dirty)) AS duplicate_rows,
    {len(DIRTY_NUMBERS)}::INTEGER AS numeric_columns, {len(DIRTY_TEXTS)}::INTEGER AS categorical_columns"""
TYPES_TEXT = ",".join(f"{c}:{t}" for c, t in DIRTY_COLUMNS)


@query(
    "agg12_eda_summary",
    f"""
    WITH {DIRTY}, s AS (SELECT {SUMMARY_CELLS})
    SELECT *, round(missing_cells * 100.0::DOUBLE / (rows * columns), 2) AS missing_cells_pct,
        'l_constant' AS constant_columns, '' AS high_cardinality_columns, '{TYPES_TEXT}' AS data_types FROM s
    """,
)
def agg12(spark, sf):
    return profile.eda_summary(dirty(spark, sf))


@query(
    "agg12_eda_summary_customer",
    """
    SELECT count(*) AS rows, 5::INTEGER AS columns, 0::BIGINT AS missing_cells, 0::BIGINT AS duplicate_rows,
        3::INTEGER AS numeric_columns, 2::INTEGER AS categorical_columns, 0.0::DOUBLE AS missing_cells_pct,
        '' AS constant_columns, 'c_name' AS high_cardinality_columns,
        'c_custkey:bigint,c_name:string,c_nationkey:int,c_acctbal:double,c_mktsegment:string' AS data_types
    FROM customer
    """,
)
def agg12_customer(spark, sf):
    return profile.eda_summary(table(spark, sf, "customer"))


@query(
    "agg13_compare_before_after",
    f"""
    WITH {DIRTY}, b AS (SELECT {SUMMARY_CELLS}),
    after_ AS (SELECT * FROM dirty WHERE l_discount IS NOT NULL),
    a AS (SELECT (SELECT count(*) FROM after_) AS rows, (SELECT {MISSING_CELLS} FROM after_) AS missing_cells,
        (SELECT count(*) FROM after_) - (SELECT count(*) FROM (SELECT DISTINCT * FROM after_)) AS duplicate_rows)
    SELECT 'Rows' AS metric, b.rows AS before, a.rows AS after FROM a, b
    UNION ALL SELECT 'Columns', {len(ALL)}, {len(ALL)}
    UNION ALL SELECT 'Missing cells', b.missing_cells, a.missing_cells FROM a, b
    UNION ALL SELECT 'Duplicate rows', b.duplicate_rows, a.duplicate_rows FROM a, b
    UNION ALL SELECT 'Numeric columns', {len(DIRTY_NUMBERS)}, {len(DIRTY_NUMBERS)}
    UNION ALL SELECT 'Non-numeric columns', {len(DIRTY_TEXTS)}, {len(DIRTY_TEXTS)}
    """,
)
def agg13(spark, sf):
    before = dirty(spark, sf)
    return profile.compare_before_after(before, clean.handle_missing(before, ["l_discount"], "drop rows"))


@query("agg14_class_counts", 'SELECT event_type AS class, count(*) AS count FROM events GROUP BY 1')
def agg14(spark, sf):
    return profile.class_counts(table(spark, sf, "events"), "event_type")


@query(
    "agg15_columns_with_missing",
    f"WITH {DIRTY}, m AS ({MISSING_SQL}) SELECT \"column\" FROM m WHERE missing_count > 0",
)
def agg15(spark, sf):
    return profile.columns_with_missing(dirty(spark, sf))


@query("agg16_shape_tiles", f"WITH {DIRTY} SELECT {SUMMARY_CELLS}")
def agg16(spark, sf):
    return profile.shape_tiles(dirty(spark, sf))
