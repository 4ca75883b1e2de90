"""Exploratory chart data and facts."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from ..operators import eda, profile
from ._registry import DIRTY, dirty, query, rnd, table
from .profiling import MISSING_SQL
from .tables import NUMBERS, PAIR_SQL


def histogram_sql(source: str, column: str, bins: str) -> str:
    """Equal-width histogram with its empty bins; ``bins`` may be an expression."""
    return f"""
    e AS (SELECT min({column})::DOUBLE AS lo, max({column})::DOUBLE AS hi, {bins} AS bins FROM {source}),
    w AS (SELECT lo, hi, bins, (hi - lo) / bins AS w FROM e),
    c AS (SELECT least(floor(({column} - lo) / w), bins - 1)::INTEGER AS bin, count(*) AS n
          FROM {source}, w WHERE {column} IS NOT NULL GROUP BY 1),
    g AS (SELECT unnest(range(0, bins))::INTEGER AS bin FROM e)
    SELECT g.bin, round(lo + g.bin * w, 6) AS lo, round(lo + (g.bin + 1) * w, 6) AS hi, coalesce(n, 0) AS count
    FROM g CROSS JOIN w LEFT JOIN c ON c.bin = g.bin"""


@query("eda1_histogram", f"WITH {histogram_sql('lineitem', 'l_extendedprice', '30')}")
def eda1(spark, sf):
    return rnd(eda.histogram(table(spark, sf, "lineitem"), "l_extendedprice"), 6, "lo", "hi")


@query(
    "eda1_residual_histogram",
    f"""
    WITH r AS (SELECT l_extendedprice - l_quantity * 2000 AS residual FROM lineitem),
    {histogram_sql('r', 'residual', 'least(30, greatest(10, count(residual) // 4))')}
    """,
)
def eda1_residual(spark, sf):
    df = table(spark, sf, "lineitem").select(
        (F.col("l_extendedprice") - F.col("l_quantity") * 2000).alias("residual")
    )
    return rnd(eda.residual_histogram(df), 6, "lo", "hi")


def box_sql(group: str | None) -> str:
    by = f"{group}, " if group else ""
    end = f"GROUP BY {group}" if group else ""
    on = f"JOIN q USING ({group})" if group else "CROSS JOIN q"
    where = f"AND {group} IS NOT NULL" if group else ""
    return f"""
    q AS (SELECT {by} quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS q2,
          quantile_cont(l_extendedprice, 0.75) AS q3 FROM narrow GROUP BY ALL),
    f AS (SELECT *, q1 - 1.5::DOUBLE * (q3 - q1) AS low, q3 + 1.5::DOUBLE * (q3 - q1) AS high FROM q),
    j AS (SELECT * FROM narrow {on.replace(' q', ' f')} WHERE l_extendedprice IS NOT NULL {where})
    SELECT {by} count(*) AS count, min(l_extendedprice) AS min, round(max(q1), 4) AS q1,
        round(max(q2), 4) AS median, round(max(q3), 4) AS q3, max(l_extendedprice) AS max,
        min(l_extendedprice) FILTER (WHERE l_extendedprice BETWEEN low AND high) AS whisker_low,
        max(l_extendedprice) FILTER (WHERE l_extendedprice BETWEEN low AND high) AS whisker_high,
        count(*) FILTER (WHERE l_extendedprice < low OR l_extendedprice > high) AS outliers
    FROM j {end}"""


# Large values made rare, so that the whiskers leave something outside.
NARROW = f"""{DIRTY}, narrow AS (
    SELECT l_returnflag, l_linenumber, CASE WHEN l_linenumber = 1 THEN l_extendedprice * l_quantity
           WHEN l_linenumber = 6 THEN NULL ELSE l_extendedprice END AS l_extendedprice FROM dirty)"""


def narrow(spark, sf):
    price = F.when(F.col("l_linenumber") == 1, F.col("l_extendedprice") * F.col("l_quantity")).when(
        F.col("l_linenumber") != 6, F.col("l_extendedprice")
    )
    return dirty(spark, sf).select("l_returnflag", "l_linenumber", price.alias("l_extendedprice"))


@query("eda2_box_plot", f"WITH {NARROW}, {box_sql(None)}")
def eda2(spark, sf):
    return rnd(eda.box_plot(narrow(spark, sf), "l_extendedprice"), 4, "q1", "median", "q3")


@query("eda2_box_plot_by_group", f"WITH {NARROW}, {box_sql('l_returnflag')}")
def eda2_group(spark, sf):
    return rnd(eda.box_plot(narrow(spark, sf), "l_extendedprice", "l_returnflag"), 4, "q1", "median", "q3")


@query(
    "eda3_density",
    """
    WITH s AS (SELECT count(o_totalprice) AS n, min(o_totalprice) AS lo, max(o_totalprice) AS hi,
               stddev_samp(o_totalprice) * pow(count(o_totalprice), -0.2::DOUBLE) AS h FROM orders),
    g AS (SELECT i::INTEGER AS point, lo + i * ((hi - lo) / 299) AS x FROM s, range(0, 300) r(i)),
    v AS (SELECT o_totalprice AS v, count(*) AS k FROM orders GROUP BY 1)
    SELECT point, round(x, 4) AS x,
        round(sum(k * exp(-0.5::DOUBLE * ((x - v) / h) * ((x - v) / h))) / (n * h * sqrt(2 * pi())), 14) AS density
    FROM g, v, s GROUP BY point, x, n, h
    """,
)
def eda3(spark, sf):
    return rnd(rnd(eda.density(table(spark, sf, "orders"), "o_totalprice"), 4, "x"), 14, "density")


@query(
    "eda4_scatter",
    f"WITH {DIRTY} SELECT l_discount, l_tax, l_returnflag FROM dirty WHERE l_discount IS NOT NULL AND l_tax IS NOT NULL",
)
def eda4(spark, sf):
    return eda.scatter(dirty(spark, sf), "l_discount", "l_tax", "l_returnflag")


@query(
    "eda5_correlation_heatmap",
    f"""
    WITH {DIRTY}, pairs AS ({PAIR_SQL})
    SELECT column_a, column_b, round(r, 8) AS correlation FROM pairs
    UNION ALL SELECT column_b, column_a, round(r, 8) FROM pairs
    UNION ALL {' UNION ALL '.join(f"SELECT '{c}', '{c}', 1.0::DOUBLE" for c in NUMBERS)}
    """,
)
def eda5(spark, sf):
    return rnd(profile.correlation_matrix(dirty(spark, sf).select(*NUMBERS)), 8, "correlation")


SQL_AGGREGATES = {
    "mean": "avg(l_discount)", "sum": "coalesce(sum(l_discount), 0)", "min": "min(l_discount)",
    "median": "quantile_cont(l_discount, 0.5)", "max": "max(l_discount)",
    "count": "count(l_discount)::DOUBLE",
}


@query(
    "eda6_grouped_bar",
    f"WITH {DIRTY}, u AS ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS aggregation, l_returnflag AS \"group\", round({sql}, 6) AS value "
        "FROM dirty WHERE l_returnflag IS NOT NULL GROUP BY 2"
        for name, sql in SQL_AGGREGATES.items()
    )
    + ") SELECT * FROM u WHERE value IS NOT NULL",
)
def eda6(spark, sf):
    df, result = dirty(spark, sf), None
    for name in eda.AGGREGATIONS:
        one = eda.grouped_bar(df, "l_returnflag", "l_discount", name).withColumn("aggregation", F.lit(name))
        result = one if result is None else result.unionByName(one)
    return rnd(result, 6, "value")


FREQUENCY = """freq AS (SELECT l_returnflag AS category, count(*) AS count,
    count(*) * 100.0::DOUBLE / (SELECT count(*) FROM dirty) AS percent FROM dirty GROUP BY 1)"""


@query(
    "eda7_frequency_distribution",
    f"WITH {DIRTY}, {FREQUENCY} SELECT category, count, round(percent, 8) AS percent FROM freq",
)
def eda7(spark, sf):
    return rnd(eda.frequency_distribution(dirty(spark, sf), "l_returnflag"), 8, "percent")


@query("eda8_count_plot", f"WITH {DIRTY}, {FREQUENCY} SELECT category, count FROM freq WHERE category IS NOT NULL")
def eda8(spark, sf):
    return eda.count_plot(dirty(spark, sf), "l_returnflag")


@query(
    "eda9_missing_bar",
    f"WITH {DIRTY}, m AS ({MISSING_SQL}) SELECT \"column\", missing_count FROM m WHERE missing_count > 0",
)
def eda9(spark, sf):
    return eda.missing_bar(dirty(spark, sf))


@query(
    "eda10_pairwise_points",
    f"WITH {DIRTY} "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS x_column, '{b}' AS y_column, {a}::DOUBLE AS x, {b}::DOUBLE AS y FROM dirty "
        f"WHERE {a} IS NOT NULL AND {b} IS NOT NULL"
        for a, b in combinations([*NUMBERS, "l_linenumber"], 2)
    ),
)
def eda10(spark, sf):
    return eda.pairwise_points(dirty(spark, sf), [*NUMBERS, "l_linenumber"])


@query(
    "eda10_pairwise_histograms",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", * FROM (WITH {DIRTY}, {histogram_sql('dirty', c, '10')})"
        for c in NUMBERS
    ),
)
def eda10_diagonal(spark, sf):
    return rnd(eda.pairwise_histograms(dirty(spark, sf), NUMBERS, 10), 6, "lo", "hi")


def skew_sql(column: str, source: str = "dirty") -> str:
    return f"""
    s AS (SELECT avg({column}) AS mean, quantile_cont({column}, 0.5) AS median, stddev_samp({column}) AS std,
          count(*) - count({column}) AS missing FROM {source})
    SELECT round(mean, 4) AS mean, round(median, 4) AS median, round(std, 4) AS std, round(2 * std, 4) AS spread, missing,
        CASE WHEN std = 0 THEN 'constant' WHEN abs(mean - median) / std < 0.1 THEN 'symmetric'
             WHEN mean > median THEN 'right-skewed' ELSE 'left-skewed' END AS shape FROM s"""


@query("eda11_skew_facts", f"WITH {NARROW}, {skew_sql('l_extendedprice', 'narrow')}")
def eda11(spark, sf):
    return rnd(eda.skew_facts(narrow(spark, sf), "l_extendedprice"), 4, "mean", "median", "std", "spread")


@query(
    "eda12_box_facts",
    f"""
    WITH {NARROW}, m AS (SELECT l_returnflag AS g, quantile_cont(l_extendedprice, 0.5) AS v FROM narrow
        WHERE l_returnflag IS NOT NULL GROUP BY 1),
    q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS median,
        quantile_cont(l_extendedprice, 0.75) AS q3 FROM narrow),
    o AS (SELECT count(*) AS outliers FROM narrow, q WHERE l_extendedprice < q1 - 1.5::DOUBLE * (q3 - q1)
        OR l_extendedprice > q3 + 1.5::DOUBLE * (q3 - q1))
    SELECT round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3, q1 = q3 AS iqr_is_zero, outliers,
        (SELECT max_by(g, v) FROM m) AS highest_group, round((SELECT max(v) FROM m), 4) AS highest_value,
        (SELECT min_by(g, v) FROM m) AS lowest_group, round((SELECT min(v) FROM m), 4) AS lowest_value FROM q, o
    """,
)
def eda12(spark, sf):
    facts = eda.box_facts(narrow(spark, sf), "l_extendedprice", "l_returnflag")
    return rnd(facts, 4, "q1", "median", "q3", "highest_value", "lowest_value")


@query(
    "eda13_relationship_facts",
    f"""
    WITH {DIRTY}, r AS (SELECT count(*) FILTER (WHERE l_discount IS NOT NULL AND l_tax IS NOT NULL) AS paired_rows,
        count(*) FILTER (WHERE l_discount IS NULL OR l_tax IS NULL) AS excluded_rows, corr(l_discount, l_tax) AS r FROM dirty)
    SELECT paired_rows, excluded_rows, round(r, 8) AS correlation,
        CASE WHEN r > 0 THEN 'positive' ELSE 'negative' END AS direction,
        CASE WHEN abs(r) < 0.3 THEN 'weak' WHEN abs(r) < 0.7 THEN 'moderate' ELSE 'strong' END AS strength FROM r
    """,
)
def eda13(spark, sf):
    return rnd(eda.relationship_facts(dirty(spark, sf), "l_discount", "l_tax"), 8, "correlation")


@query(
    "eda14_aggregate_facts",
    """
    WITH g AS (SELECT event_type AS g, sum(value) AS v FROM events GROUP BY 1)
    SELECT max_by(g, v) AS highest_group, round(max(v), 4) AS highest_value,
        min_by(g, v) AS lowest_group, round(min(v), 4) AS lowest_value FROM g
    """,
)
def eda14(spark, sf):
    facts = eda.bar_facts(table(spark, sf, "events"), "event_type", "value", "sum")
    return rnd(facts, 4, "highest_value", "lowest_value")


@query(
    "eda15_category_facts",
    f"""
    WITH {DIRTY}, {FREQUENCY}
    SELECT count(category) AS distinct_values,
        (SELECT category FROM freq ORDER BY count DESC, category NULLS LAST LIMIT 1) AS top,
        round(max(percent), 8) AS top_percent,
        coalesce(sum(count) FILTER (WHERE category IS NULL), 0)::BIGINT AS missing FROM freq
    """,
)
def eda15(spark, sf):
    return rnd(eda.category_facts(dirty(spark, sf), "l_returnflag"), 8, "top_percent")


@query(
    "eda16_missing_facts",
    f"""
    WITH {DIRTY}, m AS ({MISSING_SQL})
    SELECT sum(missing_count)::BIGINT AS missing_cells,
        (SELECT string_agg("column", ',' ORDER BY missing_count DESC, "column") FROM
            (SELECT * FROM m WHERE missing_count > 0 ORDER BY missing_count DESC, "column" LIMIT 3)) AS worst_columns FROM m
    """,
)
def eda16(spark, sf):
    return eda.missing_facts(dirty(spark, sf))


