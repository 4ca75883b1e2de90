"""Feature engineering."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as fe
from ..plans.chain import OpChain, apply_feature_op, fold_ops
from ._registry import DIRTY, dirty, query, rnd, table

KEYS = "l_orderkey, l_partkey, l_suppkey, l_linenumber"
KEY_LIST = KEYS.split(", ")


def lines(spark, sf, *columns):
    return table(spark, sf, "lineitem").select(*KEY_LIST, *columns)


@query(
    "fe1_arithmetic",
    f"""
    WITH {DIRTY} SELECT {KEYS}, l_discount, l_tax, l_discount + l_tax AS l_discount_plus_l_tax,
        l_discount - l_tax AS l_discount_minus_l_tax, l_partkey * l_linenumber AS l_partkey_times_l_linenumber FROM dirty
    """,
)
def fe1(spark, sf):
    df = dirty(spark, sf).select(*KEY_LIST, "l_discount", "l_tax")
    df = fe.create_numeric_feature(df, "l_discount", "l_tax", "sum")
    df = fe.create_numeric_feature(df, "l_discount", "l_tax", "difference")
    return fe.create_numeric_feature(df, "l_partkey", "l_linenumber", "product")


@query("fe2_ratio", f"SELECT {KEYS}, l_extendedprice, l_quantity, l_extendedprice / l_quantity AS unit_price FROM lineitem")
def fe2(spark, sf):
    df = lines(spark, sf, "l_extendedprice", "l_quantity")
    return fe.create_numeric_feature(df, "l_extendedprice", "l_quantity", "ratio", "unit_price")


@query("fe3_log", f"SELECT {KEYS}, l_extendedprice, round(ln(l_extendedprice), 6) AS l_extendedprice_log FROM lineitem")
def fe3(spark, sf):
    df = fe.apply_math_transform(lines(spark, sf, "l_extendedprice"), ["l_extendedprice"], "log")
    return rnd(df, 6, "l_extendedprice_log")


@query("fe4_sqrt", f"SELECT {KEYS}, l_quantity, sqrt(l_quantity) AS l_quantity_sqrt FROM lineitem")
def fe4(spark, sf):
    return fe.apply_math_transform(lines(spark, sf, "l_quantity"), ["l_quantity"], "sqrt")


@query(
    "fe5_square",
    f"SELECT {KEYS}, l_extendedprice, l_extendedprice * l_extendedprice AS l_extendedprice_squared, (l_linenumber::BIGINT * l_linenumber) AS l_linenumber_squared FROM lineitem",
)
def fe5(spark, sf):
    df = lines(spark, sf, "l_extendedprice")
    return fe.apply_math_transform(df, ["l_extendedprice", "l_linenumber"], "square")


@query(
    "fe6_equal_width_bins",
    f"""
    WITH e AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem),
    b AS (SELECT {KEYS}, l_quantity, (1 + (l_quantity > lo + (hi - lo) / 4)::INTEGER + (l_quantity > lo + 2 * ((hi - lo) / 4))::INTEGER
        + (l_quantity > lo + 3 * ((hi - lo) / 4))::INTEGER)::INTEGER AS l_quantity_bin FROM lineitem, e)
    SELECT *, ['(0.95, 13.25]', '(13.25, 25.5]', '(25.5, 37.75]', '(37.75, 50.0]'][l_quantity_bin] AS l_quantity_binned FROM b
    """,
)
def fe6(spark, sf):
    return fe.bin_numeric(lines(spark, sf, "l_quantity"), "l_quantity", 4, "equal width")


@query(
    "fe7_quantile_bins",
    f"""
    WITH q AS (SELECT quantile_cont(l_extendedprice, 0.2) AS a, quantile_cont(l_extendedprice, 0.4) AS b,
        quantile_cont(l_extendedprice, 0.6) AS c, quantile_cont(l_extendedprice, 0.8) AS d FROM lineitem),
    n AS (SELECT {KEYS}, (1 + (l_extendedprice > a)::INTEGER + (l_extendedprice > b)::INTEGER
        + (l_extendedprice > c)::INTEGER + (l_extendedprice > d)::INTEGER)::INTEGER AS l_extendedprice_bin FROM lineitem, q)
    SELECT *, ['lowest', 'low', 'middle', 'high', 'highest'][l_extendedprice_bin] AS l_extendedprice_binned FROM n
    """,
)
def fe7(spark, sf):
    labels = ["lowest", "low", "middle", "high", "highest"]
    df = fe.bin_numeric(lines(spark, sf, "l_extendedprice"), "l_extendedprice", 5, "quantile", labels)
    return df.drop("l_extendedprice")


@query(
    "fe8_datetime_parts",
    """
    SELECT o_orderkey, year(o_orderdate)::INTEGER AS day_text_year, month(o_orderdate)::INTEGER AS day_text_month,
        day(o_orderdate)::INTEGER AS day_text_day, (isodow(o_orderdate) - 1)::INTEGER AS day_text_weekday
    FROM orders WHERE o_orderkey % 11 <> 0
    UNION ALL SELECT o_orderkey, NULL, NULL, NULL, NULL FROM orders WHERE o_orderkey % 11 = 0
    """,
)
def fe8(spark, sf):
    # Dates as text, some of them unreadable.
    text = F.when(F.col("o_orderkey") % 11 == 0, "no date").otherwise(F.col("o_orderdate").cast("string"))
    df = table(spark, sf, "orders").select("o_orderkey", text.alias("day_text"))
    return fe.extract_datetime_features(df, "day_text", ["year", "month", "day", "weekday"]).drop("day_text")


@query("fe9_text_length", "SELECT doc_id, length(text)::INTEGER AS text_length FROM documents")
def fe9(spark, sf):
    df = table(spark, sf, "documents").select("doc_id", "text")
    return fe.extract_text_features(df, "text", ["length"]).drop("text")


@query(
    "fe10_word_count",
    r"SELECT doc_id, len(regexp_extract_all(text, '[^\s\x0b\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+'))::INTEGER AS text_word_count FROM documents",
)
def fe10(spark, sf):
    df = table(spark, sf, "documents").select("doc_id", "text")
    return fe.extract_text_features(df, "text", ["word count"]).drop("text")


@query("fe11_interaction", f"SELECT {KEYS}, l_quantity, l_tax, l_quantity * l_tax AS l_quantity_x_l_tax FROM lineitem")
def fe11(spark, sf):
    return fe.create_interaction(lines(spark, sf, "l_quantity", "l_tax"), "l_quantity", "l_tax")


@query(
    "fe12_polynomial",
    """
    SELECT p_partkey, a, b, a * a AS a_pow2, a * b AS a_x_b, b * b AS b_pow2, a * a * a AS a_pow3,
        a * a * b AS a_pow2_x_b, a * b * b AS a_x_b_pow2, b * b * b AS b_pow3
    FROM (SELECT p_partkey, p_size::DOUBLE AS a, p_retailprice AS b FROM part)
    """,
)
def fe12(spark, sf):
    df = table(spark, sf, "part").select(
        "p_partkey", F.col("p_size").cast("double").alias("a"), F.col("p_retailprice").alias("b")
    )
    return fe.create_polynomial_features(df, ["a", "b"], 3)


@query("fe13_select_by_variance", f"SELECT {KEYS}, l_quantity FROM lineitem")
def fe13(spark, sf):
    df = lines(spark, sf, "l_quantity", "l_tax").withColumn("l_flat", F.lit(0.1))
    return fe.select_by_variance(df, ["l_quantity", "l_tax", "l_flat"], 0.01)


@query("fe14_select_by_correlation", f"SELECT l_quantity, l_returnflag, l_quantity * 2 + l_tax AS near FROM lineitem")
def fe14(spark, sf):
    df = table(spark, sf, "lineitem").select(
        "l_quantity", "l_returnflag", (F.col("l_quantity") * 2 + F.col("l_tax")).alias("near"), "l_tax",
        F.lit(3).alias("l_flat"),
    )
    return fe.select_by_correlation(df, "l_quantity", 0.8)


@query(
    "fe14_correlations",
    """
    SELECT feature, round(r, 8) AS correlation, coalesce(abs(r) >= 0.8, false) AS kept FROM (
        SELECT 'near' AS feature, corr(l_quantity * 2 + l_tax, l_quantity) AS r FROM lineitem
        UNION ALL SELECT 'l_tax', corr(l_tax, l_quantity) FROM lineitem
        UNION ALL SELECT 'l_flat', NULL)
    """,
)
def fe14_correlations(spark, sf):
    df = table(spark, sf, "lineitem").select(
        "l_quantity", "l_returnflag", (F.col("l_quantity") * 2 + F.col("l_tax")).alias("near"), "l_tax",
        F.lit(3).alias("l_flat"),
    )
    return rnd(fe.correlation_choice(df, "l_quantity", 0.8), 8, "correlation")


OPS = [
    {"key": "numeric", "params": {"col_a": "l_quantity", "col_b": "l_tax", "operation": "sum", "name": "s"}},
    {"key": "math", "params": {"columns": ["l_quantity"], "method": "square"}},
    {"key": "interaction", "params": {"col_a": "s", "col_b": "l_quantity"}},
]
CHAIN_SQL = f"""
    SELECT {KEYS}, l_quantity, l_tax, l_quantity + l_tax AS s, l_quantity * l_quantity AS l_quantity_squared,
        (l_quantity + l_tax) * l_quantity AS s_x_l_quantity FROM lineitem"""


@query("fe15_dispatcher", CHAIN_SQL)
def fe15(spark, sf):
    df = lines(spark, sf, "l_quantity", "l_tax")
    for op in OPS:
        df = apply_feature_op(df, op)
    return df


@query("fe16_replay", CHAIN_SQL)
def fe16(spark, sf):
    # The failing fourth step ends the chain; an undone step is not replayed.
    failing = {"key": "math", "params": {"columns": ["l_tax"], "method": "log"}}
    after = {"key": "interaction", "params": {"col_a": "l_tax", "col_b": "s"}}
    chain = OpChain(tuple([*OPS, failing, after])).add("variance", columns=["l_tax"], threshold=0.0).undo()
    return fold_ops(lines(spark, sf, "l_quantity", "l_tax"), list(chain.ops))


@query(
    "fe17_operation_effect",
    """
    SELECT 'added' AS change, 'l_extendedprice_log' AS "column", count(*) AS filled FROM lineitem
    UNION ALL SELECT 'removed', 'l_tax', count(*) FROM lineitem
    """,
)
def fe17(spark, sf):
    before = lines(spark, sf, "l_extendedprice", "l_tax")
    after = fe.apply_math_transform(before, ["l_extendedprice"], "log")
    return fe.operation_effect(before, fe.select_by_variance(after, ["l_tax", "l_extendedprice"], 0.01))
