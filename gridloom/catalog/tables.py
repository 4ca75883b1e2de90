"""Sources, sinks, schema operators, filters, previews."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import (
    categorical_columns, categorical_feature_columns, existing, numeric_columns,
)
from ..functions.storage import scratch_path
from ..operators import clean, eda, preview, profile
from ..sources.readers import load_table, validate_table
from ..sources.writers import write_csv, write_result
from ._registry import DIRTY, dirty, each, hash_sql, query, table

ORDER_TEXT = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority"


@query("src1_csv_scan", f"SELECT {ORDER_TEXT}, o_orderdate::VARCHAR AS o_orderdate FROM orders")
def src1(spark, sf):
    orders = table(spark, sf, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("string"))
    path = write_csv(orders, scratch_path(spark, "orders") + ".csv")
    return load_table(spark, path)


@query(
    "src1_wide_ids",
    """
    SELECT o_orderkey + 1234567890123450000 AS id, (o_orderkey::HUGEINT + 12345678901234567890123450000)::DECIMAL(38, 0) AS wide FROM orders
    """,
)
def src1_wide(spark, sf):
    """Whole numbers of 19 and 29 digits come back exactly."""
    key = F.col("o_orderkey").cast("decimal(38,0)")
    ids = table(spark, sf, "orders").select(
        (key + F.lit("1234567890123450000").cast("decimal(38,0)")).cast("string").alias("id"),
        (key + F.lit("12345678901234567890123450000").cast("decimal(38,0)")).cast("string").alias("wide"),
    )
    return load_table(spark, write_csv(ids, scratch_path(spark, "ids") + ".csv"))


@query(
    "src1_quoted_text",
    """
    SELECT p_partkey, p_size || '" ' || p_type AS inches, p_name || chr(10) || p_brand || ', "new"' AS two_lines FROM part
    """,
)
def src1_quoted(spark, sf):
    """Bare quotes inside a cell, and quoted cells with line breaks, commas and quotes."""
    part = table(spark, sf, "part").select(
        "p_partkey", F.concat(F.col("p_size").cast("string"), F.lit('" '), "p_type").alias("inches"),
        F.concat(F.lit('"'), "p_name", F.lit("\n"), "p_brand", F.lit(', ""new"""')).alias("two_lines"),
    )
    path = scratch_path(spark, "part-quoted") + ".csv"
    header = F.lit("p_partkey,inches,two_lines")
    # Lines as other programs write them; every file starts with the header.
    lines = part.select(F.concat_ws(",", "p_partkey", "inches", "two_lines").alias("line"))
    numbered = lines.withColumn("n", F.pmod(F.xxhash64("line"), F.lit(4)))
    heads = numbered.groupBy("n").agg(F.first("line").alias("line")).select(header.alias("line"), "n", F.lit(0).alias("place"))
    ordered = numbered.withColumn("place", F.lit(1)).select("line", "n", "place").unionByName(heads)
    ordered.repartition(4, "n").sortWithinPartitions("n", "place").select("line", "n").write.partitionBy("n").text(path)
    return load_table(spark, path).drop("n")


@query(
    "src2_load_dispatch",
    """
    SELECT 'csv' AS format, c_custkey, c_name, c_acctbal FROM customer
    UNION ALL SELECT 'parquet', c_custkey, c_name, c_acctbal FROM customer
    """,
)
def src2(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    path = write_csv(customer, scratch_path(spark, "customer") + ".csv")
    from_csv = load_table(spark, path).withColumn("format", F.lit("csv"))
    from_parquet = load_table(spark, f"{sf}/customer.parquet").withColumn("format", F.lit("parquet"))
    return from_csv.unionByName(from_parquet.select(from_csv.columns))


@query("src3_validated_table", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def src3(spark, sf):
    return validate_table(table(spark, sf, "supplier"), "supplier")


@query("src4_table_by_name", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def src4(spark, sf):
    return load_table(spark, "customer.parquet", base_dir=sf)


@query("src5_parquet_scan", "SELECT l_orderkey, l_partkey, l_quantity, l_extendedprice, l_returnflag FROM lineitem")
def src5(spark, sf):
    return load_table(spark, f"{sf}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag"
    )


@query("snk1_csv_sink", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def snk1(spark, sf):
    part = table(spark, sf, "part")
    path = write_csv(part, scratch_path(spark, "part") + ".csv")
    return load_table(spark, path, schema=part.schema)


@query(
    "snk2_result_sink",
    'SELECT l_returnflag AS "group", round(avg(l_extendedprice), 4) AS value FROM lineitem GROUP BY 1',
)
def snk2(spark, sf):
    report = eda.grouped_bar(table(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice", "mean")
    path = write_result(report, scratch_path(spark, "report") + ".csv", 4)
    return load_table(spark, path)


@query(
    "prj1_numeric_columns",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
       l_discount + 0.0::DOUBLE AS l_discount, l_tax FROM lineitem""",
)
def prj1(spark, sf):
    df = table(spark, sf, "lineitem")
    df = df.withColumn("l_discount", F.col("l_discount") + F.lit(0.0))
    return df.select(*numeric_columns(df))


@query(
    "prj2_categorical_columns",
    "SELECT o_orderstatus, o_orderdate::VARCHAR AS o_orderdate, o_orderpriority FROM orders",
)
def prj2(spark, sf):
    df = table(spark, sf, "orders")
    return df.select(*[F.col(c).cast("string").alias(c) for c in categorical_columns(df)])


@query("prj3_text_feature_columns", "SELECT o_orderstatus, o_orderpriority FROM orders")
def prj3(spark, sf):
    df = table(spark, sf, "orders")
    return df.select(*categorical_feature_columns(df))


ORDER_TYPES = [
    ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
    ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string"),
]


@query(
    "prj4_dataframe_info",
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS data_type, count(*) AS rows, 6::INTEGER AS columns FROM orders"
        for c, t in ORDER_TYPES
    ),
)
def prj4(spark, sf):
    return profile.dataframe_info(table(spark, sf, "orders"))


@query("prj5_feature_target_projection", "SELECT l_quantity, l_extendedprice, l_returnflag FROM lineitem")
def prj5(spark, sf):
    return table(spark, sf, "lineitem").select(*["l_quantity", "l_extendedprice"], "l_returnflag")


@query("prj6_drop_columns", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def prj6(spark, sf):
    return clean.handle_missing(
        table(spark, sf, "orders"), ["o_orderstatus", "o_orderdate"], "drop columns"
    )


@query("prj7_ignore_unknown_columns", "SELECT o_orderkey, o_totalprice FROM orders")
def prj7(spark, sf):
    df = table(spark, sf, "orders")
    return df.select(*existing(df, ["o_orderkey", "no_such_column", "o_totalprice"]))


@query("prj8_default_features", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def prj8(spark, sf):
    df = table(spark, sf, "customer")
    return df.select(*profile.default_features(df, "c_acctbal"))


@query(
    "prj9_default_target",
    """
    SELECT 'classification' AS task, c_mktsegment AS value, count(*) AS n FROM customer GROUP BY 2
    UNION ALL SELECT 'regression', c_custkey::VARCHAR, count(*) FROM customer GROUP BY 2
    """,
)
def prj9(spark, sf):
    df = table(spark, sf, "customer")
    pieces = []
    for task in ("classification", "regression"):
        target = profile.default_target(df, task)
        counted = profile.class_counts(df, target)
        pieces.append(
            counted.select(F.lit(task).alias("task"), F.col("class").cast("string").alias("value"), F.col("count").alias("n"))
        )
    return pieces[0].unionByName(pieces[1])


DIRTY_KEYS = "l_orderkey, l_partkey, l_suppkey, l_linenumber"


@query(
    "flt1_drop_null_rows",
    f"WITH {DIRTY} SELECT {DIRTY_KEYS}, l_discount, l_returnflag FROM dirty WHERE l_discount IS NOT NULL AND l_returnflag IS NOT NULL",
)
def flt1(spark, sf):
    kept = clean.drop_missing_rows(dirty(spark, sf), ["l_discount", "l_returnflag"])
    return kept.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_discount", "l_returnflag")


@query(
    "flt2_drop_null_target",
    f"WITH {DIRTY} SELECT {DIRTY_KEYS}, l_returnflag FROM dirty WHERE l_returnflag IS NOT NULL",
)
def flt2(spark, sf):
    kept = clean.drop_missing_target(dirty(spark, sf), "l_returnflag")
    return kept.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")


@query(
    "flt3_paired_rows",
    f"""
    WITH {DIRTY}
    SELECT count(*) FILTER (WHERE l_discount IS NOT NULL AND l_tax IS NOT NULL) AS paired_rows,
           count(*) FILTER (WHERE l_discount IS NULL OR l_tax IS NULL) AS excluded_rows FROM dirty
    """,
)
def flt3(spark, sf):
    return eda.excluded_rows(dirty(spark, sf), "l_discount", "l_tax")


@query(
    "flt4_outlier_range",
    f"""
    WITH {DIRTY}, q AS (SELECT quantile_cont(l_discount, 0.25) AS a, quantile_cont(l_discount, 0.75) AS b FROM dirty)
    SELECT {DIRTY_KEYS}, coalesce(l_discount < a - 0.25::DOUBLE * (b - a) OR l_discount > b + 0.25::DOUBLE * (b - a), false) AS outside
    FROM dirty, q
    """,
)
def flt4(spark, sf):
    df = dirty(spark, sf)
    limits = clean.outlier_limits(df, ["l_discount"], 0.25)["l_discount"]
    return df.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        clean.outside(df, "l_discount", limits).alias("outside"),
    )


@query("lim1_head", f"SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def lim1(spark, sf):
    return preview.head(table(spark, sf, "orders"), ["o_orderkey"])


@query("lim2_tail", f"SELECT * FROM orders ORDER BY o_orderkey DESC LIMIT 5")
def lim2(spark, sf):
    return preview.tail(table(spark, sf, "orders"), ["o_orderkey"])


@query(
    "lim3_random_sample",
    f"SELECT * FROM orders ORDER BY {hash_sql('o_orderkey')}, o_orderkey LIMIT 100",
)
def lim3(spark, sf):
    return preview.random_sample(table(spark, sf, "orders"), 100, 42, ["o_orderkey"])


@query(
    "lim3_large_sample",
    f"""
    SELECT * FROM orders
    QUALIFY row_number() OVER (ORDER BY {hash_sql('o_orderkey', 7)}, o_orderkey) <= 10001
    """,
)
def lim3_large(spark, sf):
    return preview.random_sample(table(spark, sf, "orders"), 10_001, 7, ["o_orderkey"])


@query(
    "lim3_shared_key",
    f"""
    SELECT * FROM orders
    ORDER BY {hash_sql('o_custkey')}, o_custkey,
        {hash_sql("concat_ws('-', o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority)")},
        o_orderkey LIMIT 100
    """,
)
def lim3_shared(spark, sf):
    """Rows that share a key are told apart by the rest of the row, in any layout."""
    return preview.random_sample(table(spark, sf, "orders").repartition(7), 100, 42, ["o_custkey"])


PAIRS = [
    ("l_quantity", "l_extendedprice"), ("l_quantity", "l_discount"), ("l_quantity", "l_tax"),
    ("l_extendedprice", "l_discount"), ("l_extendedprice", "l_tax"), ("l_discount", "l_tax"),
]
PAIR_SQL = "\n    UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, corr({a}, {b}) AS r FROM dirty" for a, b in PAIRS
)
NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "srt1_top_by_correlation",
    f"""
    WITH {DIRTY}, pairs AS ({PAIR_SQL})
    SELECT column_a, column_b, round(r, 8) AS correlation FROM pairs ORDER BY abs(r) DESC LIMIT 5
    """,
)
def srt1(spark, sf):
    top = profile.top_correlations(dirty(spark, sf).select(*NUMBERS), 5)
    return top.withColumn("correlation", F.round("correlation", 8))


@query(
    "srt2_worst_missing",
    f"""
    WITH {DIRTY}, m AS ({each(["l_discount", "l_tax", "l_returnflag", "l_quantity"], "SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing_count FROM dirty")})
    SELECT * FROM m WHERE missing_count > 0 ORDER BY missing_count DESC, "column" LIMIT 3
    """,
)
def srt2(spark, sf):
    return profile.worst_missing(dirty(spark, sf))


@query(
    "srt3_extreme_groups",
    """
    WITH g AS (SELECT o_orderpriority AS g, avg(o_totalprice) AS v FROM orders GROUP BY 1)
    SELECT max_by(g, v) AS highest_group, round(max(v), 4) AS highest_value,
           min_by(g, v) AS lowest_group, round(min(v), 4) AS lowest_value FROM g
    """,
)
def srt3(spark, sf):
    facts = eda.bar_facts(table(spark, sf, "orders"), "o_orderpriority", "o_totalprice", "mean")
    return facts.withColumn("highest_value", F.round("highest_value", 4)).withColumn(
        "lowest_value", F.round("lowest_value", 4)
    )
