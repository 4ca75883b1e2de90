"""Cleaning, splitting and learned preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean
from ..operators.prepare import fit_features, fit_preparation, input_defaults
from ..operators.split import SPLIT, TRAIN, assign_folds, split_summary, split_train_test
from ..plans.workflow import Workflow
from ._registry import DIRTY, dirty, hash_sql, query, rnd, table

KEYS = "l_orderkey, l_partkey, l_suppkey, l_linenumber"
KEY_LIST = KEYS.split(", ")


@query("cln1_drop_rows", f"WITH {DIRTY} SELECT {KEYS}, l_discount FROM dirty WHERE l_discount IS NOT NULL")
def cln1_rows(spark, sf):
    df = dirty(spark, sf).select(*KEY_LIST, "l_discount")
    return clean.handle_missing(df, ["l_discount", "unknown"], "drop rows")


@query("cln1_drop_columns", f"WITH {DIRTY} SELECT {KEYS}, l_tax FROM dirty")
def cln1_columns(spark, sf):
    df = dirty(spark, sf).select(*KEY_LIST, "l_discount", "l_tax")
    return clean.handle_missing(df, ["l_discount"], "drop columns")


@query(
    "cln1_removed_rows",
    f"""
    WITH {DIRTY} SELECT count(*) FILTER (WHERE l_discount IS NULL) AS removed_rows,
        count(l_discount) AS kept_rows FROM dirty
    """,
)
def cln1_removed(spark, sf):
    df = dirty(spark, sf)
    return clean.removed_rows(df, clean.handle_missing(df, ["l_discount"], "drop rows"))


def fill_sql(discount: str, tax: str) -> str:
    return f"""
    WITH {DIRTY}, s AS (SELECT {discount} AS d, {tax} AS t FROM dirty)
    SELECT {KEYS}, round(coalesce(l_discount, d), 6) AS l_discount, round(coalesce(l_tax, t), 6) AS l_tax FROM dirty, s"""


def filled(spark, sf, strategy):
    df = dirty(spark, sf).select(*KEY_LIST, "l_discount", "l_tax")
    return rnd(clean.handle_missing(df, ["l_discount", "l_tax"], strategy), 6, "l_discount", "l_tax")


@query("cln2_fill_mean", fill_sql("avg(l_discount)", "avg(l_tax)"))
def cln2_mean(spark, sf):
    return filled(spark, sf, "mean")


@query("cln2_fill_median", fill_sql("quantile_cont(l_discount, 0.5)", "quantile_cont(l_tax, 0.5)"))
def cln2_median(spark, sf):
    return filled(spark, sf, "median")


def mode_sql(c: str) -> str:
    return f"(SELECT {c} FROM dirty WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, {c} LIMIT 1)"


@query(
    "cln3_fill_mode",
    f"""
    WITH {DIRTY} SELECT {KEYS}, coalesce(l_returnflag, {mode_sql('l_returnflag')}) AS l_returnflag,
        coalesce(l_discount, {mode_sql('l_discount')}) AS l_discount FROM dirty
    """,
)
def cln3(spark, sf):
    df = dirty(spark, sf).select(*KEY_LIST, "l_returnflag", "l_discount")
    return clean.handle_missing(df, ["l_returnflag", "l_discount"], "mode")


@query("cln4_fill_constant", f"WITH {DIRTY} SELECT {KEYS}, coalesce(l_tax, 0.5::DOUBLE) AS l_tax FROM dirty")
def cln4(spark, sf):
    # The value comes as text, as from a form, and takes the column's own type.
    df = dirty(spark, sf).select(*KEY_LIST, "l_tax")
    return clean.handle_missing(df, ["l_tax"], "constant", "0.5")


OUTLIERS = f"""{DIRTY}, v AS (SELECT *, CASE WHEN l_linenumber = 1 THEN l_extendedprice * l_quantity ELSE l_extendedprice END AS price FROM dirty),
    q AS (SELECT quantile_cont(price, 0.25) AS p1, quantile_cont(price, 0.75) AS p3,
                 quantile_cont(l_discount, 0.25) AS d1, quantile_cont(l_discount, 0.75) AS d3 FROM v),
    m AS (SELECT *, price < p1 - 1.5::DOUBLE * (p3 - p1) OR price > p3 + 1.5::DOUBLE * (p3 - p1) AS price_outlier,
        coalesce(l_discount < d1 - 1.5::DOUBLE * (d3 - d1) OR l_discount > d3 + 1.5::DOUBLE * (d3 - d1), false) AS l_discount_outlier
        FROM v, q)"""


def priced(spark, sf):
    price = F.when(F.col("l_linenumber") == 1, F.col("l_extendedprice") * F.col("l_quantity")).otherwise(
        F.col("l_extendedprice")
    )
    return dirty(spark, sf).select(*KEY_LIST, price.alias("price"), "l_discount")


@query("cln5_outlier_mask", f"WITH {OUTLIERS} SELECT {KEYS}, price, l_discount, price_outlier, l_discount_outlier FROM m")
def cln5(spark, sf):
    return clean.outlier_mask(priced(spark, sf), ["price", "l_discount"])


@query(
    "cln6_outlier_counts",
    f"""
    WITH {OUTLIERS} SELECT 'price' AS "column", count(*) FILTER (WHERE price_outlier) AS outliers FROM m
    UNION ALL SELECT 'l_discount', count(*) FILTER (WHERE l_discount_outlier) FROM m
    """,
)
def cln6(spark, sf):
    return clean.outlier_counts(priced(spark, sf), ["price", "l_discount"])


@query(
    "cln7_remove_outliers",
    f"WITH {OUTLIERS} SELECT {KEYS}, price, l_discount FROM m WHERE NOT (price_outlier OR l_discount_outlier)",
)
def cln7(spark, sf):
    return clean.remove_outliers(priced(spark, sf), ["price", "l_discount"])


@query("cln8_remove_duplicates", f"WITH {DIRTY}, d AS (SELECT * FROM dirty UNION ALL SELECT * FROM dirty) SELECT DISTINCT * FROM d")
def cln8(spark, sf):
    rows = dirty(spark, sf)
    return clean.remove_duplicates(rows.unionByName(rows))


@query(
    "cln9_one_hot",
    f"""
    WITH {DIRTY} SELECT {KEYS}, coalesce((l_returnflag = 'A')::INTEGER, 0) AS "l_returnflag_A",
        coalesce((l_returnflag = 'N')::INTEGER, 0) AS "l_returnflag_N",
        coalesce((l_returnflag = 'R')::INTEGER, 0) AS "l_returnflag_R" FROM dirty
    """,
)
def cln9(spark, sf):
    return clean.encode_categorical(dirty(spark, sf).select(*KEY_LIST, "l_returnflag"), ["l_returnflag"])


@query(
    "cln10_label_encode",
    f"""
    WITH {DIRTY} SELECT {KEYS}, CASE WHEN l_returnflag IS NULL THEN -1 ELSE
        dense_rank() OVER (ORDER BY l_returnflag NULLS LAST) - 1 END::BIGINT AS l_returnflag FROM dirty
    """,
)
def cln10(spark, sf):
    df = dirty(spark, sf).select(*KEY_LIST, "l_returnflag")
    return clean.encode_categorical(df, ["l_returnflag"], "label")


@query(
    "cln10_label_encode_many",
    "SELECT p_partkey, (dense_rank() OVER (ORDER BY p_name) - 1)::BIGINT AS p_name FROM part",
)
def cln10_many(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_name")
    return clean.encode_categorical(df, ["p_name"], "label")


def scale_sql(shift: str, divisor: str) -> str:
    parts = []
    for c in ("l_quantity", "l_extendedprice", "l_flat"):
        d = f"nullif({divisor.format(c=c)}, 0)"
        parts.append(f"round((l.{c} - {shift.format(c=c)}) / coalesce({d}, 1), 6) AS {c}")
    s = ", ".join(
        f"avg({c}) AS {c}_avg, CASE WHEN min({c}) < max({c}) THEN stddev_pop({c}) ELSE 0 END AS {c}_std, min({c}) AS {c}_min, max({c}) AS {c}_max, "
        f"quantile_cont({c}, 0.25) AS {c}_q1, quantile_cont({c}, 0.5) AS {c}_q2, quantile_cont({c}, 0.75) AS {c}_q3"
        for c in ("l_quantity", "l_extendedprice", "l_flat")
    )
    return f"""
    WITH l AS (SELECT *, 7.1::DOUBLE AS l_flat FROM lineitem), s AS (SELECT {s} FROM l)
    SELECT {KEYS}, {', '.join(parts)} FROM l, s"""


def scaled(spark, sf, method):
    names = ["l_quantity", "l_extendedprice", "l_flat"]
    df = table(spark, sf, "lineitem").select(*KEY_LIST, *names[:2], F.lit(7.1).alias("l_flat"))
    result = clean.scale_numeric(df, names, method)
    return rnd(result.select(*KEY_LIST, *[(F.col(c) + F.lit(0.0)).alias(c) for c in names]), 6, *names)


@query("cln11_standard_scaler", scale_sql("{c}_avg", "{c}_std"))
def cln11(spark, sf):
    return scaled(spark, sf, "StandardScaler")


@query("cln12_minmax_scaler", scale_sql("{c}_min", "({c}_max - {c}_min)"))
def cln12(spark, sf):
    return scaled(spark, sf, "MinMaxScaler")


@query("cln13_robust_scaler", scale_sql("{c}_q2", "({c}_q3 - {c}_q1)"))
def cln13(spark, sf):
    return scaled(spark, sf, "RobustScaler")


@query(
    "cln14_missing_guard",
    f"""
    WITH {DIRTY} SELECT 'l_discount' AS "column", count(*) > count(l_discount) AS refused, count(l_discount) AS filled FROM dirty
    UNION ALL SELECT 'l_quantity', count(*) > count(l_quantity), count(l_quantity) FROM dirty
    """,
)
def cln14(spark, sf):
    """Which columns the guard refuses to scale, next to their filled cells."""
    df, result = dirty(spark, sf), None
    for c in ("l_discount", "l_quantity"):
        try:
            clean.missing_guard(df, [c], "scale")
            refused = False
        except ValueError:
            refused = True
        row = df.agg(F.lit(c).alias("column"), F.lit(refused).alias("refused"), F.count(c).alias("filled"))
        result = row if result is None else result.unionByName(row)
    return result


def split_sql(source: str, key: str, seed: int = 42) -> str:
    """``split`` by hash order: the first ceil(20%) rows are the test side."""
    return f"""
    s AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY {hash_sql(key, seed)}, {key}) <= ceil(count(*) OVER () * 0.2::DOUBLE)
        THEN 'test' ELSE 'train' END AS split FROM {source})"""


@query("spl1_train_test_split", f"WITH {split_sql('orders', 'o_orderkey')} SELECT o_orderkey, o_orderstatus, split FROM s")
def spl1(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return split_train_test(df, "o_orderstatus", ["o_orderkey"])


def stratified_sql(source: str, key: str, target: str, seed: int = 42) -> str:
    return f"""
    sizes AS (SELECT {target} AS c, count(*) AS n FROM {source} GROUP BY 1),
    total AS (SELECT sum(n)::BIGINT AS total, ceil(sum(n) * 0.2::DOUBLE)::BIGINT AS test FROM sizes),
    shares AS (SELECT c, n * test // total AS base, n * test % total AS rest, test FROM sizes, total),
    quota AS (SELECT c, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, c) <= test - sum(base) OVER () THEN 1 ELSE 0 END AS q FROM shares),
    s AS (SELECT t.*, CASE WHEN row_number() OVER (PARTITION BY {target} ORDER BY {hash_sql(key, seed)}, {key}) <= q
        THEN 'test' ELSE 'train' END AS split FROM {source} t JOIN quota ON c = {target})"""


@query(
    "spl2_stratified_split",
    f"WITH {stratified_sql('events', 'event_id', 'event_type')} SELECT event_id, event_type, split FROM s",
)
def spl2(spark, sf):
    df = table(spark, sf, "events").select("event_id", "event_type")
    return split_train_test(df, "event_type", ["event_id"], stratify=True)


@query(
    "spl3_split_summary",
    f"""
    WITH {split_sql('orders', 'o_orderkey')}
    SELECT count(*) FILTER (WHERE split = 'train') AS train_rows, count(*) FILTER (WHERE split = 'test') AS test_rows,
        5::INTEGER AS features, count(DISTINCT o_orderstatus) FILTER (WHERE split = 'train') AS train_classes FROM s
    """,
)
def spl3(spark, sf):
    df = table(spark, sf, "orders")
    return split_summary(split_train_test(df, "o_orderstatus", ["o_orderkey"]), "o_orderstatus")


# orders with holes and a priority that only ever occurs on the test side.
HOLED = f"""
    holed AS (SELECT o_orderkey, CASE WHEN o_custkey % 7 <> 0 THEN o_totalprice END AS o_totalprice,
        CASE WHEN o_custkey % 5 <> 0 THEN o_orderpriority END AS o_orderpriority, o_orderstatus FROM orders),
    {split_sql('holed', 'o_orderkey')},
    p AS (SELECT * REPLACE (CASE WHEN split = 'test' AND o_orderpriority = '5-LOW' THEN 'NEW' ELSE o_orderpriority END AS o_orderpriority) FROM s),
    t AS (SELECT * FROM p WHERE split = 'train')"""


def holed(spark, sf):
    df = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_custkey") % 7 != 0, F.col("o_totalprice")).alias("o_totalprice"),
        F.when(F.col("o_custkey") % 5 != 0, F.col("o_orderpriority")).alias("o_orderpriority"),
        "o_orderstatus",
    )
    split = split_train_test(df, "o_orderstatus", ["o_orderkey"])
    fresh = (F.col(SPLIT) != TRAIN) & (F.col("o_orderpriority") == "5-LOW")
    return split.withColumn("o_orderpriority", F.when(fresh, "NEW").otherwise(F.col("o_orderpriority")))


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "pre1_preparation",
    f"""
    WITH {HOLED}, m AS (SELECT quantile_cont(o_totalprice, 0.5) AS med FROM t),
    z AS (SELECT avg(coalesce(o_totalprice, med)) AS a, stddev_pop(coalesce(o_totalprice, med)) AS d FROM t, m),
    codes AS (SELECT o_orderstatus AS v, row_number() OVER (ORDER BY o_orderstatus) - 1 AS code FROM (SELECT DISTINCT o_orderstatus FROM t))
    SELECT o_orderkey, split, round((coalesce(o_totalprice, med) - a) / d, 6) AS o_totalprice,
        coalesce(code, -1)::BIGINT AS o_orderstatus, o_orderpriority
    FROM p CROSS JOIN m CROSS JOIN z LEFT JOIN codes ON v = o_orderstatus
    """,
)
def pre1(spark, sf):
    df = holed(spark, sf)
    fitted = fit_preparation(
        df.filter(F.col(SPLIT) == TRAIN), impute_columns=["o_totalprice"],
        encode_columns=["o_orderstatus"], encode_method="label", scale_columns=["o_totalprice"],
    )
    return rnd(fitted.apply(df), 6, "o_totalprice")


@query(
    "pre2_one_hot_unknown",
    f"WITH {HOLED} SELECT o_orderkey, "
    + ", ".join(f"coalesce((o_orderpriority = '{v}')::INTEGER, 0) AS \"o_orderpriority_{v}\"" for v in PRIORITIES)
    + ", (o_orderpriority IS NULL)::INTEGER AS o_orderpriority_nan FROM p",
)
def pre2(spark, sf):
    df = holed(spark, sf).select("o_orderkey", "o_orderpriority", SPLIT)
    fitted = fit_preparation(df.filter(F.col(SPLIT) == TRAIN), encode_columns=["o_orderpriority"])
    return fitted.apply(df).drop(SPLIT)


@query(
    "pre3_ordinal_unknown",
    f"""
    WITH {HOLED}, codes AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM
        (SELECT DISTINCT o_orderpriority AS v FROM t WHERE o_orderpriority IS NOT NULL))
    SELECT o_orderkey, CASE WHEN o_orderpriority IS NOT NULL THEN coalesce(code, -1) END::BIGINT AS o_orderpriority
    FROM p LEFT JOIN codes ON v = o_orderpriority
    """,
)
def pre3(spark, sf):
    df = holed(spark, sf).select("o_orderkey", "o_orderpriority", SPLIT)
    fitted = fit_preparation(
        df.filter(F.col(SPLIT) == TRAIN), encode_columns=["o_orderpriority"], encode_method="label"
    )
    return fitted.apply(df).drop(SPLIT)


@query(
    "pre3_many_values",
    f"""
    WITH {split_sql('part', 'p_partkey')}, codes AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM
        (SELECT DISTINCT p_name AS v FROM s WHERE split = 'train'))
    SELECT p_partkey, coalesce(code, -1)::BIGINT AS p_name FROM s LEFT JOIN codes ON v = p_name
    """,
)
def pre3_many(spark, sf):
    """More values than one-hot encoding takes: codes are a joined table."""
    split = split_train_test(table(spark, sf, "part").select("p_partkey", "p_name"), "p_name", ["p_partkey"])
    fitted = fit_preparation(split.filter(F.col(SPLIT) == TRAIN), encode_columns=["p_name"], encode_method="label")
    return fitted.apply(split).drop(SPLIT)


FLOW = Workflow(
    missing={"columns": ["l_tax"], "strategy": "median"},
    duplicates=True,
    outliers={"columns": ["l_extendedprice"]},
    encode={"columns": ["l_linestatus"], "method": "one-hot"},
    scale={"columns": ["l_quantity"], "method": "MinMaxScaler"},
)


@query(
    "pre4_workflow",
    f"""
    WITH {DIRTY}, m AS (SELECT quantile_cont(l_tax, 0.5) AS med FROM dirty),
    a AS (SELECT DISTINCT {KEYS}, l_quantity, l_extendedprice, coalesce(l_tax, med) AS l_tax, l_linestatus FROM dirty, m),
    q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3 FROM a),
    b AS (SELECT a.* FROM a, q WHERE NOT (l_extendedprice < q1 - 1.5::DOUBLE * (q3 - q1) OR l_extendedprice > q3 + 1.5::DOUBLE * (q3 - q1))),
    z AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM b)
    SELECT {KEYS}, round((l_quantity - lo) / (hi - lo), 6) AS l_quantity, l_extendedprice, l_tax,
        (l_linestatus = 'F')::INTEGER AS "l_linestatus_F", (l_linestatus = 'O')::INTEGER AS "l_linestatus_O" FROM b, z
    """,
)
def pre4(spark, sf):
    df = dirty(spark, sf).select(*KEY_LIST, "l_quantity", "l_extendedprice", "l_tax", "l_linestatus")
    return rnd(FLOW.run(df), 6, "l_quantity")


@query(
    "pre5_refit_on_train",
    f"""
    WITH holed AS (SELECT o_orderkey, CASE WHEN o_custkey % 7 <> 0 THEN o_totalprice END AS o_totalprice, o_orderstatus FROM orders),
    {split_sql('holed', 'o_orderkey')}, t AS (SELECT * FROM s WHERE split = 'train'),
    m AS (SELECT avg(o_totalprice) AS a FROM t),
    z AS (SELECT min(coalesce(o_totalprice, a)) AS lo, max(coalesce(o_totalprice, a)) AS hi FROM t, m)
    SELECT o_orderkey, split, o_orderstatus, round((coalesce(o_totalprice, a) - lo) / (hi - lo), 6) AS o_totalprice FROM s, m, z
    """,
)
def pre5(spark, sf):
    raw = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_custkey") % 7 != 0, F.col("o_totalprice")).alias("o_totalprice"), "o_orderstatus"
    )
    flow = Workflow(
        missing={"columns": ["o_totalprice"], "strategy": "mean"},
        scale={"columns": ["o_totalprice"], "method": "MinMaxScaler"},
        split={"target": "o_orderstatus", "keys": ["o_orderkey"]},
    )
    split, fitted = flow.fit_on_train(raw)
    return rnd(fitted.apply(split), 6, "o_totalprice")


@query(
    "evl10_folds",
    f"""
    SELECT o_orderkey, (ntile(5) OVER (PARTITION BY o_orderstatus ORDER BY {hash_sql('o_orderkey')}, o_orderkey) - 1)::INTEGER AS fold FROM orders
    """,
)
def folds(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return assign_folds(df, ["o_orderkey"], 5, 42, "o_orderstatus").drop("o_orderstatus")


@query(
    "evl10_folds_plain",
    f"SELECT event_id, (ntile(4) OVER (ORDER BY {hash_sql('event_id', 1)}, event_id) - 1)::INTEGER AS fold FROM events",
)
def folds_plain(spark, sf):
    return assign_folds(table(spark, sf, "events").select("event_id"), ["event_id"], 4, 1)


@query(
    "mod3_feature_table",
    f"""
    WITH {HOLED}, m AS (SELECT quantile_cont(o_totalprice, 0.5) AS med FROM t),
    f AS (SELECT o_orderpriority AS mode FROM t WHERE o_orderpriority IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
    z AS (SELECT avg(coalesce(o_totalprice, med)) AS a, stddev_pop(coalesce(o_totalprice, med)) AS d FROM t, m)
    SELECT o_orderkey, round((coalesce(o_totalprice, med) - a) / d, 6) AS numeric__o_totalprice,
        {', '.join(f"(coalesce(o_orderpriority, mode) = '{v}')::INTEGER AS \"categorical__o_orderpriority_{v}\"" for v in PRIORITIES)}
    FROM p, m, f, z
    """,
)
def mod3(spark, sf):
    df = holed(spark, sf)
    fitted = fit_features(df.filter(F.col(SPLIT) == TRAIN), ["o_totalprice", "o_orderpriority"])
    return rnd(fitted.columns(df, ["o_orderkey"]), 6, "numeric__o_totalprice")


@query(
    "mod24_input_defaults",
    """
    SELECT 'o_totalprice' AS feature, 'numeric' AS kind, round(quantile_cont(o_totalprice, 0.5), 4) AS median, NULL::VARCHAR AS choices FROM orders
    UNION ALL SELECT 'o_orderpriority', 'text', NULL, (SELECT string_agg(v, ',' ORDER BY v) FROM (SELECT DISTINCT o_orderpriority AS v FROM orders))
    """,
)
def mod24(spark, sf):
    return rnd(input_defaults(table(spark, sf, "orders"), ["o_totalprice", "o_orderpriority"]), 4, "median")
