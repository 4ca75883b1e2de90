"""Scores of rule-made predictions, and comparison tables made of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import compare, metrics
from ..operators.split import SPLIT
from ..models.training import class_list, encode_labels
from ._registry import query, rnd, table

# Rules that stand in for models: the truth, a prediction and class scores of every line.
RULES = """ruled AS (
    SELECT l_linestatus AS truth, CASE WHEN l_quantity > 25 THEN 'O' ELSE 'F' END AS called,
        l_quantity / 50 AS chance, l_returnflag AS flag,
        CASE WHEN l_quantity < 12 THEN 'A' WHEN l_quantity < 38 THEN 'N' ELSE 'R' END AS flag_called,
        l_quantity / 100 AS chance_a, l_discount + 0.0::DOUBLE AS chance_n, l_extendedprice / 200000 AS chance_r,
        l_extendedprice AS price, l_quantity * 2100 AS price_called,
        CASE WHEN l_shipdate < TIMESTAMP '2000-01-01' THEN 'train' ELSE 'test' END AS split FROM lineitem)"""
FLAGS = ["A", "N", "R"]


def ruled(spark, sf) -> DataFrame:
    q = F.col("l_quantity")
    return table(spark, sf, "lineitem").select(
        F.col("l_linestatus").alias("truth"),
        F.when(q > 25, "O").otherwise("F").alias("called"),
        (q / 50).alias("chance"),
        F.col("l_returnflag").alias("flag"),
        F.when(q < 12, "A").when(q < 38, "N").otherwise("R").alias("flag_called"),
        F.array(q / 100, F.col("l_discount") + F.lit(0.0), F.col("l_extendedprice") / 200000).alias("chances"),
        F.col("l_extendedprice").alias("price"),
        (q * 2100).alias("price_called"),
        F.when(F.col("l_shipdate") < "2000-01-01", "train").otherwise("test").alias(SPLIT),
    )


def confusion_sql(truth: str, called: str, source: str = "ruled") -> str:
    return f"""
    pairs AS (SELECT {truth} AS t, {called} AS c, count(*) AS n FROM {source} GROUP BY ALL),
    labels AS (SELECT t AS label FROM pairs UNION SELECT c FROM pairs),
    per AS (SELECT label, (SELECT coalesce(sum(n), 0) FROM pairs WHERE t = label AND c = label) AS hits,
        (SELECT coalesce(sum(n), 0) FROM pairs WHERE t = label) AS support,
        (SELECT coalesce(sum(n), 0) FROM pairs WHERE c = label) AS called FROM labels),
    scores AS (SELECT label, hits, support, coalesce(hits / nullif(called, 0), 0)::DOUBLE AS p, coalesce(hits / nullif(support, 0), 0)::DOUBLE AS r,
        coalesce(2 * hits / nullif(called + support, 0), 0)::DOUBLE AS f FROM per)"""


@query(
    "evl1_binary_metrics",
    f"""
    WITH {RULES}, {confusion_sql('truth', 'called')}
    SELECT round((SELECT sum(hits) / sum(support) FROM scores), 10)::DOUBLE AS accuracy, round(p, 10) AS precision,
        round(r, 10) AS recall, round(f, 10) AS f1, 'binary' AS average FROM scores WHERE label = 'O'
    """,
)
def evl1(spark, sf):
    df = metrics.classification_metrics(ruled(spark, sf), "truth", "called")
    return rnd(df, 10, "accuracy", "precision", "recall", "f1")


@query(
    "evl1_macro_metrics",
    f"""
    WITH {RULES}, {confusion_sql('flag', 'flag_called')}
    SELECT round(sum(hits) / sum(support), 10)::DOUBLE AS accuracy, round(avg(p), 10) AS precision,
        round(avg(r), 10) AS recall, round(avg(f), 10) AS f1, 'macro' AS average FROM scores
    """,
)
def evl1_macro(spark, sf):
    df = metrics.classification_metrics(ruled(spark, sf), "flag", "flag_called")
    return rnd(df, 10, "accuracy", "precision", "recall", "f1")


@query(
    "evl2_classification_report",
    f"""
    WITH {RULES}, {confusion_sql('flag', 'flag_called')},
    -- 'Z' was trained but never occurs: a row of zeros that counts in the plain average.
    every AS (SELECT label, p, r, f, support FROM scores UNION ALL SELECT 'Z', 0, 0, 0, 0)
    SELECT label AS class, round(p, 10) AS precision, round(r, 10) AS recall, round(f, 10) AS f1, support::BIGINT AS support FROM every
    UNION ALL SELECT 'Macro average', round(avg(p), 10), round(avg(r), 10), round(avg(f), 10), sum(support)::BIGINT FROM every
    UNION ALL SELECT 'Weighted average', round(sum(p * support) / sum(support), 10), round(sum(r * support) / sum(support), 10),
        round(sum(f * support) / sum(support), 10), sum(support)::BIGINT FROM every
    """,
)
def evl2(spark, sf):
    report = metrics.classification_report(ruled(spark, sf), [*FLAGS, "Z"], "flag", "flag_called")
    return rnd(report, 10, "precision", "recall", "f1")


@query(
    "evl3_confusion_matrix",
    f"""
    WITH {RULES} SELECT 'Actual ' || flag AS actual, {', '.join(f"count(*) FILTER (WHERE flag_called = '{x}') AS \"Predicted {x}\"" for x in FLAGS)}
    FROM ruled GROUP BY flag
    """,
)
def evl3(spark, sf):
    return metrics.confusion_matrix(ruled(spark, sf), None, "flag", "flag_called")


def auc_sql(source: str, by: str) -> str:
    """Rank sums over distinct scores; ties count half."""
    return f"""
    groups AS (SELECT {by}, score, count(*) FILTER (WHERE positive) AS pos, count(*) FILTER (WHERE NOT positive) AS neg FROM {source} GROUP BY ALL),
    upto AS (SELECT *, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg, sum(pos) OVER (PARTITION BY {by}) AS all_pos,
        sum(neg) OVER (PARTITION BY {by}) AS all_neg FROM groups WINDOW w AS (PARTITION BY {by} ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
    auc AS (SELECT {by}, sum(neg * (cum_pos - pos + pos / 2)) / (max(all_pos)::DOUBLE * max(all_neg)) AS auc FROM upto GROUP BY ALL)"""


OVR = "ovr AS (" + " UNION ALL ".join(
    f"SELECT '{x}' AS class, chance_{x.lower()} AS score, flag = '{x}' AS positive FROM ruled" for x in FLAGS
) + ")"


@query(
    "evl4_roc_auc_binary",
    f"""
    WITH {RULES}, one AS (SELECT 'O' AS class, chance AS score, truth = 'O' AS positive FROM ruled), {auc_sql('one', 'class')}
    SELECT round(auc, 10) AS auc FROM auc
    """,
)
def evl4(spark, sf):
    df = ruled(spark, sf).withColumn("p", F.array(F.lit(1.0) - F.col("chance"), F.col("chance")))
    return rnd(metrics.roc_auc_brief(df, ["F", "O"], "truth", "p"), 10, "auc")


@query(
    "evl4_roc_auc_macro",
    f"WITH {RULES}, {OVR}, {auc_sql('ovr', 'class')} SELECT round(avg(auc), 10) AS auc FROM auc",
)
def evl4_macro(spark, sf):
    return rnd(metrics.roc_auc_brief(ruled(spark, sf), FLAGS, "flag", "chances"), 10, "auc")


def roc_sql(by: str) -> str:
    return f"""
    SELECT DISTINCT {by}, NULL::DOUBLE AS threshold, 0::DOUBLE AS fpr, 0::DOUBLE AS tpr FROM upto
    UNION ALL SELECT {by}, score, cum_neg::DOUBLE / all_neg, cum_pos::DOUBLE / all_pos FROM upto"""


@query("evl5_roc_curves", f"WITH {RULES}, {OVR}, {auc_sql('ovr', 'class')} {roc_sql('class')}")
def evl5(spark, sf):
    scored = metrics.one_vs_rest(ruled(spark, sf), FLAGS, "flag", "chances")
    return metrics.roc_points(scored)


@query(
    "evl6_regression_metrics",
    f"""
    WITH {RULES} SELECT round(avg(abs(price - price_called)), 4) AS mae, round(avg((price - price_called) * (price - price_called)), 0) AS mse,
        round(sqrt(avg((price - price_called) * (price - price_called))), 4) AS rmse,
        round(1 - avg((price - price_called) * (price - price_called)) / var_pop(price), 8) AS r2 FROM ruled
    """,
)
def evl6(spark, sf):
    df = metrics.regression_metrics(ruled(spark, sf), "price", "price_called")
    return rnd(rnd(rnd(df, 4, "mae", "rmse"), 0, "mse"), 8, "r2")


@query(
    "evl7_prediction_frame",
    f"WITH {RULES} SELECT price AS actual, price_called AS predicted, price - price_called AS residual FROM ruled",
)
def evl7(spark, sf):
    return metrics.prediction_frame(ruled(spark, sf), "price", "price_called")


@query(
    "evl8_residual_statistics",
    f"""
    WITH {RULES}, r AS (SELECT price - price_called AS e FROM ruled)
    SELECT round(avg(e), 4) AS mean, round(stddev_pop(e), 4) AS std, min(e) AS min, max(e) AS max,
        round(quantile_cont(e, 0.5), 4) AS median FROM r
    """,
)
def evl8(spark, sf):
    stats = metrics.residual_statistics(metrics.prediction_frame(ruled(spark, sf), "price", "price_called"))
    return rnd(stats, 4, "mean", "std", "median")


@query(
    "evl9_ideal_line",
    f"WITH {RULES} SELECT least(min(price), min(price_called)) AS low, greatest(max(price), max(price_called)) AS high FROM ruled",
)
def evl9(spark, sf):
    return metrics.ideal_line(ruled(spark, sf), "price", "price_called")


@query(
    "evl11_encode_labels",
    "SELECT o_orderkey, (dense_rank() OVER (ORDER BY o_orderpriority) - 1)::DOUBLE AS label FROM orders",
)
def evl11(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return encode_labels(df, "o_orderpriority", class_list(df, "o_orderpriority")).drop("o_orderpriority")


GENERALISATION = """
    g AS (SELECT avg((truth = called)::INTEGER) FILTER (WHERE split = 'train') AS train_score,
        avg((truth = called)::INTEGER) FILTER (WHERE split = 'test') AS test_score FROM ruled)"""


@query(
    "evl12_overfitting_gap",
    f"""
    WITH {RULES}, f AS (SELECT l_linenumber AS fold, avg((CASE WHEN l_quantity > 25 THEN 'O' ELSE 'F' END = l_linestatus)::INTEGER) AS score FROM lineitem GROUP BY 1),
    s AS (SELECT avg(score) AS mean, stddev_pop(score) AS std, min(score) AS min, max(score) AS max, count(*) AS folds FROM f), {GENERALISATION}
    SELECT round(mean, 10) AS fold_mean, round(std, 10) AS std, round(min, 10) AS min, round(max, 10) AS max, folds,
        round(train_score, 10) AS train_score, round(abs(train_score - mean), 10) AS gap, train_score - mean > 0.15 AS overfits FROM s, g
    """,
)
def evl12(spark, sf):
    df = ruled(spark, sf)
    lines = table(spark, sf, "lineitem")
    hit = F.when(F.col("l_quantity") > 25, "O").otherwise("F") == F.col("l_linestatus")
    folds = lines.groupBy("l_linenumber").agg(F.avg(hit.cast("double")).alias("score"))
    summary = metrics.fold_summary(folds).withColumnRenamed("mean", "fold_mean").withColumn("_one", F.lit(1))
    train = metrics.generalisation(df, "classification", "truth", "called").select("train_score", F.lit(1).alias("_one"))
    result = metrics.overfitting(summary.join(train, "_one").drop("_one"))
    return rnd(result, 10, "fold_mean", "std", "min", "max", "train_score", "gap")


@query(
    "evl13_generalisation",
    f"""
    WITH {RULES}, {GENERALISATION}, p AS (SELECT
        1 - avg((price - price_called) * (price - price_called)) FILTER (WHERE split = 'train') / var_pop(price) FILTER (WHERE split = 'train') AS a,
        1 - avg((price - price_called) * (price - price_called)) FILTER (WHERE split = 'test') / var_pop(price) FILTER (WHERE split = 'test') AS b FROM ruled)
    SELECT 'classification' AS task, round(train_score, 8) AS train_score, round(test_score, 8) AS test_score FROM g
    UNION ALL SELECT 'regression', round(a, 8), round(b, 8) FROM p
    """,
)
def evl13(spark, sf):
    df = ruled(spark, sf)
    a = metrics.generalisation(df, "classification", "truth", "called").withColumn("task", F.lit("classification"))
    b = metrics.generalisation(df, "regression", "price", "price_called").withColumn("task", F.lit("regression"))
    return rnd(a.unionByName(b), 8, "train_score", "test_score")


# Three rules compared on the same lines, as models would be.
CUTS = {"low": 10, "middle": 25, "high": 40}


def rule_table(spark, sf) -> DataFrame:
    """``model, accuracy, precision, recall, f1`` of the rules, from one scan of the lines."""
    lines = table(spark, sf, "lineitem")
    result = None
    for name, cut in CUTS.items():
        called = F.when(F.col("l_quantity") > cut, "O").otherwise("F")
        scored = lines.select(F.col("l_linestatus").alias("actual"), called.alias("predicted"))
        row = metrics.classification_metrics(scored, n_classes=2).drop("average").withColumn("model", F.lit(name))
        result = row if result is None else result.unionByName(row)
    return result.select("model", "accuracy", "precision", "recall", "f1")


RULE_TABLE = "rules AS (" + " UNION ALL ".join(
    f"""SELECT '{name}' AS model, avg((l_linestatus = c)::INTEGER) AS accuracy,
        count(*) FILTER (WHERE l_linestatus = 'O' AND c = 'O') / count(*) FILTER (WHERE c = 'O') AS precision,
        count(*) FILTER (WHERE l_linestatus = 'O' AND c = 'O') / count(*) FILTER (WHERE l_linestatus = 'O') AS recall,
        2 * count(*) FILTER (WHERE l_linestatus = 'O' AND c = 'O') / (count(*) FILTER (WHERE c = 'O') + count(*) FILTER (WHERE l_linestatus = 'O')) AS f1
        FROM (SELECT l_linestatus, CASE WHEN l_quantity > {cut} THEN 'O' ELSE 'F' END AS c FROM lineitem)"""
    for name, cut in CUTS.items()
) + ")"


@query(
    "srt4_ranked_models",
    f"WITH {RULE_TABLE} SELECT model, row_number() OVER (ORDER BY accuracy DESC, f1 DESC, model) AS place, round(accuracy, 10) AS accuracy FROM rules",
)
def srt4(spark, sf):
    return rnd(compare.ranked(rule_table(spark, sf)).select("model", "place", "accuracy"), 10, "accuracy")


@query("cmp4_best_model", f"WITH {RULE_TABLE} SELECT model FROM rules ORDER BY accuracy DESC, f1 DESC, model LIMIT 1")
def cmp4(spark, sf):
    return compare.best_model(rule_table(spark, sf))


@query(
    "cmp5_metrics_long",
    f"""
    WITH {RULE_TABLE} """ + " UNION ALL ".join(
        f"SELECT model, '{m}' AS metric, round({m}, 10) AS value FROM rules" for m in ("accuracy", "precision", "recall", "f1")
    ),
)
def cmp5(spark, sf):
    # The rules give no probabilities, so there is no AUC to show.
    long = compare.metrics_long(rule_table(spark, sf).withColumn("auc", F.lit(None).cast("double")))
    return rnd(long, 10, "value")


@query(
    "cmp6_rounded_table",
    f"WITH {RULE_TABLE} SELECT model, round(accuracy, 4) AS accuracy, round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1, 4) AS f1 FROM rules",
)
def cmp6(spark, sf):
    return compare.rounded_table(rule_table(spark, sf))


TWO_MODELS = """two AS (
    SELECT 'quantity' AS model, 'O' AS class, chance AS score, truth = 'O' AS positive FROM ruled
    UNION ALL SELECT 'discount', 'O', chance_n, truth = 'O' FROM ruled)"""


@query(
    "cmp7_roc_overlay",
    f"WITH {RULES}, {TWO_MODELS}, {auc_sql('two', 'model, class')} {roc_sql('model, class')}",
)
def cmp7(spark, sf):
    df = ruled(spark, sf)
    pieces = [
        df.select(
            F.lit(name).alias("model"), F.lit("O").alias("class"), score.alias("score"),
            (F.col("truth") == "O").alias("positive"),
        )
        for name, score in (("quantity", F.col("chance")), ("discount", F.col("chances")[1]))
    ]
    return compare.roc_overlay(pieces[0].unionByName(pieces[1]))
