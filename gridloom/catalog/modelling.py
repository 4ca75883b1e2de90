"""Training, prediction, nearest neighbours, cross-validation and model comparison."""

from __future__ import annotations

from pyspark.ml.classification import NaiveBayes
from pyspark.sql import DataFrame, functions as F

from ..models import neighbors, training
from ..operators import compare, metrics
from ..operators.prepare import fit_features
from ..operators.split import SPLIT, TRAIN, split_train_test
from ._registry import hash_sql, query, rnd, table
from .cleaning import split_sql, stratified_sql

ORDER_FEATURES = ["o_totalprice", "o_custkey", "o_orderpriority"]


def orders(spark, sf) -> DataFrame:
    return table(spark, sf, "orders")


def sized(spark, sf) -> DataFrame:
    """Parts with targets whose best models SQL can state.

    ``kind`` follows the size with noise, ``side`` leaves a wide gap (NULL in between), and
    ``cost`` is a number that follows the size with noise.
    """
    size, noise = F.col("p_size"), F.pmod("p_partkey", F.lit(20))
    return table(spark, sf, "part").select(
        "p_partkey", "p_size",
        F.when(size + noise < 25, "a").when(size + noise < 45, "b").otherwise("c").alias("kind"),
        F.when(size + noise < 35, "small").otherwise("large").alias("half"),
        F.when(size <= 20, "low").when(size >= 31, "high").alias("side"),
        F.when(size <= 20, 10.0).when(size >= 31, 50.0).alias("level"),
        (size * size + F.pmod("p_partkey", F.lit(100))).cast("double").alias("cost"),
    )


SIZED = """sized AS (SELECT p_partkey, p_size, CASE WHEN p_size + p_partkey % 20 < 25 THEN 'a' WHEN p_size + p_partkey % 20 < 45 THEN 'b' ELSE 'c' END AS kind,
        CASE WHEN p_size + p_partkey % 20 < 35 THEN 'small' ELSE 'large' END AS half,
        CASE WHEN p_size <= 20 THEN 'low' WHEN p_size >= 31 THEN 'high' END AS side, CASE WHEN p_size <= 20 THEN 10::DOUBLE WHEN p_size >= 31 THEN 50::DOUBLE END AS level,
        (p_size * p_size + p_partkey % 100)::DOUBLE AS cost FROM part)"""


def on_size(spark, sf, target, model, params=None, **kw):
    """A model of one feature, the size of a part."""
    train = training.train_regressor if target in ("cost", "level") else training.train_classifier
    return train(sized(spark, sf), ["p_size"], target, model, params, ["p_partkey"], **kw)


def stump_sql(target: str, impurity: str, split: str = "s") -> str:
    """The best single cut of ``p_size`` over the training rows, as ``cut``."""
    if impurity == "variance":
        sides = """n_l * (ss_l / n_l - (s_l / n_l) * (s_l / n_l)) + n_r * (ss_r / n_r - (s_r / n_r) * (s_r / n_r))"""
        values = f"""v AS (SELECT p_size AS x, count(*)::DOUBLE AS n, sum({target}) AS s, sum({target} * {target}) AS ss FROM t GROUP BY 1),
        w AS (SELECT x, sum(n) OVER o AS n_l, sum(s) OVER o AS s_l, sum(ss) OVER o AS ss_l, sum(n) OVER () - sum(n) OVER o AS n_r,
            sum(s) OVER () - sum(s) OVER o AS s_r, sum(ss) OVER () - sum(ss) OVER o AS ss_r FROM v WINDOW o AS (ORDER BY x)),
        best AS (SELECT x AS cut FROM w WHERE n_r > 0 ORDER BY round({sides}, 6), x LIMIT 1)"""
    else:
        part = "k / n * k / n" if impurity == "gini" else "-k / n * log2(k / n)"
        total = "1 - sum({p})" if impurity == "gini" else "sum({p})"
        values = f"""xs AS (SELECT DISTINCT p_size AS x FROM t WHERE p_size < (SELECT max(p_size) FROM t)),
        k AS (SELECT x, p_size <= x AS lower, {target} AS c, count(*)::DOUBLE AS k FROM xs, t GROUP BY ALL),
        h AS (SELECT x, lower, any_value(n) AS n, {total.format(p=part)} AS h FROM (SELECT *, sum(k) OVER (PARTITION BY x, lower) AS n FROM k) GROUP BY ALL),
        best AS (SELECT x AS cut FROM h GROUP BY x ORDER BY round(sum(n * h), 6), x LIMIT 1)"""
    return f"t AS (SELECT * FROM {split} WHERE split = 'train'), {values}"


def stump_classes_sql(target: str, impurity: str, classes: str) -> str:
    """Shares of the classes on the row's side of the cut, for every part."""
    shares = ", ".join(f"round(avg(({target} = '{c}')::INTEGER), 6) AS p_{c}" for c in classes.split())
    names = ", ".join(f"p_{c}" for c in classes.split())
    return f"""
    WITH {SIZED}, {split_sql('sized', 'p_partkey')}, {stump_sql(target, impurity)},
    sides AS (SELECT p_size <= cut AS lower, mode({target}) AS prediction, {shares} FROM t, best GROUP BY 1)
    SELECT p_partkey, prediction, {names} FROM sized, best JOIN sides ON lower = (p_size <= cut)"""


def shares_of(trained, df, classes: str) -> DataFrame:
    scored = trained.predict(df, ["p_partkey"])
    return scored.select(
        "p_partkey", "prediction",
        *[F.round(F.col("probability")[i], 6).alias(f"p_{c}") for i, c in enumerate(classes.split())],
    )


# One standardised feature: the fitted line has a closed form. All orders are used.
LINE = f"""{split_sql('orders', 'o_orderkey')}, t AS (SELECT * FROM s WHERE split = 'train'),
    z AS (SELECT avg(o_custkey) AS a, stddev_pop(o_custkey) AS d FROM t),
    x AS (SELECT (o_custkey - a) / d AS x, o_totalprice AS y FROM t, z),
    m AS (SELECT count(*) AS n, avg(x) AS mx, avg(y) AS my, covar_pop(x, y) AS sxy, var_pop(x) AS sxx FROM x)"""


BAYES_COLUMNS = ["o_totalprice", "o_custkey"]


def bayes_sql(train: str = "split = 'train'", rows: str = "s", by: str = "") -> str:
    """Gaussian naive Bayes of the order status: ``q`` has ``o_orderkey, c, ll, p`` per class.

    ``by`` names a column per value of which (as ``k.<by>``) a model of its own is fitted.
    """
    source = f"(SELECT k.{by} AS fit, r.* FROM {rows} r, k)" if by else f"(SELECT 0 AS fit, * FROM {rows})"
    return f"""
    r AS {source},
    z AS (SELECT fit, avg(o_totalprice) AS a1, stddev_pop(o_totalprice) AS d1, avg(o_custkey) AS a2, stddev_pop(o_custkey) AS d2, count(*) AS n FROM r WHERE {train} GROUP BY 1),
    x AS (SELECT r.*, n, (o_totalprice - a1) / d1 AS x1, (o_custkey - a2) / d2 AS x2 FROM r JOIN z USING (fit)),
    c AS (SELECT fit, o_orderstatus AS c, ln(count(*)::DOUBLE / any_value(n)) AS prior, avg(x1) AS m1, var_pop(x1) + 1e-9::DOUBLE AS v1, avg(x2) AS m2, var_pop(x2) + 1e-9::DOUBLE AS v2
        FROM x WHERE {train} GROUP BY ALL),
    l AS (SELECT x.*, c.c, prior - 0.5::DOUBLE * ln(2 * pi() * v1) - (x1 - m1) * (x1 - m1) / (2 * v1)
        - 0.5::DOUBLE * ln(2 * pi() * v2) - (x2 - m2) * (x2 - m2) / (2 * v2) AS ll FROM x JOIN c USING (fit)),
    e AS (SELECT *, exp(ll - max(ll) OVER (PARTITION BY fit, o_orderkey)) AS e FROM l),
    q AS (SELECT *, e / sum(e) OVER (PARTITION BY fit, o_orderkey) AS p FROM e),
    answer AS (SELECT fit, o_orderkey, any_value(o_orderstatus) AS actual, max_by(c, ll) AS predicted FROM q GROUP BY ALL)"""


def report_sql(answers: str) -> str:
    """Scores per class of ``actual, predicted``."""
    return f"""
    pairs AS (SELECT * FROM {answers}),
    labels AS (SELECT actual AS label FROM pairs UNION SELECT predicted FROM pairs),
    counted AS (SELECT label, (SELECT count(*) FROM pairs WHERE actual = label AND predicted = label) AS hits,
        (SELECT count(*) FROM pairs WHERE actual = label) AS support, (SELECT count(*) FROM pairs WHERE predicted = label) AS called FROM labels),
    scored AS (SELECT *, coalesce(hits / nullif(called, 0)::DOUBLE, 0) AS precision, coalesce(hits / nullif(support, 0)::DOUBLE, 0) AS recall,
        coalesce(2 * hits / nullif(called + support, 0)::DOUBLE, 0) AS f1 FROM counted)"""


@query(
    "mod1_classification_target",
    """
    SELECT o_orderstatus AS class, count(*) AS count, (SELECT count(DISTINCT o_orderstatus) FROM orders) AS n_classes,
        0::BIGINT AS missing, 'string' AS data_type FROM orders GROUP BY 1
    """,
)
def mod1(spark, sf):
    return training.validate_classification_target(orders(spark, sf), "o_orderstatus")


@query(
    "mod2_regression_target",
    """
    SELECT count(o_totalprice) AS n_values, count(*) - count(o_totalprice) AS missing, count(DISTINCT o_totalprice) AS n_unique,
        min(o_totalprice) AS min, max(o_totalprice) AS max, round(avg(o_totalprice), 4) AS mean, 'double' AS data_type FROM orders
    """,
)
def mod2(spark, sf):
    return rnd(training.validate_regression_target(orders(spark, sf), "o_totalprice"), 4, "mean")


def bayes(spark, sf, model="Naive Bayes", **kw):
    return training.train_classifier(
        orders(spark, sf), BAYES_COLUMNS, "o_orderstatus", model, None, ["o_orderkey"], **kw
    )


def scores(trained) -> DataFrame:
    """The metrics row next to the train and test score."""
    one = F.lit(1)
    return trained.metrics.withColumn("_one", one).join(trained.scores.withColumn("_one", one), "_one").drop("_one")


@query(
    "mod4_feature_names",
    f"""
    WITH {split_sql('orders', 'o_orderkey')}, v AS (SELECT DISTINCT o_orderpriority AS v FROM s WHERE split = 'train')
    SELECT 0::INTEGER AS position, 'numeric__o_totalprice' AS feature
    UNION ALL SELECT 1, 'numeric__o_custkey'
    UNION ALL SELECT (row_number() OVER (ORDER BY v) + 1)::INTEGER, 'categorical__o_orderpriority_' || v FROM v
    """,
)
def mod4(spark, sf):
    df = orders(spark, sf)
    split = split_train_test(df, "o_orderstatus", ["o_orderkey"])
    fitted = fit_features(split.filter(F.col(SPLIT) == TRAIN), ORDER_FEATURES)
    return spark.createDataFrame(list(enumerate(fitted.names)), "position int, feature string")


@query("mod5_feature_importance", f"WITH {LINE} SELECT 'numeric__o_custkey' AS feature, round(abs(sxy / sxx), 3) AS importance FROM m")
def mod5(spark, sf):
    trained = training.train_regressor(
        orders(spark, sf), ["o_custkey"], "o_totalprice", "Linear Regression", None, ["o_orderkey"]
    )
    return rnd(training.feature_importance(trained.model, trained.features.names, spark), 3, "importance")


@query(
    "mod6_train_classifier",
    f"""
    WITH {stratified_sql('orders', 'o_orderkey', 'o_orderstatus')}, {bayes_sql()},
    {report_sql("(SELECT actual, predicted FROM answer JOIN s USING (o_orderkey) WHERE split = 'test')")},
    lines AS (SELECT label AS class, precision, recall, f1, support FROM scored
        UNION ALL SELECT 'Macro average', avg(precision), avg(recall), avg(f1), sum(support) FROM scored
        UNION ALL SELECT 'Weighted average', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) FROM scored)
    SELECT class, round(precision, 8) AS precision, round(recall, 8) AS recall, round(f1, 8) AS f1, support::BIGINT AS support FROM lines
    """,
)
def mod6(spark, sf):
    return rnd(bayes(spark, sf, stratify=True).report, 8, "precision", "recall", "f1")


@query(
    "mod7_train_regressor",
    f"""
    WITH {LINE}, p AS (SELECT o_orderkey, o_totalprice AS y, my + sxy / sxx * ((o_custkey - a) / d - mx) AS p FROM s, z, m WHERE split = 'test')
    SELECT o_orderkey, y AS actual, round(p, 3) AS predicted, round(y - p, 3) AS residual FROM p
    """,
)
def mod7(spark, sf):
    trained = training.train_regressor(
        orders(spark, sf), ["o_custkey"], "o_totalprice", "Linear Regression", None, ["o_orderkey"]
    )
    return rnd(trained.predictions, 3, "predicted", "residual")


@query(
    "mod8_class_probabilities",
    f"WITH {split_sql('orders', 'o_orderkey')}, {bayes_sql()} SELECT o_orderkey, c AS class, round(p, 6) AS probability FROM q",
)
def mod8(spark, sf):
    trained = bayes(spark, sf)
    scored = trained.predict(orders(spark, sf), ["o_orderkey"])
    return rnd(training.class_probabilities(scored, ["o_orderkey"], trained.classes), 6, "probability")


@query(
    "mod9_model_registry",
    f"""
    WITH {split_sql('orders', 'o_orderkey')}, {bayes_sql()}, sided AS (SELECT actual, predicted, split FROM answer JOIN s USING (o_orderkey)),
    {report_sql("(SELECT actual, predicted FROM sided WHERE split = 'test')")},
    line AS (SELECT round(avg(precision), 8) AS precision, round(avg(recall), 8) AS recall, round(avg(f1), 8) AS f1 FROM scored),
    hit AS (SELECT round(avg((actual = predicted)::INTEGER) FILTER (WHERE split = 'train'), 8) AS train_score,
        round(avg((actual = predicted)::INTEGER) FILTER (WHERE split = 'test'), 8) AS test_score FROM sided)
    SELECT model, test_score AS accuracy, precision, recall, f1, 'macro' AS average, train_score, test_score
    FROM line, hit, (VALUES ('Naive Bayes'), ('own estimator')) AS names(model)
    """,
)
def mod9(spark, sf):
    # A model by name with its defaults, and the same brought by the caller.
    named = scores(bayes(spark, sf)).withColumn("model", F.lit("Naive Bayes"))
    own = scores(bayes(spark, sf, lambda: NaiveBayes(modelType="gaussian"))).withColumn("model", F.lit("own estimator"))
    return rnd(named.unionByName(own), 8, "accuracy", "precision", "recall", "f1", "train_score", "test_score")


@query(
    "mod10_logistic_regression",
    f"""
    WITH {split_sql('orders', 'o_orderkey')}
    SELECT o_orderpriority AS priority, round(avg((o_orderstatus = 'F')::INTEGER), 3) AS p_f,
        round(avg((o_orderstatus = 'O')::INTEGER), 3) AS p_o, round(avg((o_orderstatus = 'P')::INTEGER), 3) AS p_p
    FROM s WHERE split = 'train' GROUP BY 1
    """,
)
def mod10(spark, sf):
    """One text feature, hardly any penalty: a value's probabilities are its class shares."""
    df = orders(spark, sf)
    trained = training.train_classifier(
        df, ["o_orderpriority"], "o_orderstatus", "Logistic Regression", {"C": 1e9, "max_iter": 1000}, ["o_orderkey"]
    )
    scored = trained.predict(df, ["o_orderkey", "o_orderpriority"])
    shares = [F.round(F.avg(F.col("probability")[i]), 3).alias(f"p_{c}") for i, c in enumerate("fop")]
    return scored.groupBy(F.col("o_orderpriority").alias("priority")).agg(*shares)


# Whole-number points, so that distances are exact and ties are real.
POINTS = f"""parts AS (SELECT p_partkey, p_size * 100::DOUBLE AS a, round(p_retailprice * 100) AS b, p_type FROM part),
    {split_sql('parts', 'p_partkey')},
    n AS (SELECT q.p_partkey AS k, t.p_partkey AS tk, t.p_type AS y, t.b AS v, sqrt((q.a - t.a) * (q.a - t.a) + (q.b - t.b) * (q.b - t.b)) AS d
        FROM s q, s t WHERE q.split = 'test' AND t.split = 'train'
        QUALIFY row_number() OVER (PARTITION BY q.p_partkey ORDER BY (q.a - t.a) * (q.a - t.a) + (q.b - t.b) * (q.b - t.b), t.p_partkey) <= 5)"""


def points(spark, sf):
    a = (F.col("p_size") * 100).cast("double")
    b = F.round(F.col("p_retailprice") * 100)
    df = table(spark, sf, "part").select("p_partkey", "p_type", a.alias("a"), b.alias("b"))
    split = split_train_test(df, "p_type", ["p_partkey"])
    split = split.select(
        F.col("p_partkey").alias("key"), F.array("a", "b").alias("x"), "p_type", "b", SPLIT
    )
    return split.filter(F.col(SPLIT) == TRAIN), split.filter(F.col(SPLIT) != TRAIN)


@query(
    "mod11_knn_classifier",
    f"""
    WITH {POINTS}, votes AS (SELECT k, y, count(*) AS c FROM n GROUP BY ALL)
    SELECT k AS p_partkey, y AS prediction, c / 5.0::DOUBLE AS share FROM votes
    QUALIFY row_number() OVER (PARTITION BY k ORDER BY c DESC, y) = 1
    """,
)
def mod11(spark, sf):
    train, test = points(spark, sf)
    classes = training.class_list(train, "p_type")
    found = neighbors.nearest(train.withColumnRenamed("p_type", "y"), test, 5)
    voted = neighbors.vote(found, classes)
    return voted.select(
        F.col("test_key").alias("p_partkey"), "prediction", F.array_max("probability").alias("share")
    )


@query(
    "mod11_neighbours_copies",
    f"WITH {POINTS} SELECT k AS test_key, tk AS train_key, round(d, 6) AS distance FROM n",
)
def mod11_copies(spark, sf):
    """Rows given several times are answered as if they were given once."""
    train, test = points(spark, sf)
    found = neighbors.nearest(train.withColumnRenamed("p_type", "y"), test.unionByName(test).unionByName(test), 5)
    return rnd(found.select("test_key", "train_key", "distance"), 6, "distance")


@query(
    "mod11_neighbours",
    f"WITH {POINTS} SELECT k AS test_key, tk AS train_key, round(d, 6) AS distance FROM n",
)
def mod11_neighbours(spark, sf):
    train, test = points(spark, sf)
    # Small groups, so that the search has many of them to rule out.
    found = neighbors.nearest(train.withColumnRenamed("p_type", "y"), test, 5, cell_rows=100)
    return rnd(found.select("test_key", "train_key", "distance"), 6, "distance")


@query("mod12_decision_tree", stump_classes_sql("kind", "entropy", "a b c"))
def mod12(spark, sf):
    """A tree of one cut: the best one by entropy, which SQL finds by trying all."""
    params = {"criterion": "entropy", "max_depth": 1, "min_samples_split": 10}
    return shares_of(on_size(spark, sf, "kind", "Decision Tree", params), sized(spark, sf), "a b c")


# A wide gap between the classes: every sound model puts each row on its own side.
def gap_sql(target: str, extra: str = "") -> str:
    return f"""
    WITH {SIZED}, known AS (SELECT * FROM sized WHERE {target} IS NOT NULL), {split_sql('known', 'p_partkey')}
    SELECT p_partkey, {target} AS actual, {target} AS predicted{extra} FROM s WHERE split = 'test'"""


@query("mod13_random_forest", gap_sql("side", ", 1::DOUBLE AS chance"))
def mod13(spark, sf):
    test = on_size(spark, sf, "side", "Random Forest", {"n_estimators": 20, "max_depth": 6}).test
    return test.select("p_partkey", "actual", "predicted", F.round(F.array_max("probability"), 6).alias("chance"))


@query(
    "mod14_gaussian_bayes",
    f"""
    WITH {split_sql('orders', 'o_orderkey')}, {bayes_sql()}
    SELECT o_orderkey, max_by(c, ll) AS prediction, round(max(p) FILTER (WHERE c = 'F'), 6) AS p_f,
        round(max(p) FILTER (WHERE c = 'O'), 6) AS p_o, round(max(p) FILTER (WHERE c = 'P'), 6) AS p_p FROM q GROUP BY 1
    """,
)
def mod14(spark, sf):
    scored = bayes(spark, sf).predict(orders(spark, sf), ["o_orderkey"])
    p = F.col("probability")
    return scored.select(
        "o_orderkey", "prediction",
        *[F.round(p[i], 6).alias(f"p_{c}") for i, c in enumerate(("f", "o", "p"))],
    )


def line(spark, sf, model, params=None):
    trained = training.train_regressor(
        orders(spark, sf), ["o_custkey"], "o_totalprice", model, params, ["o_orderkey"]
    )
    fitted = trained.model.model
    row = trained.test.agg(
        F.count(F.lit(1)).alias("test_rows"), F.round(F.lit(float(fitted.coefficients[0])), 3).alias("slope"),
        F.round(F.lit(float(fitted.intercept)), 3).alias("intercept"),
    )
    return row


def line_sql(slope: str) -> str:
    return f"""
    WITH {LINE}, w AS (SELECT {slope} AS slope, m.* FROM m)
    SELECT (SELECT count(*) FROM s WHERE split = 'test') AS test_rows, round(slope, 3) AS slope, round(my - slope * mx, 3) AS intercept FROM w"""


@query("mod15_linear_regression", line_sql("sxy / sxx"))
def mod15(spark, sf):
    return line(spark, sf, "Linear Regression")


@query("mod16_support_vectors_linear", gap_sql("side"))
def mod16(spark, sf):
    return on_size(spark, sf, "side", "Support Vector Machine", {"kernel": "linear"}).test.select("p_partkey", "actual", "predicted")


@query("mod16_support_vectors_rbf", gap_sql("side"))
def mod16_rbf(spark, sf):
    return on_size(spark, sf, "side", "Support Vector Machine", None).test.select("p_partkey", "actual", "predicted")


@query("mod16_support_vectors_poly", gap_sql("side"))
def mod16_poly(spark, sf):
    return on_size(spark, sf, "side", "Support Vector Machine", {"kernel": "poly", "C": 0.5}).test.select("p_partkey", "actual", "predicted")


@query(
    "mod17_gradient_boosting",
    f"""
    WITH {SIZED}, signed AS (SELECT *, (half = 'small')::INTEGER::DOUBLE AS y FROM sized), {split_sql('signed', 'p_partkey')},
    {stump_sql('y', 'variance')}, start AS (SELECT avg(y) AS p0 FROM t),
    sides AS (SELECT p_size <= cut AS lower, 1 / (1 + exp(-(ln(p0 / (1 - p0)) + 0.1::DOUBLE * sum(y - p0) / sum(p0 * (1 - p0))))) AS p FROM t, best, start GROUP BY lower, p0)
    SELECT p_partkey, CASE WHEN p > 0.5 THEN 'small' ELSE 'large' END AS prediction, round(1 - p, 6) AS p_large, round(p, 6) AS p_small
    FROM sized, best JOIN sides ON lower = (p_size <= cut)
    """,
)
def mod17(spark, sf):
    """One stage of one cut: from the log odds, a shrunken Newton step on each side."""
    trained = on_size(spark, sf, "half", "Gradient Boosting", {"n_estimators": 1, "max_depth": 1})
    return shares_of(trained, sized(spark, sf), "large small")


@query("mod18_ridge_regression", line_sql("n * sxy / (n * sxx + 250)"))
def mod18(spark, sf):
    return line(spark, sf, "Ridge Regression", {"alpha": 250.0})


@query("mod19_lasso_regression", line_sql("sign(sxy) * greatest(abs(sxy) - 100, 0) / sxx"))
def mod19(spark, sf):
    return line(spark, sf, "Lasso Regression", {"alpha": 100.0})


STUMP_VALUES = f"""
    WITH {SIZED}, {split_sql('sized', 'p_partkey')}, {stump_sql('cost', 'variance')},
    sides AS (SELECT p_size <= cut AS lower, avg(cost) AS p FROM t, best GROUP BY 1)
    SELECT p_partkey, round(p, 4) AS prediction FROM sized, best JOIN sides ON lower = (p_size <= cut)"""


def costs(spark, sf, model, params) -> DataFrame:
    return rnd(on_size(spark, sf, "cost", model, params).predict(sized(spark, sf), ["p_partkey"]), 4, "prediction")


@query("mod20_tree_regressor", STUMP_VALUES)
def mod20(spark, sf):
    return costs(spark, sf, "Decision Tree Regressor", {"max_depth": 1})


@query("mod21_forest_regressor", gap_sql("level"))
def mod21(spark, sf):
    test = on_size(spark, sf, "level", "Random Forest Regressor", {"n_estimators": 10, "max_depth": 6}).test
    return rnd(test.select("p_partkey", "actual", "predicted"), 6, "predicted")


# One stage goes a tenth of the way from the mean of all to the mean of a side.
@query("mod22_boosting_regressor", STUMP_VALUES.replace("round(p, 4)", "round(0.9::DOUBLE * (SELECT avg(cost) FROM t) + 0.1::DOUBLE * p, 4)"))
def mod22(spark, sf):
    return costs(spark, sf, "Gradient Boosting Regressor", {"n_estimators": 1, "max_depth": 1})


@query(
    "mod23_knn_regressor",
    f"""
    WITH {POINTS}, e AS (SELECT *, min(d) OVER (PARTITION BY k) = 0 AS exact FROM n),
    w AS (SELECT *, CASE WHEN exact THEN (d = 0)::INTEGER::DOUBLE ELSE 1 / d END AS w FROM e)
    SELECT k AS p_partkey, round(sum(w * v) / sum(w), 4) AS prediction FROM w GROUP BY 1
    """,
)
def mod23(spark, sf):
    train, test = points(spark, sf)
    found = neighbors.nearest(train.withColumnRenamed("b", "y"), test, 5)
    return rnd(neighbors.average(found, "distance"), 4, "prediction").withColumnRenamed("test_key", "p_partkey")


CUBES = f"""cubes AS (SELECT p_partkey::BIGINT * p_partkey * p_partkey AS x, p_size::BIGINT AS y FROM part UNION ALL
        SELECT p_partkey::BIGINT * p_partkey * p_partkey, p_size::BIGINT FROM part),
    s AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY {hash_sql("concat_ws('-', x, y)")}, x, y) <= ceil(count(*) OVER () * 0.2::DOUBLE)
        THEN 'test' ELSE 'train' END AS split FROM cubes)"""


@query(
    "mod23_knn_registry",
    f"""
    WITH {CUBES}, asked AS (SELECT DISTINCT x FROM s WHERE split = 'test'),
    n AS (SELECT a.x, t.y FROM asked a, s t WHERE t.split = 'train' QUALIFY row_number() OVER (PARTITION BY a.x ORDER BY abs(a.x - t.x)) <= 5),
    p AS (SELECT x, avg(y) AS p FROM n GROUP BY 1)
    SELECT y::DOUBLE AS actual, round(p, 6) AS predicted FROM s JOIN p USING (x) WHERE split = 'test'
    """,
)
def mod23_registry(spark, sf):
    """Every row twice and no keys; no three whole cubes are evenly spaced, so no distances tie."""
    key = F.col("p_partkey")
    part = table(spark, sf, "part").select((key * key * key).alias("x"), F.col("p_size").cast("bigint").alias("y"))
    trained = training.train_regressor(part.unionByName(part), ["x"], "y", "KNN Regressor")
    return trained.test.select(F.col("actual").cast("double").alias("actual"), F.round("predicted", 6).alias("predicted"))


@query(
    "evl10_cross_validation",
    f"""
    WITH f AS (SELECT *, (ntile(5) OVER (PARTITION BY o_orderstatus ORDER BY {hash_sql('o_orderkey')}, o_orderkey) - 1)::INTEGER AS fold FROM orders),
    k AS (SELECT DISTINCT fold FROM f), {bayes_sql("fold <> fit", "f", "fold")}
    SELECT fold, round(avg((actual = predicted)::INTEGER), 8) AS score FROM answer JOIN f USING (o_orderkey) WHERE fold = fit GROUP BY 1
    """,
)
def evl10(spark, sf):
    scores = training.cross_validate(
        orders(spark, sf), BAYES_COLUMNS, "o_orderstatus", "Naive Bayes", None, ["o_orderkey"], "classification", 5
    )
    return rnd(scores, 8, "score")


FOLD_SCORES = f"""
    f AS (SELECT o_custkey AS x, o_totalprice AS y,
        (ntile(4) OVER (ORDER BY {hash_sql('o_orderkey')}, o_orderkey) - 1)::INTEGER AS fold FROM orders),
    k AS (SELECT DISTINCT fold FROM f),
    w AS (SELECT k.fold, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM k JOIN f ON f.fold <> k.fold GROUP BY 1),
    r AS (SELECT f.fold, 1 - avg((y - a - b * x) * (y - a - b * x)) / var_pop(y) AS score FROM f JOIN w ON f.fold = w.fold GROUP BY 1)"""


def line_folds(spark, sf) -> DataFrame:
    return training.cross_validate(
        orders(spark, sf), ["o_custkey"], "o_totalprice", "Linear Regression", None, ["o_orderkey"], "regression", 4
    )


@query(
    "evl10_cross_validation_summary",
    f"""
    WITH {FOLD_SCORES} SELECT round(avg(score), 8) AS mean, round(stddev_pop(score), 8) AS std, round(min(score), 8) AS min,
        round(max(score), 8) AS max, count(*) AS folds FROM r
    """,
)
def evl10_summary(spark, sf):
    return rnd(metrics.fold_summary(line_folds(spark, sf)), 8, "mean", "std", "min", "max")


@query("evl10_regression_scores", f"WITH {FOLD_SCORES} SELECT fold, round(score, 8) AS score FROM r")
def evl10_regression(spark, sf):
    return rnd(line_folds(spark, sf), 8, "score")


@query(
    "cmp1_shared_split",
    f"""
    WITH {stratified_sql('orders', 'o_orderkey', 'o_orderstatus')}
    SELECT split, o_orderstatus, count(*) AS n, sum(o_orderkey)::BIGINT AS keys FROM s GROUP BY ALL
    """,
)
def cmp1(spark, sf):
    split = split_train_test(orders(spark, sf), "o_orderstatus", ["o_orderkey"], stratify=True)
    return split.groupBy(SPLIT, "o_orderstatus").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


def compared_sql(name: str, pairs: str, share: str) -> str:
    """Metrics of ``actual, predicted, score`` for the second of two classes, and the AUC."""
    return f"""
    SELECT '{name}' AS model, round(avg((actual = predicted)::INTEGER), 8) AS accuracy,
        round(coalesce(sum((actual = 'small' AND predicted = 'small')::INTEGER) / nullif(sum((predicted = 'small')::INTEGER), 0)::DOUBLE, 0), 8) AS precision,
        round(coalesce(sum((actual = 'small' AND predicted = 'small')::INTEGER) / nullif(sum((actual = 'small')::INTEGER), 0)::DOUBLE, 0), 8) AS recall,
        round(2 * sum((actual = 'small' AND predicted = 'small')::INTEGER) / (sum((predicted = 'small')::INTEGER) + sum((actual = 'small')::INTEGER))::DOUBLE, 8) AS f1,
        (SELECT round(sum(pos * (below + neg / 2::DOUBLE)) / (sum(pos) * sum(neg))::DOUBLE, 8) FROM
            (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM
                (SELECT {share} AS score, sum((actual = 'small')::INTEGER) AS pos, sum((actual <> 'small')::INTEGER) AS neg FROM {pairs} GROUP BY 1))) AS auc
    FROM {pairs}"""


@query(
    "cmp2_compare_classifiers",
    f"""
    WITH {SIZED}, {stratified_sql('sized', 'p_partkey', 'half')}, {stump_sql('half', 'gini')},
    sides AS (SELECT p_size <= cut AS lower, mode(half) AS predicted, avg((half = 'small')::INTEGER) AS score FROM t, best GROUP BY 1),
    tree AS (SELECT half AS actual, predicted, score FROM s, best JOIN sides ON lower = (p_size <= cut) WHERE split = 'test'),
    z AS (SELECT avg(p_size) AS a, stddev_pop(p_size) AS d, count(*) AS n FROM t),
    g AS (SELECT half AS c, ln(count(*)::DOUBLE / any_value(n)) AS prior, avg((p_size - a) / d) AS m, var_pop((p_size - a) / d) + 1e-9::DOUBLE AS v FROM t, z GROUP BY 1),
    l AS (SELECT p_size AS size, c, prior - 0.5::DOUBLE * ln(2 * pi() * v) - ((p_size - a) / d - m) * ((p_size - a) / d - m) / (2 * v) AS ll FROM (SELECT DISTINCT p_size FROM s), z, g),
    o AS (SELECT size, max_by(c, ll) AS predicted, sum(CASE c WHEN 'small' THEN ll ELSE -ll END) AS score FROM l GROUP BY 1),
    bayes AS (SELECT half AS actual, predicted, score FROM s JOIN o ON size = p_size WHERE split = 'test')
    {compared_sql('Naive Bayes', 'bayes', 'round(score, 9)')} UNION ALL {compared_sql('Decision Tree', 'tree', 'round(score, 9)')}
    """,
)
def cmp2(spark, sf):
    result = compare.compare_classifiers(
        sized(spark, sf), ["p_size"], "half", ["Naive Bayes", "Decision Tree"], {"Decision Tree": {"max_depth": 1}}, ["p_partkey"],
    )
    return rnd(result.table, 8, "accuracy", "precision", "recall", "f1", "auc")


def line_scores_sql(name: str, slope: str) -> str:
    return f"""SELECT '{name}' AS model, round(avg(abs(y - p)), 3) AS mae, round(sqrt(avg((y - p) * (y - p))), 3) AS rmse,
        round(1 - avg((y - p) * (y - p)) / var_pop(y), 7) AS r2
    FROM (SELECT o_totalprice AS y, my + {slope} * ((o_custkey - a) / d - mx) AS p FROM s, z, m WHERE split = 'test')"""


@query(
    "cmp3_compare_linear_models",
    f"WITH {LINE} {line_scores_sql('Linear Regression', 'sxy / sxx')} UNION ALL {line_scores_sql('Ridge Regression', 'n * sxy / (n * sxx + 250)')} "
    f"UNION ALL {line_scores_sql('Lasso Regression', 'sign(sxy) * greatest(abs(sxy) - 100, 0) / sxx')}",
)
def cmp3_linear(spark, sf):
    result = compare.compare_regressors(
        orders(spark, sf), ["o_custkey"], "o_totalprice",
        ["Linear Regression", "Ridge Regression", "Lasso Regression"],
        {"Ridge Regression": {"alpha": 250.0}, "Lasso Regression": {"alpha": 100.0}}, ["o_orderkey"],
    )
    return rnd(rnd(result.table, 3, "mae", "rmse"), 7, "r2")


@query(
    "cmp3_compare_regressors",
    f"""
    WITH {SIZED}, {split_sql('sized', 'p_partkey')}, {stump_sql('cost', 'variance')},
    sides AS (SELECT p_size <= cut AS lower, avg(cost) AS p FROM t, best GROUP BY 1),
    fitted AS (SELECT regr_slope(cost, p_size) AS b, regr_intercept(cost, p_size) AS a FROM t),
    answers AS (SELECT 'Linear Regression' AS model, cost AS y, a + b * p_size AS p FROM s, fitted WHERE split = 'test'
        UNION ALL SELECT 'Decision Tree Regressor', cost, p FROM s, best JOIN sides ON lower = (p_size <= cut) WHERE split = 'test')
    SELECT model, round(avg(abs(y - p)), 4) AS mae, round(sqrt(avg((y - p) * (y - p))), 4) AS rmse, round(1 - avg((y - p) * (y - p)) / var_pop(y), 7) AS r2
    FROM answers GROUP BY 1
    """,
)
def cmp3(spark, sf):
    result = compare.compare_regressors(
        sized(spark, sf), ["p_size"], "cost", ["Linear Regression", "Decision Tree Regressor"],
        {"Decision Tree Regressor": {"max_depth": 1}}, ["p_partkey"],
    )
    return rnd(rnd(result.table, 4, "mae", "rmse"), 7, "r2")


