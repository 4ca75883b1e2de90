import itertools

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from conftest import rows_as
from gridloom.models import neighbors, svm, training
from gridloom.models.registry import CLASSIFIERS, REGRESSORS, default_params
from gridloom.operators import compare, metrics
from gridloom.operators.prepare import fit_features
from gridloom.operators.split import split_train_test


def labels(spark, truth, called):
    return spark.createDataFrame(list(zip(truth, called)), "actual string, predicted string")


# Scores


def test_binary_metrics(spark):
    row = metrics.classification_metrics(labels(spark, "00111", "01110")).first()
    assert row["accuracy"] == pytest.approx(0.6) and row["average"] == "binary"
    assert row["precision"] == row["recall"] == row["f1"] == pytest.approx(2 / 3)


def test_macro_metrics_and_report(spark):
    df = labels(spark, "aabbcc", "abbbcc")
    row = metrics.classification_metrics(df).first()
    assert row["accuracy"] == pytest.approx(5 / 6) and row["average"] == "macro"
    assert row["precision"] == pytest.approx((1 + 2 / 3 + 1) / 3) and row["recall"] == pytest.approx((0.5 + 1 + 1) / 3)
    report = {r["class"]: r for r in metrics.classification_report(df, ["a", "b", "c", "z"]).collect()}
    assert report["z"]["support"] == 0 and report["Macro average"]["recall"] == pytest.approx(2.5 / 4)
    assert report["Weighted average"]["recall"] == pytest.approx(5 / 6) and report["Weighted average"]["support"] == 6
    matrix = {r["actual"]: r for r in metrics.confusion_matrix(df).collect()}
    assert matrix["Actual a"]["Predicted b"] == 1 and matrix["Actual c"]["Predicted a"] == 0


def test_nothing_called_counts_as_zero(spark):
    row = metrics.classification_metrics(labels(spark, "0011", "0000")).first()
    assert (row["precision"], row["recall"], row["f1"]) == (0.0, 0.0, 0.0)


@pytest.mark.parametrize("window_rows", [3, 1_000_000])
def test_auc_equals_pair_counting(spark, window_rows):
    rng = np.random.default_rng(3)
    score, positive = np.round(rng.uniform(size=120), 1), rng.integers(0, 2, 120).astype(bool)
    pairs = [(p > n) + 0.5 * (p == n) for p, n in itertools.product(score[positive], score[~positive])]
    df = spark.createDataFrame([("c", float(s), bool(p)) for s, p in zip(score, positive)], "class string, score double, positive boolean")
    assert metrics.roc_auc(df, window_rows=window_rows).first()["auc"] == pytest.approx(np.mean(pairs))
    points = sorted((r["fpr"], r["tpr"]) for r in metrics.roc_points(df, window_rows=window_rows).collect())
    assert points[0] == (0.0, 0.0) and points[-1] == (1.0, 1.0)
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))
    assert area == pytest.approx(np.mean(pairs))


def test_auc_is_null_when_a_class_is_absent(spark):
    df = spark.createDataFrame([("a", [0.6, 0.3, 0.1]), ("b", [0.2, 0.7, 0.1])], "actual string, probability array<double>")
    assert metrics.roc_auc_brief(df, ["a", "b", "c"]).first()["auc"] is None
    curves = metrics.roc_points(metrics.one_vs_rest(df, ["a", "b", "c"], "actual", "probability"))
    assert {r["class"] for r in curves.collect()} == {"a", "b"}


def test_regression_metrics(spark):
    df = spark.createDataFrame(list(zip([1.0, 2.0, 3.0, 4.0, 5.0], [1.0, 2.0, 3.0, 4.0, 4.0])), "actual double, predicted double")
    row = metrics.regression_metrics(df).first()
    assert (row["mae"], row["mse"], row["r2"]) == (pytest.approx(0.2), pytest.approx(0.2), pytest.approx(0.9))
    flat = df.select(F.lit(2.0).alias("actual"), F.lit(2.0).alias("predicted"))
    assert metrics.regression_metrics(flat).first()["r2"] == 1.0
    stats = metrics.residual_statistics(metrics.prediction_frame(df, "actual", "predicted")).first()
    assert (stats["min"], stats["median"], stats["max"]) == (0.0, 0.0, 1.0)
    assert stats["std"] == pytest.approx(np.std([0, 0, 0, 0, 1]))


# Nearest neighbours


def brute(train, test, k):
    out = {}
    for key, x in test:
        d = sorted(((np.sum((np.array(x) - np.array(p)) ** 2), t) for t, p, _ in train))[:k]
        out[key] = [t for _, t in d]
    return out


@pytest.mark.parametrize("cell_rows", [3, 25, 10_000])
@pytest.mark.parametrize("kind", ["spread", "copies", "clusters"])
def test_nearest_is_exact(spark, kind, cell_rows):
    rng = np.random.default_rng(4)
    if kind == "spread":
        points = rng.integers(0, 40, (150, 3))
    elif kind == "copies":  # a third of the rows are one point
        points = np.r_[np.full((50, 3), 7), rng.integers(0, 12, (100, 3))]
    else:
        points = np.r_[rng.integers(0, 4, (100, 3)), rng.integers(1000, 1004, (50, 3))]
    data = [(i, [float(v) for v in p], float(i % 3)) for i, p in enumerate(points)]
    train, test = data[::2], [(i, x) for i, x, _ in data[1::2]]
    a = spark.createDataFrame(train, "key bigint, x array<double>, y double").repartition(3)
    b = spark.createDataFrame(test, "key bigint, x array<double>").repartition(5)
    found = {}
    for r in neighbors.nearest(a, b, 4, cell_rows).orderBy("test_key", "rank").collect():
        found.setdefault(r["test_key"], []).append(r["train_key"])
    assert found == brute(train, test, 4)


def test_fewer_training_rows_than_k(spark):
    train = spark.createDataFrame([(1, [0.0], 1.0), (2, [4.0], 3.0)], "key int, x array<double>, y double")
    test = spark.createDataFrame([(9, [0.0])], "key int, x array<double>")
    found = neighbors.nearest(train, test, 5)
    assert found.count() == 2
    assert neighbors.average(found, "uniform").first()["prediction"] == 2.0
    assert neighbors.average(found, "distance").first()["prediction"] == 1.0  # the exact match wins
    vote = neighbors.vote(found, [1.0, 3.0]).first()
    assert vote["prediction"] == 1.0 and vote["probability"] == [0.5, 0.5]


# Models


@pytest.fixture(scope="module")
def people(spark):
    rng = np.random.default_rng(42)
    rows = []
    for i in range(120):
        a, b, g = float(rng.normal()), float(rng.normal()), "xyz"[int(rng.integers(3))]
        y = 3 * a + 2 * b + 0.1 * float(rng.normal())
        rows.append((i, None if i % 17 == 0 else a, b, None if i % 19 == 0 else g, "yes" if a + b > 0 else "no", "lmh"[int(y > -2) + int(y > 2)], y, i == 5))
    return spark.createDataFrame(rows, "id int, a double, b double, g string, two string, three string, y double, flag boolean").coalesce(1)


FEATURES = ["a", "b", "g"]
QUICK = {
    "Random Forest": {"n_estimators": 10, "max_depth": 5}, "Gradient Boosting": {"n_estimators": 10},
    "Logistic Regression": {"max_iter": 50}, "Decision Tree": {"max_depth": 5},
    "Random Forest Regressor": {"n_estimators": 10, "max_depth": 5}, "Gradient Boosting Regressor": {"n_estimators": 10},
    "Decision Tree Regressor": {"max_depth": 5},
}


@pytest.mark.parametrize("name", list(CLASSIFIERS))
@pytest.mark.parametrize("target", ["two", "three"])
def test_classifiers_learn(people, name, target):
    trained = training.train_classifier(people, FEATURES, target, name, QUICK.get(name), ["id"], stratify=True)
    test = trained.test.collect()
    assert len(test) == 24
    assert np.mean([r["actual"] == r["predicted"] for r in test]) > 0.6
    for r in test:
        assert len(r["probability"]) == len(trained.classes) and sum(r["probability"]) == pytest.approx(1)


@pytest.mark.parametrize("name", list(REGRESSORS))
def test_regressors_learn(people, name):
    trained = training.train_regressor(people, FEATURES, "y", name, QUICK.get(name), ["id"])
    row = trained.metrics.first()
    assert row["r2"] > 0.5 and trained.predictions.count() == 24


@pytest.mark.parametrize("kernel", ["linear", "sigmoid"])
def test_svm_kernels(people, kernel):
    trained = training.train_classifier(people, FEATURES, "two", "Support Vector Machine", {"kernel": kernel}, ["id"])
    assert trained.scores.first()["test_score"] > 0.5


def test_reproducible_and_leak_free(people):
    a = training.train_classifier(people, FEATURES, "two", "Random Forest", QUICK["Random Forest"], ["id"])
    b = training.train_classifier(people.repartition(1), FEATURES, "two", "Random Forest", QUICK["Random Forest"], ["id"])
    assert rows_as(a.rows.select("id", "split"), "id", "split") == rows_as(b.rows.select("id", "split"), "id", "split")
    train = people.join(a.rows.filter("split = 'train'").select("id"), "id")
    known = [r["b"] for r in train.collect()]
    assert a.features.scaler["b"][0] == pytest.approx(np.mean(known))


def test_null_targets_and_unseen_values(spark, people):
    holes = people.withColumn("two", F.when(F.col("id") > 9, F.col("two")))
    trained = training.train_classifier(holes, FEATURES, "two", "Naive Bayes", None, ["id"])
    assert trained.rows.count() == 110
    fresh = spark.createDataFrame([(1, 0.5, 0.5, "new")], "id int, a double, b double, g string")
    predicted = trained.predict(fresh, ["id"])
    assert predicted.first()["prediction"] in ("yes", "no")
    long = training.class_probabilities(predicted, ["id"], trained.classes).collect()
    assert {r["class"] for r in long} == {"no", "yes"}


def test_a_class_that_is_only_in_the_test_side(people):
    held = split_train_test(people, "two", ["id"]).filter("split = 'test'").first()["id"]
    rare = people.withColumn("two", F.when(F.col("id") == held, "rare").otherwise(F.col("two")))
    trained = training.train_classifier(rare, FEATURES, "two", "Naive Bayes", None, ["id"])
    assert trained.classes == ["no", "yes"]
    assert "rare" in {r["actual"] for r in trained.test.collect()}
    assert trained.metrics.first()["accuracy"] > 0


def test_errors(people):
    with pytest.raises(ValueError):
        training.train_classifier(people, [], "two", keys=["id"])
    with pytest.raises(ValueError):
        training.train_classifier(people, FEATURES, "two", "No Such Model", keys=["id"])
    with pytest.raises(ValueError):
        training.train_classifier(people, FEATURES, "two", "Naive Bayes", {"depth": 3}, ["id"])
    with pytest.raises(ValueError):
        training.train_classifier(people.filter("false"), FEATURES, "two", keys=["id"])
    for bad in ("nope", "y"):
        with pytest.raises(ValueError):
            training.validate_classification_target(people, bad)
    for bad in ("nope", "g"):
        with pytest.raises(ValueError):
            training.validate_regression_target(people, bad)
    with pytest.raises(ValueError):
        training.validate_regression_target(people.withColumn("c", F.lit(1.0)), "c")
    assert training.validate_regression_target(people, "flag").first()["n_unique"] == 2


def test_own_estimator_importance_and_defaults(spark, people):
    trained = training.train_classifier(people, FEATURES, "two", lambda: DecisionTreeClassifier(maxDepth=4), None, ["id"])
    table = training.feature_importance(trained.model, trained.features.names, spark)
    values = [r["importance"] for r in table.collect()]
    assert values == sorted(values, reverse=True) and sum(values) == pytest.approx(1)
    bayes = training.train_classifier(people, FEATURES, "two", "Naive Bayes", None, ["id"])
    assert training.feature_importance(bayes.model, bayes.features.names, spark) is None
    assert default_params("Ridge Regression") == {"alpha": 1.0}
    assert CLASSIFIERS["Decision Tree"].values({"max_depth": 0})["max_depth"] is None


def test_logistic_matches_the_penalised_objective(people):
    trained = training.train_classifier(people, ["b"], "two", "Logistic Regression", {"C": 0.7}, ["id"])
    train = trained.rows.filter("split = 'train'").collect()
    x, y = np.array([r["features"][0] for r in train]), np.array([r["label"] for r in train])
    w = c = 0.0
    for _ in range(60):  # Newton steps on C * log loss + w^2 / 2
        p = 1 / (1 + np.exp(-(w * x + c)))
        s = p * (1 - p)
        g = np.array([0.7 * np.sum((p - y) * x) + w, 0.7 * np.sum(p - y)])
        h = 0.7 * np.array([[np.sum(s * x * x), np.sum(s * x)], [np.sum(s * x), np.sum(s)]]) + np.diag([1.0, 0.0])
        w, c = np.array([w, c]) - np.linalg.solve(h, g)
    assert trained.model.model.coefficients[0] == pytest.approx(w, rel=1e-3)


def test_rows_that_share_a_key_or_repeat(spark):
    """Neighbours of repeated rows are those of one; without keys only features identify a row."""
    train = spark.createDataFrame([(i, [float(i)], float(i)) for i in range(20)], "key long, x array<double>, y double")
    test = spark.createDataFrame([(7, [2.2]), (7, [2.2])], "key long, x array<double>")
    found = neighbors.nearest(train, test, 5).orderBy("rank").collect()
    assert [r["train_key"] for r in found] == [2, 3, 1, 4, 0]
    rows = [(float(i**3), float(i)) for i in range(30)]
    twice = spark.createDataFrame(rows + rows, "x double, y double")
    with training.train_regressor(twice, ["x"], "y", "KNN Regressor") as trained:
        learned = [(r["x"], r["y"]) for r in split_train_test(twice, "y").filter("split = 'train'").collect()]
        answers = {}
        for r in trained.test.collect():
            answers.setdefault(r["actual"], set()).add(round(r["predicted"], 9))
        for y, given in answers.items():
            near = sorted(learned, key=lambda t: abs(t[0] - y**3))[:5]
            assert given == {round(sum(t[1] for t in near) / 5, 9)}


def test_too_many_classes_are_refused(people):
    with pytest.raises(ValueError, match="max_classes"):
        training.train_classifier(people, FEATURES, "three", "Naive Bayes", None, ["id"], max_classes=2)


def test_cross_validation(people):
    scores = training.cross_validate(people, FEATURES, "two", "Naive Bayes", None, ["id"], "classification", 3)
    assert [r["fold"] for r in scores.collect()] == [0, 1, 2]
    summary = metrics.fold_summary(scores).first()
    values = [r["score"] for r in scores.collect()]
    assert summary["mean"] == pytest.approx(np.mean(values)) and summary["std"] == pytest.approx(np.std(values))
    rare = people.withColumn("two", F.when(F.col("id") < 2, "rare").otherwise("rest"))
    with pytest.raises(ValueError):
        training.cross_validate(rare, FEATURES, "two", "Naive Bayes", None, ["id"], "classification", 3)


def test_comparison(people):
    names = ["Naive Bayes", "K-Nearest Neighbors"]
    one = compare.compare_classifiers(people, FEATURES, "two", names, keys=["id"])
    two = compare.compare_classifiers(people.repartition(2), FEATURES, "two", names, keys=["id"])
    assert rows_as(one.table, *one.table.columns) == rows_as(two.table, *two.table.columns)
    assert all(s.is_cached for s in one.scored.values())
    keys = [sorted(r["_key"] for r in s.collect()) for s in one.scored.values()]
    assert keys[0] == keys[1] and len(keys[0]) == 24
    curves = compare.roc_overlay(compare.overlay_rows(one))
    assert {r["model"] for r in curves.collect()} == set(names)
    three = compare.compare_classifiers(people, FEATURES, "three", ["Naive Bayes"], keys=["id"])
    assert compare.overlay_rows(three) is None and three.table.first()["auc"] > 0.5
    with pytest.raises(ValueError):
        compare.compare_classifiers(people, FEATURES, "two", [], keys=["id"])
    regress = compare.compare_regressors(people, FEATURES, "y", ["Linear Regression", "KNN Regressor"], keys=["id"])
    assert compare.best_model(regress.table).first()["model"] == "Linear Regression"
    long = compare.metrics_long(regress.table)
    assert long.count() == 6


def test_ranking(spark):
    table = spark.createDataFrame([("A", 0.8, 0.7), ("B", 0.8, 0.9)], "model string, accuracy double, f1 double")
    assert compare.best_model(table).first()["model"] == "B"
    assert [r["model"] for r in compare.ranked(table).orderBy("place").collect()] == ["B", "A"]


def test_mapped_rows_are_dealt_out_and_copies_are_weights(spark, monkeypatch):
    """One input part must not become one task, and copies must not become wide rows."""
    seen, plain = [], svm._mapped
    monkeypatch.setattr(svm, "_mapped", lambda df, feature_map: seen.append(df) or plain(df, feature_map))
    monkeypatch.setattr(svm, "ROWS_PER_TASK", 50)
    points = [(float(i % 40), float(i % 15)) for i in range(200)]
    rows = [(3 * i + n, Vectors.dense(p), float(p[0] > 19)) for i, p in enumerate(points) for n in range(3)]
    train = spark.createDataFrame(rows, ["_key", "features", "label"]).coalesce(1)
    machine = svm.fit_svm(train, ["a", "b"], "rbf")
    sizes = [len(part) for part in seen[0].rdd.glom().collect()]
    assert sum(sizes) == train.selectExpr("features", f"pmod(conv(substring(md5(concat_ws('-', _key, '43')), 1, 8), 16, 10), 3)").distinct().count()
    assert sum(sizes) < 600 and len(sizes) > 1 and max(sizes) <= 100
    assert seen[0].agg(F.sum("weight")).first()[0] == 600
    got = machine.score(train).filter("prediction = label").count()
    assert got >= 590


def test_folds_are_dealt_once_and_let_go(spark):
    rows = spark.range(300).selectExpr("id AS k", "id % 50 AS x", "id % 50 * 2.0 + id % 7 AS y", "'t' AS spare")
    plans, held = [], len(spark.sparkContext._jsc.getPersistentRDDs())

    def preparer(df, columns):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return fit_features(df, columns)

    scores = training.cross_validate(rows, ["x"], "y", "Linear Regression", None, ["k"], "regression", 3, preparer=preparer)
    assert sorted(r.fold for r in scores.collect()) == [0, 1, 2]
    assert len(plans) == 3 and all("InMemoryRelation" in p for p in plans)
    assert not any("spare" in p.split("InMemoryRelation")[1].split("\n")[0] for p in plans)
    spread = [r.score for r in scores.collect()]
    assert all(0.99 < s < 1 for s in spread)
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == held


def test_neighbour_search_is_dealt_by_rows(spark, monkeypatch):
    """Small rows in one input part must not become one task."""
    monkeypatch.setattr(neighbors, "TASK_ROWS", 50)
    seen = {}
    for name in ("_in_cells", "_visits"):
        plain = getattr(neighbors, name)
        monkeypatch.setattr(neighbors, name, lambda df, *rest, n=name, f=plain: seen.update({n: df.rdd.getNumPartitions()}) or f(df, *rest))
    train = spark.range(400).selectExpr("id AS key", "array(double(id * id)) AS x", "id AS y").coalesce(1)
    test = spark.range(200).selectExpr("id AS key", "array(id * id + 0.25D) AS x").coalesce(1)
    found = neighbors.nearest(train, test, 1, cell_rows=40).collect()
    assert {r.test_key: r.train_key for r in found} == {i: i for i in range(200)}
    assert seen == {"_in_cells": 9, "_visits": 5}
