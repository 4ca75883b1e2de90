"""Trees, forests and boosting: both ways of growing, other layouts, and known answers."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from gridloom.models import trees
from gridloom.models.trees import Rule


def frame(spark, x, y, parts=3):
    rows = [(i, Vectors.dense(a), float(b)) for i, (a, b) in enumerate(zip(x.tolist(), y.tolist()))]
    return spark.createDataFrame(rows, ["_key", "features", "label"]).repartition(parts)


@pytest.fixture(scope="module")
def data():
    rng = np.random.RandomState(4)
    x = np.column_stack([rng.randint(0, 12, 400), np.round(rng.normal(size=400), 1), rng.randint(0, 3, 400), np.zeros(400)]).astype(float)
    value = 3 * (x[:, 0] > 5) + x[:, 1] * (x[:, 2] == 1) + np.round(rng.normal(size=400), 1)
    return x, value, np.digitize(value, [0.5, 2.5])


def plain_tree(x, y, depth, least=2):
    """Answers of the best cuts found by trying every one; y has a row of targets per row."""
    loss = lambda v: ((v - v.mean(axis=0)) ** 2).sum()

    def grow(rows, left):
        if left == 0 or len(rows) < least or loss(y[rows]) < 1e-12:
            return y[rows].mean(axis=0)
        best = None
        for j in range(x.shape[1]):
            values = np.unique(x[rows, j])
            for a, b in zip(values, values[1:]):
                lower = x[rows, j] <= a
                gain = round(1 - (loss(y[rows[lower]]) + loss(y[rows[~lower]])) / loss(y[rows]), 9)
                if best is None or gain > best[0]:
                    best = (gain, j, (a + b) / 2, rows[lower], rows[~lower])
        if best is None:
            return y[rows].mean(axis=0)
        return best[1], best[2], grow(best[3], left - 1), grow(best[4], left - 1)

    def answer(node, row):
        while isinstance(node, tuple):
            node = node[2] if row[node[0]] <= node[1] else node[3]
        return node

    root = grow(np.arange(len(x)), depth)
    return lambda rows: np.array([answer(root, r) for r in rows])


@pytest.mark.parametrize("local, depth, least", [(1000, 3, 2), (60, 4, 25), (0, 3, 2), (30, -1, 2)])
def test_tree_equals_a_search_of_all_cuts(spark, data, local, depth, least):
    x, value, kind = data
    grid = x + np.array([0.0, 0.013, 0.0, 1.0])
    for y, classes in ((value[:, None], None), (np.eye(3)[kind], list("abc"))):
        label = value if classes is None else kind
        model = trees.fit_tree(frame(spark, x, label), classes, Rule(None if depth < 0 else depth, least), local)
        assert np.allclose(model.trees.mean(grid), plain_tree(x, y, depth, least)(grid), atol=1e-9)
    assert model.weights.sum() == pytest.approx(1) and model.weights[3] == 0


def test_entropy_cuts_differ_and_both_ways_agree(spark, data):
    x, _, kind = data
    here, there = (trees.fit_tree(frame(spark, x, kind), list("abc"), Rule(4, criterion="entropy"), n).trees for n in (1000, 0))
    assert np.allclose(here.mean(x), there.mean(x))
    order = np.argsort(x[:, 0], kind="stable")
    best = max(
        (round(1 - sum(trees._loss("entropy", len(s), np.bincount(s, minlength=3).astype(float), 0.0) for s in (kind[x[:, j] <= v], kind[x[:, j] > v])) / trees._loss("entropy", 400.0, np.bincount(kind).astype(float), 0.0), 9), -j, -v)
        for j in range(3) for v in np.unique(x[:, j])[:-1]
    )
    assert here.feature[0] == -best[1] and here.threshold[0] > -best[2] and len(order) == 400


def test_a_cut_without_gain_is_taken_where_classes_are_mixed(spark):
    x = np.array([[0, 0], [0, 1], [1, 0], [1, 1]] * 3, float)
    for local in (100, 0):
        model = trees.fit_tree(frame(spark, x, x[:, 0] != x[:, 1]), ["n", "y"], Rule(), local)
        assert (model.trees.mean(x)[:, 1] == (x[:, 0] != x[:, 1])).all()


def test_forest_does_not_depend_on_the_layout(spark, data):
    x, value, kind = data
    answers = []
    for parts, local, at_once in ((1, 1000, 7), (7, 1000, 2), (3, 50, 4)):
        forest = trees.fit_forest(frame(spark, x, kind, parts), list("abc"), 5, Rule(4, subset=2, seed=9), local, at_once)
        answers.append(forest.trees.mean(x))
        assert len(forest.trees.roots) == 5 and np.allclose(answers[-1].sum(axis=1), 1)
    assert np.allclose(answers[0], answers[1]) and np.allclose(answers[0], answers[2])
    assert (answers[0].argmax(axis=1) == kind).mean() > np.bincount(kind).max() / len(kind) + 0.1
    other = trees.fit_forest(frame(spark, x, kind), list("abc"), 5, Rule(4, subset=2, seed=10))
    assert not np.allclose(other.trees.mean(x), answers[0])


def test_bootstrap_weights_are_poisson(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "_key")
    n, total, square = trees.bootstrap(rows, [0, 1], 3).selectExpr("count(*)", "sum(w)", "sum(w * w)").first()
    assert n / 40_000 == pytest.approx(1 - np.exp(-1), abs=0.01)
    assert total / 40_000 == pytest.approx(1, abs=0.02) and square / 40_000 == pytest.approx(2, abs=0.06)


def boosted_by_hand(x, targets, stages, rate, depth, classes):
    """Raw scores of boosting with trees from a search of all cuts."""
    k = targets.shape[1]
    n = len(x)
    if classes == 0:
        raw = np.tile(targets.mean(axis=0), (n, 1))
    elif classes == 2:
        raw = np.full((n, 1), np.log(targets[:, 1].mean() / targets[:, 0].mean()))
    else:
        raw = np.tile(np.log(targets.mean(axis=0)), (n, 1))
    for _ in range(stages):
        if classes == 0:
            left, curve = targets - raw, np.ones_like(raw)
        elif classes == 2:
            p = 1 / (1 + np.exp(-raw))
            left, curve = targets[:, 1:] - p, p * (1 - p)
        else:
            p = np.exp(raw) / np.exp(raw).sum(axis=1, keepdims=True)
            left, curve = targets - p, p * (1 - p) * k / (k - 1)
        step = np.zeros_like(raw)
        for c in range(raw.shape[1]):
            leaf = plain_tree(x, left[:, c : c + 1], depth)(x)[:, 0].round(10)
            for v in np.unique(leaf):
                step[leaf == v, c] = left[leaf == v, c].sum() / curve[leaf == v, c].sum()
        raw = raw + rate * step
    return raw


@pytest.mark.parametrize("local", [1000, 100])
def test_boosting_equals_stages_by_hand(spark, data, local, monkeypatch):
    monkeypatch.setattr(trees, "STAGES_HELD", 2)
    x, value, kind = data
    x, value, kind = x[:200], value[:200], kind[:200]
    got = trees.fit_boosting(frame(spark, x, value), None, 3, 0.3, Rule(2), local)
    assert np.allclose(got.raw(x), boosted_by_hand(x, value[:, None], 3, 0.3, 2, 0), atol=1e-8)
    two = (kind > 0).astype(int)
    got = trees.fit_boosting(frame(spark, x, two), ["a", "b"], 3, 0.3, Rule(2), local)
    assert np.allclose(got.raw(x), boosted_by_hand(x, np.eye(2)[two], 3, 0.3, 2, 2), atol=1e-8)
    got = trees.fit_boosting(frame(spark, x, kind), list("abc"), 3, 0.3, Rule(2), local)
    assert np.allclose(got.raw(x), boosted_by_hand(x, np.eye(3)[kind], 3, 0.3, 2, 3), atol=1e-8)
    scored = got.score(frame(spark, x, kind).drop("label")).collect()
    assert all(r.prediction == np.argmax(r.probability) and abs(sum(r.probability) - 1) < 1e-9 for r in scored)


def test_trees_have_no_depth_bound(spark):
    """Values that double: the best cut always takes the largest one off, level by level."""
    x = np.arange(44, dtype=float)[:, None]
    for local in (100, 30):
        model = trees.fit_tree(frame(spark, x, 2.0 ** x[:, 0]), None, Rule(), local)
        assert np.allclose(model.trees.mean(x)[:, 0], 2.0 ** x[:, 0]) and len(model.trees.feature) == 87


def test_large_models_are_refused(spark, data, monkeypatch):
    monkeypatch.setattr(trees, "MAX_NODES", 20)
    with pytest.raises(ValueError, match="max_depth"):
        trees.fit_tree(frame(spark, data[0], data[1]), None, Rule())


@pytest.mark.parametrize("local", [1000, 5])
def test_rows_of_a_forest_are_added_up_per_point(spark, data, local, monkeypatch):
    """Rows at few points reach the levels as one row a point and tree, and the trees are the same."""
    x, _, kind = data
    x = x[:, [0, 2]]
    grown, plain = [], trees._sums
    monkeypatch.setattr(trees, "_sums", lambda rows, points: grown.append(plain(rows, points)) or grown[-1])
    monkeypatch.setattr(trees, "ROWS_PER_TASK", 100)
    models = []
    for share in (0.5, 0.0):
        monkeypatch.setattr(trees, "POINTS_PER_ROW", share)
        models.append(trees.fit_forest(frame(spark, x, kind, 1), list("abc"), 3, Rule(2, subset=1, seed=5), local).trees)
    assert grown[0].count() <= 3 * len(np.unique(x, axis=0)) < grown[1].count()
    assert grown[0].agg({"c": "sum"}).first()[0] == grown[1].count()
    assert grown[1].rdd.getNumPartitions() > 1
    for name in ("feature", "left", "right"):
        assert (getattr(models[0], name) == getattr(models[1], name)).all()
    assert np.allclose(models[0].value, models[1].value) and np.allclose(models[0].threshold, models[1].threshold)
