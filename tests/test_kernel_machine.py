"""The exact kernel machine against its optimality conditions on a dense kernel matrix."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from gridloom.models import training
from gridloom.models.kernel_machine import fit_kernel_machine, fit_kernel_votes, kernel_values


def cloud(n, seed=3):
    """Two overlapping classes in three dimensions; every tenth row is there twice."""
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 3)), 2)
    y = (x[:, 0] * x[:, 1] + 0.5 * x[:, 2] + rng.normal(scale=0.4, size=n) > 0).astype(float)
    twice = np.arange(n) % 10 == 0
    return np.vstack([x, x[twice]]), np.concatenate([y, y[twice]])


def as_table(spark, x, y):
    rows = [(i, Vectors.dense(a.tolist()), float(b)) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, ["_key", "features", "label"]).repartition(5)


def dense(x, y, kernel, gamma, c, tolerance=1e-6):
    """Margins of all rows by moving the worst pair of rows, copies kept apart."""
    k, sign = kernel_values(x, x, kernel, gamma), 2 * y - 1
    a = np.zeros(len(y))
    for _ in range(200_000):
        value = sign * (1 - sign * (k @ (a * sign)))
        rise = np.where(sign > 0, a < c - 1e-12, a > 1e-12)
        fall = np.where(sign > 0, a > 1e-12, a < c - 1e-12)
        i, j = np.argmax(np.where(rise, value, -np.inf)), np.argmin(np.where(fall, value, np.inf))
        if value[i] - value[j] < tolerance:
            break
        step = (value[i] - value[j]) / max(k[i, i] + k[j, j] - 2 * k[i, j], 1e-12)
        step = min(step, c - a[i] if sign[i] > 0 else a[i], a[j] if sign[j] > 0 else c - a[j])
        a[i] += sign[i] * step
        a[j] -= sign[j] * step
    free = (a > 1e-9) & (a < c - 1e-9)
    grad = sign * (sign * (k @ (a * sign)) - 1)
    return k @ (a * sign) - grad[free].mean()


@pytest.mark.parametrize("kernel", ["rbf", "linear", "poly"])
def test_margins_equal_those_of_all_pairs(spark, kernel):
    x, y = cloud(250)
    table = as_table(spark, x, y)
    machine = fit_kernel_machine(table, kernel, 1.0, 0.3, tolerance=1e-6, working_set=400)
    got = {r["_key"]: r["m"] for r in table.select("_key", machine.margin().alias("m")).collect()}
    expected = dense(x, y, kernel, 0.3, 1.0)
    assert np.allclose([got[i] for i in range(len(y))], expected, atol=1e-4)


@pytest.mark.parametrize("kernel", ["rbf", "sigmoid"])
def test_conditions_hold_after_many_rounds(spark, kernel):
    """Rounds of 40 points: the conditions are checked on all rows, by hand."""
    x, y = cloud(200, 5)
    table = as_table(spark, x, y)
    machine = fit_kernel_machine(table, kernel, 2.0, 0.1, working_set=40)
    assert machine.rounds > 1 and machine.gap < 1e-3
    weight = {tuple(v): w for v, w in zip(np.round(machine.vectors, 2).tolist(), machine.weights)}
    points = {}
    for p, label in zip(x.tolist(), y):
        key = tuple(p)
        points[key] = (2 * label - 1, points.get(key, (0, 0))[1] + 1)
    keys = list(points)
    sign = np.array([points[k][0] for k in keys])
    cap = np.array([2.0 * points[k][1] for k in keys])
    a = np.array([weight.get(k, 0.0) for k in keys]) * sign
    assert (a >= 0).all() and (a <= cap).all() and abs(a @ sign) < 1e-9
    at = np.array(keys)
    value = sign - kernel_values(at, at, kernel, 0.1) @ (a * sign)
    rise = np.where(sign > 0, a < cap, a > 0)
    fall = np.where(sign > 0, a > 0, a < cap)
    assert value[rise].max() - value[fall].min() < 1.1e-3


def test_layout_does_not_matter(spark):
    x, y = cloud(150, 7)
    table = as_table(spark, x, y)
    one = fit_kernel_machine(table.coalesce(1), "rbf", 1.0, 0.5, tolerance=1e-7)
    seven = fit_kernel_machine(table.repartition(7), "rbf", 1.0, 0.5, tolerance=1e-7, working_set=60)
    rows = table.select(one.margin().alias("a"), seven.margin().alias("b")).collect()
    assert np.allclose([r["a"] for r in rows], [r["b"] for r in rows], atol=1e-5)


def test_bounds_and_one_class(spark):
    x, y = cloud(60)
    table = as_table(spark, x, y)
    with pytest.raises(ValueError, match="support vectors"):
        fit_kernel_machine(table, "rbf", max_support=3)
    with pytest.raises(RuntimeError, match="rounds"):
        fit_kernel_machine(table, "rbf", working_set=2, max_rounds=1)
    alone = fit_kernel_machine(table.filter("label = 1"), "rbf")
    assert len(alone.weights) == 0 and table.select(alone.margin().alias("m")).count() == len(y)
    assert fit_kernel_machine(table.limit(0), "rbf", gamma=1.0).offset == 0.0
    with pytest.raises(ValueError, match="Unknown kernel"):
        fit_kernel_machine(table, "cubic")


def test_votes_of_three_classes(spark):
    """Every pair's margin is that of all pairs of rows; votes are counted, the first wins."""
    x, _ = cloud(120, 11)
    y = np.digitize(x[:, 0] + 0.3 * x[:, 1], [-0.5, 0.5]).astype(float)
    table = as_table(spark, x, y)
    votes = fit_kernel_votes(table, ["a", "b", "c"], "rbf", 1.0)
    rows = {r["_key"]: r for r in votes.score(table).collect()}
    gamma = 1.0 / (3 * x.var())
    tally = np.zeros((len(y), 3))
    for (i, j), machine in votes.machines.items():
        assert machine.gamma == pytest.approx(gamma)
        value = kernel_values(x, machine.vectors, "rbf", gamma) @ machine.weights - machine.offset
        tally[:, i] += value > 0
        tally[:, j] += value <= 0
    assert [rows[i]["prediction"] for i in range(len(y))] == tally.argmax(axis=1).tolist()
    assert all(sum(r["probability"]) == pytest.approx(1.0) for r in rows.values())
    assert np.mean(tally.argmax(axis=1) == y) > 0.9


def test_through_the_registry(spark):
    x, y = cloud(120, 13)
    rows = [(i, *map(float, p), "yes" if b else "no") for i, (p, b) in enumerate(zip(x, y))]
    people = spark.createDataFrame(rows, "id long, a double, b double, c double, t string")
    trained = training.train_classifier(
        people, ["a", "b", "c"], "t", "Support Vector Machine", {"kernel": "rbf", "solver": "exact"}, ["id"]
    )
    assert trained.scores.first()["test_score"] > 0.6
