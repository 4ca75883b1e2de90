"""Registered queries over the exact kernel machine.

Each class is known by its first row alone, so a machine of two classes has two points and
its margin can be said in closed form: both variables are ``2 / (k11 + k22 - 2 k12)``, at
most C. Every row of the table is then scored by all three machines.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from ..models.kernel_machine import fit_kernel_machine
from ._registry import query, table

GAMMA, PENALTY = 0.5, 1.5
PAIRS = (("A", "N"), ("A", "R"), ("N", "R"))
_X1, _X2 = "(l_quantity / 10)", "(l_discount * 10)"


def kernel_sql(kernel: str, a: str, b: str) -> str:
    """The kernel of the points ``(a1, a2)`` and ``(b1, b2)``."""
    inner = f"({a}1 * {b}1 + {a}2 * {b}2)"
    if kernel == "poly":
        return f"(({GAMMA} * {inner}) ** 3)"
    if kernel == "sigmoid":
        return f"tanh({GAMMA} * {inner})"
    return f"exp(-{GAMMA} * (({a}1 - {b}1) ** 2 + ({a}2 - {b}2) ** 2))"


def margins_sql(kernel: str) -> str:
    k = lambda a, b: kernel_sql(kernel, a, b)
    names = [f"margin_{one}{other}".lower() for one, other in PAIRS]
    margins = ", ".join(
        f"round({name}.a * ({k(f'{name}.p', 'x.x')} - {k(f'{name}.n', 'x.x')}) - {name}.a * ({k(f'{name}.p', f'{name}.p')} - {k(f'{name}.n', f'{name}.n')}) / 2, 6) AS {name}"
        for name in names
    )
    fits = ", ".join(
        f"(SELECT * FROM fits WHERE one = '{one}' AND other = '{other}') AS {name}" for (one, other), name in zip(PAIRS, names)
    )
    votes = " ".join(
        f"WHEN {' AND '.join(f'{wins} >= {other}' for other in ('va', 'vn', 'vr') if other != wins)} THEN '{name}'"
        for wins, name in (("va", "A"), ("vn", "N"), ("vr", "R"))
    )
    return f"""
    WITH x AS (SELECT l_orderkey, l_linenumber, l_returnflag, ({_X1})::DOUBLE AS x1, ({_X2})::DOUBLE AS x2 FROM lineitem),
    firsts AS (SELECT l_returnflag AS flag, arg_min(x1, row(l_orderkey, l_linenumber, x1, x2)) AS x1, arg_min(x2, row(l_orderkey, l_linenumber, x1, x2)) AS x2 FROM x GROUP BY 1),
    pairs AS (SELECT p.flag AS one, n.flag AS other, p.x1 AS p1, p.x2 AS p2, n.x1 AS n1, n.x2 AS n2 FROM firsts p JOIN firsts n ON p.flag < n.flag),
    bends AS (SELECT *, {k('p', 'p')} + {k('n', 'n')} - 2 * {k('p', 'n')} AS bend FROM pairs),
    fits AS (SELECT *, CASE WHEN bend <= 0 THEN {PENALTY} ELSE least({PENALTY}, 2 / bend) END AS a FROM bends),
    wide AS (SELECT l_orderkey, l_linenumber, {margins} FROM x, {fits}),
    voted AS (SELECT *, (margin_an > 0)::INT + (margin_ar > 0)::INT AS va, (margin_an <= 0)::INT + (margin_nr > 0)::INT AS vn,
        (margin_ar <= 0)::INT + (margin_nr <= 0)::INT AS vr FROM wide)
    SELECT l_orderkey, l_linenumber, {', '.join(names)}, CASE {votes} END AS predicted FROM voted"""


def margins(spark, sf: str, kernel: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").withColumn("features", array_to_vector(F.array(F.expr(_X1), F.expr(_X2))))
    place = F.struct("l_orderkey", "l_linenumber", F.expr(_X1), F.expr(_X2))
    firsts = lines.groupBy("l_returnflag").agg(F.min_by("features", place).alias("features"))
    names = [f"margin_{one}{other}".lower() for one, other in PAIRS]
    scored, votes = lines, {flag: F.lit(0) for flag in "ANR"}
    for (one, other), name in zip(PAIRS, names):
        two = firsts.filter(F.col("l_returnflag").isin(one, other))
        two = two.select("features", (F.col("l_returnflag") == one).cast("double").alias("label"))
        machine = fit_kernel_machine(two, kernel, PENALTY, GAMMA, tolerance=1e-10)
        scored = scored.withColumn(name, F.round(machine.margin(), 6))
        votes[one] += (F.col(name) > 0).cast("int")
        votes[other] += (F.col(name) <= 0).cast("int")
    best = F.array_position(F.array(*votes.values()), F.greatest(*votes.values())).cast("int")
    return scored.select(
        "l_orderkey", "l_linenumber", *names,
        F.get(F.array(*map(F.lit, votes)), best - 1).alias("predicted"),
    )


@query("mod16_kernel_machine_rbf", margins_sql("rbf"))
def mod16_machine_rbf(spark, sf):
    return margins(spark, sf, "rbf")


@query("mod16_kernel_machine_poly", margins_sql("poly"))
def mod16_machine_poly(spark, sf):
    return margins(spark, sf, "poly")


@query("mod16_kernel_machine_sigmoid", margins_sql("sigmoid"))
def mod16_machine_sigmoid(spark, sf):
    return margins(spark, sf, "sigmoid")
