"""Registered queries over exact trees, forests and boosting, several levels and stages deep.

Their twins grow the same trees in SQL: every cut between neighbouring values of every
feature in every node, level by level.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..models import training
from ..models.trees import POISSON
from ._registry import hash_sql, query, rnd, table
from .cleaning import split_sql


def tree_sql(
    name: str, train: str, rows: str, features: list[str], targets: int, depth: int,
    min_rows: int = 2, criterion: str = "variance", subset: int | None = None, seed: int = 42,
) -> str:
    """CTEs that grow a tree per ``k``; ``{name}_p`` has ``id, k, v0, ...`` for ``rows``.

    ``train`` has ``id, k, <features>, y0, ..., w, h``; ``rows`` has ``id, k, <features>``.
    """
    ys = range(targets)
    if criterion == "entropy":
        log = "CASE WHEN {0} > 0 THEN {0} * ln({0}) ELSE 0 END"
        loss = lambda p: "(" + log.format(f"{p}n") + "".join(f" - {log.format(f'{p}s{i}')}" for i in ys) + ")"
    else:
        loss = lambda p: f"({p}q - ({' + '.join(f'{p}s{i} * {p}s{i}' for i in ys)}) / {p}n)"
    sums = ["c", "n", "q", *[f"s{i}" for i in ys]]
    value = "CASE j " + " ".join(f"WHEN {j} THEN {f}" for j, f in enumerate(features)) + " END"
    out = [f"{name}_n0 AS (SELECT *, k::VARCHAR AS node FROM {train})", f"{name}_m0 AS (SELECT *, k::VARCHAR AS node FROM {rows})"]
    for level in range(depth):
        a, n = f"{name}_", level
        each = " UNION ALL ".join(f"SELECT k, node, {j} AS j, {f}::DOUBLE AS v, w, {', '.join(f'y{i}' for i in ys)} FROM {a}n{n}" for j, f in enumerate(features))
        square = " + ".join(f"y{i} * y{i}" for i in ys)
        out.append(f"""{a}l{n} AS (SELECT k, node, j, v, count(*)::DOUBLE AS c, sum(w) AS n, sum(w * ({square})) AS q,
            {', '.join(f'sum(w * y{i}) AS s{i}' for i in ys)} FROM ({each}) GROUP BY ALL)""")
        out.append(f"""{a}r{n} AS (SELECT k, node, j, v, lead(v) OVER o AS nv, {', '.join(f'sum({s}) OVER o AS u_{s}, sum({s}) OVER g - sum({s}) OVER o AS o_{s}, sum({s}) OVER g AS a_{s}' for s in sums)}
            FROM {a}l{n} WINDOW o AS (PARTITION BY k, node, j ORDER BY v), g AS (PARTITION BY k, node, j))""")
        out.append(f"""{a}g{n} AS (SELECT k, node, j, v, nv, round(1 - ({loss('u_')} + {loss('o_')}) / {loss('a_')}, 9) AS gain
            FROM {a}r{n} WHERE nv IS NOT NULL AND a_c >= {min_rows} AND {loss('a_')} > 1e-12 * a_q)""")
        held = f"{a}g{n}"
        if subset:
            held = f"{a}h{n}"
            out.append(f"""{held} AS (SELECT * FROM {a}g{n} SEMI JOIN (SELECT k, node, j FROM (SELECT DISTINCT k, node, j FROM {a}g{n})
            QUALIFY row_number() OVER (PARTITION BY k, node ORDER BY md5('{seed}-' || node || '-' || j), j) <= {subset}) USING (k, node, j))""")
        out.append(f"""{a}c{n} AS (SELECT k, node, j, v / 2 + nv / 2 AS cut FROM {held}
            QUALIFY row_number() OVER (PARTITION BY k, node ORDER BY gain DESC, j, v) = 1)""")
        for t in "nm":
            out.append(f"""{a}{t}{n + 1} AS (SELECT t.* EXCLUDE (node), CASE WHEN cut IS NULL THEN t.node ELSE md5(t.node || CASE WHEN {value} <= cut THEN 'l' ELSE 'r' END) END AS node
            FROM {a}{t}{n} t LEFT JOIN {a}c{n} c ON t.k = c.k AND t.node = c.node)""")
    leaves = ", ".join(f"sum(w * y{i}) / sum(w * h) AS v{i}" for i in ys)
    out.append(f"{name}_v AS (SELECT k, node, {leaves} FROM {name}_n{depth} GROUP BY ALL)")
    out.append(f"{name}_p AS (SELECT id, k, {', '.join(f'v{i}' for i in ys)} FROM {name}_m{depth} JOIN {name}_v USING (k, node))")
    return ",\n        ".join(out)


# Orders: which status, by price and a number scattered over the customers. Parts: what price, by size and a residue of the key.
STATES, STATE_FEATURES = ["F", "O", "P"], ["o_totalprice", "far"]
FAR = "o_custkey * o_custkey * 7919 % 10000019"
PLACED = f"placed AS (SELECT *, {FAR} AS far FROM orders)"
PRICE_FEATURES = ["p_size", "turn"]
PRICED = "priced AS (SELECT p_partkey, p_size, p_partkey % 40 AS turn, p_retailprice + p_size * p_size AS price FROM part)"
ONE_HOT = ", ".join(f"(o_orderstatus = '{c}')::INTEGER::DOUBLE AS y{i}" for i, c in enumerate(STATES))


def states(spark, sf, model, params) -> DataFrame:
    df = table(spark, sf, "orders").withColumn("far", F.expr(FAR))
    trained = training.train_classifier(df, STATE_FEATURES, "o_orderstatus", model, params, ["o_orderkey"])
    shares = [F.round(F.col("probability")[i], 6).alias(f"p_{c.lower()}") for i, c in enumerate(STATES)]
    return trained.predict(df, ["o_orderkey"]).select("o_orderkey", *shares)


def prices(spark, sf, model, params) -> DataFrame:
    price = (F.col("p_retailprice") + F.col("p_size") * F.col("p_size")).alias("price")
    df = table(spark, sf, "part").select("p_partkey", "p_size", F.pmod("p_partkey", F.lit(40)).alias("turn"), price)
    trained = training.train_regressor(df, PRICE_FEATURES, "price", model, params, ["p_partkey"])
    return rnd(trained.predict(df, ["p_partkey"]).select("p_partkey", "prediction"), 4, "prediction")


def state_rows(weights: str = "0 AS k, 1 AS w") -> str:
    """The training and all rows of the orders, for the generator."""
    return f"""{PLACED}, {split_sql('placed', 'o_orderkey')},
        train AS (SELECT o_orderkey AS id, {', '.join(STATE_FEATURES)}, {ONE_HOT}, 1::DOUBLE AS h, {weights} FROM s WHERE split = 'train'),
        rows AS (SELECT o_orderkey AS id, {', '.join(STATE_FEATURES)}, 0 AS k FROM placed)"""


def price_rows(weights: str = "0 AS k, 1 AS w") -> str:
    return f"""{PRICED}, {split_sql('priced', 'p_partkey')},
        train AS (SELECT p_partkey AS id, {', '.join(PRICE_FEATURES)}, price AS y0, 1::DOUBLE AS h, {weights} FROM s WHERE split = 'train'),
        rows AS (SELECT p_partkey AS id, {', '.join(PRICE_FEATURES)}, 0 AS k FROM priced)"""


def drawn_sql(trees: int, seed: int = 42) -> str:
    """Each training row as often as each tree has it, and all rows once a tree."""
    hashed = hash_sql("id").replace(f"'{seed}')", f"'{seed}', t::VARCHAR)")
    times = " + ".join(f"(({hashed} + 0.5) / 4294967296 >= {p!r}::DOUBLE)::INTEGER" for p in POISSON)
    return f"""drawn AS (SELECT * EXCLUDE (k, w, t), t AS k, ({times})::DOUBLE AS w FROM train, range({trees}) AS r(t) WHERE ({times}) > 0),
        every AS (SELECT * EXCLUDE (k, t), t AS k FROM rows, range({trees}) AS r(t))"""


SHARES = ", ".join(f"round(avg(v{i}), 6) AS p_{c.lower()}" for i, c in enumerate(STATES))


@query(
    "mod12_tree_levels",
    f"""
    WITH {state_rows()}, {tree_sql('t', 'train', 'rows', STATE_FEATURES, 3, 3, 40)}
    SELECT id AS o_orderkey, {SHARES} FROM t_p GROUP BY 1
    """,
)
def mod12_levels(spark, sf):
    return states(spark, sf, "Decision Tree", {"max_depth": 3, "min_samples_split": 40})


@query(
    "mod12_tree_entropy",
    f"""
    WITH {state_rows()}, {tree_sql('t', 'train', 'rows', STATE_FEATURES, 3, 3, criterion='entropy')}
    SELECT id AS o_orderkey, {SHARES} FROM t_p GROUP BY 1
    """,
)
def mod12_entropy(spark, sf):
    return states(spark, sf, "Decision Tree", {"max_depth": 3, "criterion": "entropy"})


@query(
    "mod13_forest_levels",
    f"""
    WITH {state_rows()}, {drawn_sql(5)}, {tree_sql('t', 'drawn', 'every', STATE_FEATURES, 3, 2, subset=1)}
    SELECT id AS o_orderkey, {SHARES} FROM t_p GROUP BY 1
    """,
)
def mod13_levels(spark, sf):
    """Five trees, each node looking at one of the two features."""
    return states(spark, sf, "Random Forest", {"n_estimators": 5, "max_depth": 2})


@query(
    "mod20_tree_levels",
    f"""
    WITH {price_rows()}, {tree_sql('t', 'train', 'rows', PRICE_FEATURES, 1, 3, 30)}
    SELECT id AS p_partkey, round(v0, 4) AS prediction FROM t_p
    """,
)
def mod20_levels(spark, sf):
    return prices(spark, sf, "Decision Tree Regressor", {"max_depth": 3, "min_samples_split": 30})


@query(
    "mod21_forest_levels",
    f"""
    WITH {price_rows()}, {drawn_sql(5)}, {tree_sql('t', 'drawn', 'every', PRICE_FEATURES, 1, 2)}
    SELECT id AS p_partkey, round(avg(v0), 4) AS prediction FROM t_p GROUP BY 1
    """,
)
def mod21_levels(spark, sf):
    return prices(spark, sf, "Random Forest Regressor", {"n_estimators": 5, "max_depth": 2})


def boosted_numbers_sql(stages: int, rate: float, depth: int) -> str:
    out = [price_rows(), "f0 AS (SELECT r.*, (SELECT avg(y0) FROM train) AS raw FROM rows r)"]
    for s in range(stages):
        out.append(f"b{s} AS (SELECT t.* EXCLUDE (y0), t.y0 - f.raw AS y0 FROM train t JOIN f{s} f USING (id))")
        out.append(tree_sql(f"t{s}", f"b{s}", "rows", PRICE_FEATURES, 1, depth))
        out.append(f"f{s + 1} AS (SELECT f.* EXCLUDE (raw), f.raw + {rate}::DOUBLE * v0 AS raw FROM f{s} f JOIN t{s}_p USING (id))")
    return f"WITH {', '.join(out)} SELECT id AS p_partkey, round(raw, 4) AS prediction FROM f{stages}"


@query("mod22_boosting_stages", boosted_numbers_sql(3, 0.3, 1))
def mod22_stages(spark, sf):
    return prices(spark, sf, "Gradient Boosting Regressor", {"n_estimators": 3, "learning_rate": 0.3, "max_depth": 1})


def boosted_classes_sql(stages: int, rate: float, depth: int) -> str:
    """A row per order and class; gradients of the joint softmax, Newton steps in the leaves."""
    k = len(STATES)
    features = ", ".join(STATE_FEATURES)
    kind = "CASE k " + " ".join(f"WHEN {i} THEN '{c}' END" if i == k - 1 else f"WHEN {i} THEN '{c}'" for i, c in enumerate(STATES))
    out = [
        PLACED, split_sql("placed", "o_orderkey"),
        f"f0 AS (SELECT o_orderkey AS id, split, {features}, k, (o_orderstatus = {kind})::INTEGER::DOUBLE AS y, "
        f"ln(avg((o_orderstatus = {kind})::INTEGER) FILTER (WHERE split = 'train') OVER (PARTITION BY k)) AS raw FROM s, range({k}) AS r(k))",
    ]
    for s in range(stages):
        out.append(f"p{s} AS (SELECT *, exp(raw) / sum(exp(raw)) OVER (PARTITION BY id) AS p FROM f{s})")
        out.append(f"b{s} AS (SELECT id, {features}, k, y - p AS y0, p * (1 - p) * {k} / {k - 1} AS h, 1 AS w FROM p{s} WHERE split = 'train')")
        out.append(f"e{s} AS (SELECT id, {features}, k FROM p{s})")
        out.append(tree_sql(f"t{s}", f"b{s}", f"e{s}", STATE_FEATURES, 1, depth))
        out.append(f"f{s + 1} AS (SELECT f.* EXCLUDE (raw), f.raw + {rate}::DOUBLE * v0 AS raw FROM f{s} f JOIN t{s}_p USING (id, k))")
    out.append(f"done AS (SELECT id, k, exp(raw) / sum(exp(raw)) OVER (PARTITION BY id) AS p FROM f{stages})")
    shares = ", ".join(f"round(max(p) FILTER (WHERE k = {i}), 6) AS p_{c.lower()}" for i, c in enumerate(STATES))
    return f"WITH {', '.join(out)} SELECT id AS o_orderkey, {shares} FROM done GROUP BY 1"


@query("mod17_boosting_classes", boosted_classes_sql(2, 0.3, 2))
def mod17_classes(spark, sf):
    """Three classes as one model, two stages."""
    return states(spark, sf, "Gradient Boosting", {"n_estimators": 2, "learning_rate": 0.3, "max_depth": 2})
