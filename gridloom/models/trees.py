"""Exact decision trees, bootstrapped forests and boosted trees, grown level by level.

Every cut between two neighbouring values of a feature is a candidate; there are no bins. A
node with many rows is searched by the whole cluster: rows are added up per node, feature and
value, running sums over the sorted values give both sides of every cut, and the best cut of
each feature comes to the driver. A node of at most ``LOCAL_ROWS`` rows is finished by one
task, with the same rule on sorted arrays. So the distributed levels are about as many as the
rows can be halved down to that size.

Rows of a tree at the same point are added up before the first level: a search needs only
sums of weights and targets per value. Where most points are different nothing is added up.

The target is a vector: class membership or a number. Gini impurity is the variance of class
membership, so both are the same search; entropy has its own loss. Gains are compared after
rounding to nine digits, and equal ones go to the smaller feature, then the smaller value:
neither the layout nor the order of sums decides.
"""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.ordering import running_sums
from ..functions.storage import cut_lineage

# A node of at most so many rows is finished in one task.
LOCAL_ROWS = 100_000
# A model lives on the driver and in every task; one with more nodes is refused.
MAX_NODES = 2_000_000
# Trees of a forest grown side by side: each has a copy of two thirds of the rows.
TREES_AT_ONCE = 20
# A table of so few splits is broadcast when rows are sent down.
BROADCAST_SPLITS = 50_000
# Rows that one task draws for a forest: each becomes a row per tree.
ROWS_PER_TASK = 50_000
# Rows are added up per point where there are at most so many points a row.
POINTS_PER_ROW = 0.5


@dataclass(frozen=True)
class Rule:
    """When a node is cut, and where candidates are looked for."""

    max_depth: int | None = None
    min_rows: int = 2
    criterion: str = "variance"
    # So many features that vary, in an order drawn per node; None: all of them.
    subset: int | None = None
    seed: int = 0


@dataclass
class Trees:
    """Nodes of all trees as arrays; ``feature`` is -1 at a leaf. ``roots`` has each tree's first."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    roots: np.ndarray

    def leaves(self, x: np.ndarray, root: int) -> np.ndarray:
        """Node that each row of ``x`` ends in."""
        at = np.full(len(x), root, np.int64)
        going = np.flatnonzero(self.feature[at] >= 0)
        while len(going):
            node = at[going]
            lower = x[going, self.feature[node]] <= self.threshold[node]
            at[going] = np.where(lower, self.left[node], self.right[node])
            going = going[self.feature[at[going]] >= 0]
        return at

    def mean(self, x: np.ndarray) -> np.ndarray:
        """Mean of the trees' answers, a row per row of ``x``."""
        return sum(self.value[self.leaves(x, r)] for r in self.roots) / len(self.roots)

    def importances(self, width: int) -> np.ndarray:
        """Loss that the cuts of each feature take away, each tree scaled to one, then all."""
        total, inner = np.zeros(width), np.flatnonzero(self.feature >= 0)
        tree = np.searchsorted(self.roots, inner, side="right") - 1
        for t in np.unique(tree):
            own = np.bincount(self.feature[inner[tree == t]], self.gain[inner[tree == t]], width)
            total += own / own.sum() if own.sum() > 0 else own
        return total / total.sum() if total.sum() > 0 else total


def _loss(criterion: str, n, sums, squares):
    """Loss of nodes with weight ``n``, target sums (last axis) and summed squares."""
    if criterion == "entropy":
        with np.errstate(divide="ignore", invalid="ignore"):
            log = lambda v: np.where(v > 0, v * np.log(np.where(v > 0, v, 1)), 0.0)
            return log(n) - log(sums).sum(axis=-1)
    return squares - (sums * sums).sum(axis=-1) / n


def _child_key(key: str, side: str) -> str:
    return hashlib.md5(f"{key}{side}".encode()).hexdigest()


def feature_order(rule: Rule, key: str, width: int) -> list[int]:
    """Features in the order in which a node looks at them."""
    if rule.subset is None:
        return list(range(width))
    return sorted(range(width), key=lambda j: (hashlib.md5(f"{rule.seed}-{key}-{j}".encode()).hexdigest(), j))


def _chosen(rule: Rule, key: str, width: int, found: dict[int, tuple]) -> tuple | None:
    """Best of the candidates ``feature -> (gain, value, next value)`` that the node may use."""
    most = rule.subset or width
    allowed = [j for j in feature_order(rule, key, width) if j in found][:most]
    if not allowed:
        return None
    j = min(allowed, key=lambda j: (-found[j][0], j))
    gain, value, after = found[j]
    middle = value / 2 + after / 2
    return j, (middle if value <= middle < after else value), gain


def _is_leaf(rule: Rule, depth: int, rows: int, loss: float, squares: float) -> bool:
    if rule.max_depth is not None and depth >= rule.max_depth:
        return True
    return rows < max(2, rule.min_rows) or loss <= 1e-12 * max(squares, 1e-300)


def grow_here(x, c, n, q, s, d, rule: Rule, depth: int, key: str) -> dict[str, list]:
    """The subtree over these points, as lists of nodes; the first is its root.

    A point has ``c`` rows of weight ``n``, sums ``s`` of targets (a row a point) and ``q`` of
    their squares, and ``d``, what leaf sums are divided by.
    """
    nodes: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "right", "value", "gain")}
    width = x.shape[1]

    def add(rows: np.ndarray) -> int:
        below = d[rows].sum()
        value = s[rows].sum(axis=0) / below if abs(below) > 1e-150 else np.zeros(s.shape[1])
        for name, v in (("feature", -1), ("threshold", 0.0), ("left", -1), ("right", -1), ("value", value.tolist()), ("gain", 0.0)):
            nodes[name].append(v)
        return len(nodes["feature"]) - 1

    todo = [(add(np.arange(len(x))), np.arange(len(x)), depth, key)]
    while todo:
        at, rows, level, name = todo.pop()
        weight, sums, squares = n[rows].sum(), s[rows].sum(axis=0), q[rows].sum()
        loss = float(_loss(rule.criterion, weight, sums, squares))
        if _is_leaf(rule, level, c[rows].sum(), loss, squares):
            continue
        found, looked = {}, 0
        for j in feature_order(rule, name, width):
            order = rows[np.argsort(x[rows, j], kind="stable")]
            v = x[order, j]
            cuts = np.flatnonzero(v[:-1] < v[1:])
            if not len(cuts):
                continue
            below, part, square = np.cumsum(n[order])[cuts], np.cumsum(s[order], axis=0)[cuts], np.cumsum(q[order])[cuts]
            children = _loss(rule.criterion, below, part, square) + _loss(rule.criterion, weight - below, sums - part, squares - square)
            gains = np.round(1 - children / loss, 9)
            best = int(np.argmax(gains))
            found[j] = (float(gains[best]), float(v[cuts[best]]), float(v[cuts[best] + 1]))
            looked += 1
            if looked == rule.subset:
                break
        cut = _chosen(rule, name, width, found)
        if cut is None:
            continue
        j, threshold, gain = cut
        lower = x[rows, j] <= threshold
        sides = [(add(rows[lower]), rows[lower], "l"), (add(rows[~lower]), rows[~lower], "r")]
        nodes["feature"][at], nodes["threshold"][at], nodes["gain"][at] = j, threshold, gain * loss
        nodes["left"][at], nodes["right"][at] = sides[0][0], sides[1][0]
        todo += [(i, some, level + 1, _child_key(name, side)) for i, some, side in sides]
    return nodes


_GROWN = (
    "node bigint, feature array<int>, threshold array<double>, left array<int>, right array<int>, "
    "value array<array<double>>, gain array<double>"
)


def _finish(rows: DataFrame, small: dict[int, tuple[int, str]], rule: Rule) -> list:
    """Subtrees of the nodes in ``small`` (node -> depth, key), each grown by one task."""

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        node = int(group["node"].iloc[0])
        depth, key = small[node]
        x, s = np.stack(group["x"].to_numpy()), np.stack(group["s"].to_numpy())
        got = grow_here(x, *(group[k].to_numpy(float) for k in "cnq"), s, group["d"].to_numpy(float), rule, depth, key)
        return pd.DataFrame({"node": [node], **{k: [v] for k, v in got.items()}})

    return rows.groupBy("node").applyInPandas(grow, _GROWN).collect()


def _sums(rows: DataFrame, points: bool) -> DataFrame:
    """``node, x, c, n, q, s, d`` of ``node, x, y, w, h``: what the search needs, per point or row."""
    square = F.col("w") * F.aggregate("y", F.lit(0.0), lambda a, v: a + v * v)
    if not points:
        return rows.select(
            "node", "x", F.lit(1).cast("bigint").alias("c"), F.col("w").alias("n"), square.alias("q"),
            F.transform("y", lambda v: v * F.col("w")).alias("s"), (F.col("w") * F.col("h")).alias("d"),
        )
    first = rows.select("y").first()
    targets = [F.sum(F.col("w") * F.get("y", F.lit(i))) for i in range(len(first.y) if first else 0)]
    return rows.groupBy("node", "x").agg(
        F.count("*").alias("c"), F.sum("w").alias("n"), F.sum(square).alias("q"),
        F.array(*targets).alias("s"), F.sum(F.col("w") * F.col("h")).alias("d"),
    )


def _few_points(rows: DataFrame) -> bool:
    """Whether rows share their points so often that adding them up saves work."""
    seen, points = rows.agg(F.count("*"), F.approx_count_distinct(F.xxhash64("x"))).first()
    return points <= POINTS_PER_ROW * seen


def _best_cuts(rows: DataFrame, targets: int, criterion: str, losses: dict[int, float]) -> dict:
    """``node -> feature -> (gain, value, next value)`` of the best cut of each feature."""
    sums = ["c", "n", "q", *[f"s{i}" for i in range(targets)]]
    flat = rows.select(
        "node", F.posexplode("x").alias("j", "v"), "c", "n", "q", *[F.get("s", F.lit(i)).alias(f"s{i}") for i in range(targets)],
    )
    counted = cut_lineage(flat.groupBy("node", "j", "v").agg(*[F.sum(s).alias(s) for s in sums]))
    running = running_sums(counted, ["node", "j"], ["v"], sums, counted.count())

    def side(n: Column, q: Column, s: list[Column]) -> Column:
        if criterion == "entropy":
            log = lambda v: F.when(v > 0, v * F.log(v)).otherwise(F.lit(0.0))
            return log(n) - sum((log(v) for v in s), F.lit(0.0))
        return q - sum((v * v for v in s), F.lit(0.0)) / n

    under = {s: F.col(f"cum_{s}") for s in sums}
    over = {s: F.col(f"all_{s}") - F.col(f"cum_{s}") for s in sums}
    parts = [side(d["n"], d["q"], [d[f"s{i}"] for i in range(targets)]) for d in (under, over)]
    cuts = running.filter(F.col("cum_c") < F.col("all_c"))
    spark = rows.sparkSession
    whole = spark.createDataFrame(list(losses.items()), "node bigint, loss double")
    whole = F.broadcast(whole) if len(losses) <= BROADCAST_SPLITS else whole
    cuts = cuts.join(whole, "node").withColumn("gain", F.round(1 - (parts[0] + parts[1]) / F.col("loss"), 9))
    best = cuts.groupBy("node", "j").agg(F.max(F.struct("gain", (-F.col("v")).alias("m"))).alias("b"))
    best = cut_lineage(best.select("node", "j", F.col("b.gain").alias("gain"), (-F.col("b.m")).alias("at")))
    above = counted.join(best, ["node", "j"]).filter(F.col("v") > F.col("at"))
    found: dict = defaultdict(dict)
    for r in above.groupBy("node", "j", "gain", "at").agg(F.min("v").alias("after")).collect():
        found[r.node][r.j] = (r.gain, r["at"], r.after)
    return found


def grow(
    rows: DataFrame, roots: dict[int, str], rule: Rule, local_rows: int = LOCAL_ROWS, sizes: dict | None = None, points: bool = False
) -> Trees:
    """Trees over rows of ``tree, x, y, w, h``: features, targets, weight, divisor of leaf sums.

    Trees are numbered from 0. ``roots`` gives each one's key, from which its nodes draw their
    features; ``sizes`` are the numbers of rows, if they are known; with ``points`` rows at the
    same point are added up first. A tree without rows answers like the others' roots on average.
    """
    spark = rows.sparkSession
    columns: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "right", "value", "gain")}

    def add() -> int:
        for k, v in (("feature", -1), ("threshold", 0.0), ("left", -1), ("right", -1), ("value", None), ("gain", 0.0)):
            columns[k].append(v)
        if len(columns["feature"]) > MAX_NODES:
            raise ValueError(f"The trees have more than {MAX_NODES:,} nodes; set `max_depth`.")
        return len(columns["feature"]) - 1

    order = sorted(roots)
    open_nodes = {add(): (0, roots[t]) for t in order}
    places = dict(zip(order, open_nodes))
    rows = rows.withColumn("node", F.col("tree").cast("bigint"))
    rows = _sums(rows, points)
    known = {places[t]: n for t, n in (sizes or {}).items()}
    if not known or max(known.values()) > local_rows:
        rows, known = cut_lineage(rows), {}
    while open_nodes:
        targets = 0
        if known:
            stats = {}
        else:
            first = rows.select("s").first()
            targets = len(first.s) if first else 0
            totals = [F.sum(F.get("s", F.lit(i))).alias(f"s{i}") for i in range(targets)]
            held = [F.sum(k).alias(k) for k in ("c", "n", "q", "d")]
            stats = {r.node: r for r in rows.groupBy("node").agg(F.count("*").alias("held"), *held, *totals).collect()}
            known = {node: r.held for node, r in stats.items()}
        small = {node: at for node, at in open_nodes.items() if known.get(node, 0) <= local_rows}
        if small:
            few = rows if len(small) == len(open_nodes) else rows.join(
                F.broadcast(spark.createDataFrame([(n,) for n in small], "node bigint")), "node", "left_semi"
            )
            for r in sorted(_finish(few, small, rule), key=lambda r: r.node):
                base = [r.node, *[add() for _ in r.feature[1:]]]
                for i, at in enumerate(base):
                    columns["feature"][at], columns["threshold"][at] = r.feature[i], r.threshold[i]
                    columns["value"][at], columns["gain"][at] = r.value[i], r.gain[i]
                    if r.feature[i] >= 0:
                        columns["left"][at], columns["right"][at] = base[r.left[i]], base[r.right[i]]
        large, losses = {n: at for n, at in open_nodes.items() if n not in small}, {}
        for node, (depth, _) in large.items():
            r = stats[node]
            sums = np.array([r[f"s{i}"] for i in range(targets)])
            loss = float(_loss(rule.criterion, r.n, sums, r.q))
            columns["value"][node] = (sums / r.d if abs(r.d) > 1e-150 else np.zeros(targets)).tolist()
            if not _is_leaf(rule, depth, r.c, loss, r.q):
                losses[node] = loss
        open_nodes, splits = {}, []
        if losses:
            width = len(rows.select("x").first().x)
            wanted = spark.createDataFrame([(n,) for n in losses], "node bigint")
            cuts = _best_cuts(rows.join(F.broadcast(wanted), "node", "left_semi"), targets, rule.criterion, losses)
            for node, loss in losses.items():
                depth, key = large[node]
                cut = _chosen(rule, key, width, cuts.get(node, {}))
                if cut is None:
                    continue
                left, right = add(), add()
                columns["feature"][node], columns["threshold"][node], columns["gain"][node] = cut[0], cut[1], cut[2] * loss
                columns["left"][node], columns["right"][node] = left, right
                open_nodes[left], open_nodes[right] = (depth + 1, _child_key(key, "l")), (depth + 1, _child_key(key, "r"))
                splits.append((node, cut[0], cut[1], left, right))
        if splits:
            down = spark.createDataFrame(splits, "node bigint, j int, threshold double, l bigint, r bigint")
            down = F.broadcast(down) if len(splits) <= BROADCAST_SPLITS else down
            lower = F.get("x", F.col("j")) <= F.col("threshold")
            rows = rows.join(down, "node").select(F.when(lower, F.col("l")).otherwise(F.col("r")).alias("node"), "x", "c", "n", "q", "s", "d")
            rows, known = cut_lineage(rows), {}
    seen = [columns["value"][places[t]] for t in order if columns["value"][places[t]] is not None]
    if not seen:
        raise ValueError("There are no rows to learn from.")
    columns["value"] = [np.mean(seen, axis=0).tolist() if v is None else v for v in columns["value"]]
    return Trees(
        np.array(columns["feature"], np.int32), np.array(columns["threshold"]), np.array(columns["left"], np.int32),
        np.array(columns["right"], np.int32), np.array(columns["value"], float).reshape(len(columns["feature"]), -1),
        np.array(columns["gain"]), np.array([places[t] for t in order]),
    )


# Cumulative Poisson probabilities for a mean of one, up to 1 - 1e-16.
POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(18)]).tolist()


def bootstrap(train: DataFrame, trees: list[int], seed: int) -> DataFrame:
    """Each row as often as a resampling of the table would draw it, per tree: ``w``.

    Poisson numbers from 32 bits of md5 over the row's key, the seed and the tree, so they
    do not depend on the layout. Rows that are not drawn are left out.
    """
    def u(tree: int) -> Column:
        text = F.concat_ws("-", F.col("_key").cast("string"), F.lit(str(seed)), F.lit(str(tree)))
        return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") + 0.5) / float(1 << 32)

    # As arrays, so that no hash is worked out again for each number it is compared with.
    drawn = F.transform(F.array(*map(u, trees)), lambda u: sum(((u >= p).cast("double") for p in POISSON), F.lit(0.0)))
    each = train.select("*", F.posexplode(drawn).alias("_place", "w")).filter("w > 0")
    return each.withColumn("tree", F.get(F.array(*map(F.lit, trees)), F.col("_place"))).drop("_place")


def _rows(train: DataFrame, classes: list | None) -> DataFrame:
    """``_key, x, y, h``: class membership or the number itself as targets."""
    label = F.col("label").cast("double")
    targets = [label] if classes is None else [(label == float(i)).cast("double") for i in range(len(classes))]
    return train.select("_key", vector_to_array("features").alias("x"), F.array(*targets).alias("y"), F.lit(1.0).alias("h"))


def _answers(df: DataFrame, function: Callable, classes: list | None) -> DataFrame:
    """``df`` without ``features``, with what ``function`` makes of the feature matrix."""

    @F.pandas_udf("array<double>")
    def answer(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series(list(function(np.stack(part.to_numpy()))) if len(part) else [], dtype=object)

    scored = df.withColumn("_answer", answer(vector_to_array("features")))
    kept = [F.col(f"`{c}`") for c in df.columns if c != "features"]
    if classes is None:
        return scored.select(*kept, F.get("_answer", F.lit(0)).alias("prediction"))
    best = F.array_position("_answer", F.array_max("_answer")) - 1
    return scored.select(*kept, best.cast("double").alias("prediction"), F.col("_answer").alias("probability"))


@dataclass
class TreeModel:
    """One tree, or the mean of several."""

    trees: Trees
    classes: list | None
    width: int

    def score(self, df: DataFrame) -> DataFrame:
        return _answers(df, self.trees.mean, self.classes)

    @property
    def weights(self) -> np.ndarray:
        return self.trees.importances(self.width)


def _width(train: DataFrame) -> int:
    first = train.select("features").first()
    return len(first.features) if first else 0


def fit_tree(train: DataFrame, classes: list | None, rule: Rule, local_rows: int = LOCAL_ROWS) -> TreeModel:
    rows = _rows(train, classes).select(F.lit(0).alias("tree"), "x", "y", F.lit(1.0).alias("w"), "h")
    return TreeModel(grow(rows, {0: "0"}, rule, local_rows, points=_few_points(rows)), classes, _width(train))


def _joined(parts: list[Trees]) -> Trees:
    shift = np.cumsum([0, *[len(p.feature) for p in parts]])
    both = {k: np.concatenate([getattr(p, k) for p in parts]) for k in ("feature", "threshold", "value", "gain")}
    moved = {
        k: np.concatenate([np.where(getattr(p, k) >= 0, getattr(p, k) + s, -1) for p, s in zip(parts, shift)])
        for k in ("left", "right")
    }
    return Trees(**both, **moved, roots=np.concatenate([p.roots + s for p, s in zip(parts, shift)]))


def fit_forest(
    train: DataFrame, classes: list | None, trees: int, rule: Rule, local_rows: int = LOCAL_ROWS, at_once: int = TREES_AT_ONCE
) -> TreeModel:
    """Trees over resampled rows; a class forest looks at ``rule.subset`` features per node."""
    # Every row is drawn for every tree: no task gets many, however few parts the input has.
    rows = cut_lineage(_rows(train, classes).repartition(train.count() // ROWS_PER_TASK + 1))
    points, parts = _few_points(rows), []
    for start in range(0, trees, at_once):
        some = list(range(start, min(start + at_once, trees)))
        drawn = bootstrap(rows, some, rule.seed).select((F.col("tree") - start).alias("tree"), "x", "y", "w", "h")
        part = grow(drawn, {t - start: str(t) for t in some}, rule, local_rows, points=points)
        # Nodes of trees grown side by side lie between each other; importances need them apart.
        parts += _split(part)
        if sum(len(p.feature) for p in parts) > MAX_NODES:
            raise ValueError(f"The forest has more than {MAX_NODES:,} nodes; set `max_depth` or grow fewer trees.")
    return TreeModel(_joined(parts), classes, _width(train))


def _split(trees: Trees) -> list[Trees]:
    """Each tree by itself, its root first."""
    out = []
    for root in trees.roots:
        order, todo = [], [int(root)]
        while todo:
            at = todo.pop()
            order.append(at)
            if trees.feature[at] >= 0:
                todo += [int(trees.right[at]), int(trees.left[at])]
        to = {at: i for i, at in enumerate(order)}
        move = lambda a: np.array([to.get(int(v), -1) for v in a[order]], np.int32)
        out.append(Trees(
            trees.feature[order], trees.threshold[order], move(trees.left), move(trees.right),
            trees.value[order], trees.gain[order], np.array([0]),
        ))
    return out


@dataclass
class Boosting:
    """A start and stages of trees, one per score; ``classes`` None gives numbers."""

    start: np.ndarray
    stages: list[Trees]
    rate: float
    classes: list | None
    width: int

    def raw(self, x: np.ndarray) -> np.ndarray:
        scores = np.tile(self.start, (len(x), 1))
        for trees in self.stages:
            for k, root in enumerate(trees.roots):
                scores[:, k] += self.rate * trees.value[trees.leaves(x, root), 0]
        return scores

    def shares(self, raw: np.ndarray) -> np.ndarray:
        """Probabilities in class order, or the number itself."""
        if self.classes is None:
            return raw
        if len(self.classes) == 2:
            p = 1 / (1 + np.exp(-raw[:, 0]))
            return np.stack([1 - p, p], axis=1)
        e = np.exp(raw - raw.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def score(self, df: DataFrame) -> DataFrame:
        return _answers(df, lambda x: self.shares(self.raw(x)), self.classes)

    @property
    def weights(self) -> np.ndarray:
        total = np.zeros(self.width)
        for trees in self.stages:
            for tree in _split(trees):
                total += np.bincount(tree.feature[tree.feature >= 0], tree.gain[tree.feature >= 0], self.width)
        return total / total.sum() if total.sum() > 0 else total


# Scores of so many stages are worked out again from the features, then written.
STAGES_HELD = 20


def fit_boosting(
    train: DataFrame, classes: list | None, stages: int, rate: float, rule: Rule, local_rows: int = LOCAL_ROWS
) -> Boosting:
    """Trees on what is left to explain, each shrunk by ``rate``.

    Numbers: the start is the mean, a stage fits the residuals. Two classes: the start is the
    log odds of the second, a stage fits ``y - p``, a leaf is one Newton step. More classes:
    the start is the log shares, a stage grows one tree a class on the gradients of their
    joint softmax, with a Newton step scaled by (K - 1) / K.
    """
    base = _rows(train, classes).select("x", F.col("y").alias("target"))
    kinds = 1 if classes is None else len(classes)
    scores = kinds if kinds > 2 else 1
    base = cut_lineage(base.withColumn("raw", F.array().cast("array<double>")))
    first = base.agg(F.count("*").alias("n"), *[F.avg(F.get("target", F.lit(i))).alias(f"m{i}") for i in range(kinds)]).first()
    if not first.n:
        raise ValueError("There are no rows to learn from.")
    shares = np.array([first[f"m{i}"] for i in range(kinds)])
    if classes is None:
        start = shares
    else:
        logs = np.log(np.clip(shares, 1e-15, 1))
        start = np.array([logs[1] - logs[0]]) if kinds == 2 else logs if kinds > 2 else np.zeros(1)
    model = Boosting(start, [], rate, classes, _width(train))
    if kinds == 1 and classes is not None:
        return Boosting(np.array([0.0]), [], rate, classes, model.width)
    scale = (kinds - 1) / kinds if kinds > 2 else 1.0
    written = 0

    def current(held: int) -> Boosting:
        return Boosting(np.zeros(scores) if held else start, model.stages[held:], rate, classes, model.width)

    for _ in range(stages):
        if len(model.stages) - written >= STAGES_HELD:
            base, written = cut_lineage(_with_raw(base, current(written))), len(model.stages)
        rows = _gradients(base, current(written), kinds, scores, scale)
        sizes = {k: first.n for k in range(scores)}
        model.stages.append(grow(rows, {k: str(k) for k in range(scores)}, rule, local_rows, sizes))
    return model


def _raw(part: pd.DataFrame, model: Boosting) -> np.ndarray:
    added = model.raw(np.stack(part["x"].to_numpy()))
    before = part["raw"].to_numpy()
    return added + np.stack(before) if len(before[0]) else added


def _with_raw(base: DataFrame, model: Boosting) -> DataFrame:
    def add(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if len(part):
                yield part.assign(raw=list(_raw(part, model)))

    return base.mapInPandas(add, base.schema)


def _gradients(base: DataFrame, model: Boosting, kinds: int, scores: int, scale: float) -> DataFrame:
    """``tree, x, y, w, h``: a row per row and score, gradient and curvature of the loss."""

    def step(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if not len(part):
                continue
            raw, target = _raw(part, model), np.stack(part["target"].to_numpy())
            p = model.shares(raw)
            for k in range(scores):
                if model.classes is None:
                    left, curve = target[:, 0] - p[:, 0], np.ones(len(part))
                else:
                    c = 1 if kinds == 2 else k
                    left, curve = target[:, c] - p[:, c], p[:, c] * (1 - p[:, c]) / scale
                yield pd.DataFrame({"tree": k, "x": part["x"], "y": [[v] for v in left], "w": 1.0, "h": curve})

    return base.mapInPandas(step, "tree int, x array<double>, y array<double>, w double, h double")
