"""Exact linear-interpolated quantiles that stay exact on tables of any size.

Columns with a bounded number of distinct values are counted by value, and the counts
(one row per distinct value) are ranked. For the others a mergeable sketch brackets each
wanted rank, a counting scan proves the bracket, and the bracket is narrowed until what is
left inside is small enough to read exactly. Those scans shuffle nothing but their sums.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from .columns import as_number, col
from .ordering import WINDOW_ROWS, running_sums

DISTINCT_LIMIT = 250_000
SKETCH = 10_000
# Rows from which the first bracket is guessed; the guess is proved on all rows.
GUESS_ROWS = 200_000_000


@dataclass
class _Rank:
    """One wanted order statistic of one column, and the closed bracket around it."""

    column: str
    rank: int
    lo: float = 0.0
    hi: float = 0.0
    below: int = 0
    inner: int = 0
    slack: float = 2.0
    ready: bool = False
    value: float | None = None


def _neighbours(n: int, prob: float) -> tuple[int, int, float]:
    at = prob * (n - 1)
    low = min(int(math.floor(at)), n - 1)
    return low, min(low + 1, n - 1), at - low


def _marks(rank: int, n: int, slack: float, sketch: int, noise: float = 0.0) -> list[float]:
    """The two fractions whose sketched values should enclose the rank."""
    wide = (slack / sketch + noise) * n + 1
    return [min(1.0, max(0.0, (rank + s * wide) / n)) for s in (-1, 1)]


def _inner(x: Column, r: _Rank) -> Column:
    return F.when((x > F.lit(r.lo)) & (x < F.lit(r.hi)), x)


def column_quantiles(
    df: DataFrame,
    columns: list[str],
    probs: list[float],
    distinct_limit: int = DISTINCT_LIMIT,
    extra: list[Column] | None = None,
    sketch: int = SKETCH,
):
    """``{column: [quantile, ...]}`` (None for an all-null column) and the ``extra`` row.

    ``extra`` aggregates ride along with the first scan.
    """
    x = {c: as_number(df, c) for c in columns}
    aggs = list(extra or [])
    for i, c in enumerate(columns):
        aggs += [
            F.count(x[c]).alias(f"_n{i}"),
            F.approx_count_distinct(x[c]).alias(f"_d{i}"),
            F.min(x[c]).alias(f"_lo{i}"), F.max(x[c]).alias(f"_hi{i}"),
        ]
    if not aggs:
        return {}, None
    head = df.agg(*aggs).first()
    sizes = {c: head[f"_n{i}"] for i, c in enumerate(columns)}
    ends = {c: (head[f"_lo{i}"], head[f"_hi{i}"]) for i, c in enumerate(columns)}
    small = [c for i, c in enumerate(columns) if 0 < sizes[c] and head[f"_d{i}"] <= distinct_limit]
    large = [c for i, c in enumerate(columns) if head[f"_d{i}"] > distinct_limit]
    result: dict[str, list[float | None]] = {c: [None] * len(probs) for c in columns}

    ranks = {
        c: {r: _Rank(c, r) for p in probs for r in _neighbours(sizes[c], p)[:2]} for c in large
    }
    if small:
        result.update(_by_counts(df, x, small, sizes, probs))
    if not large:
        return result, head
    # On huge columns the first guess reads a share of the values: it only has to be close.
    values = df.select(*[x[c].alias(f"v{i}") for i, c in enumerate(large)], F.rand(0).alias("u"))
    aggs = []
    for i, c in enumerate(large):
        share = GUESS_ROWS / sizes[c]
        noise = 3.0 / math.sqrt(GUESS_ROWS) if share < 1 else 0.0
        at = [m for r in ranks[c].values() for m in _marks(r.rank, sizes[c], r.slack, sketch, noise)]
        seen = F.when(F.col("u") < share, F.col(f"v{i}")) if share < 1 else F.col(f"v{i}")
        aggs.append(F.percentile_approx(seen, at, sketch).alias(f"b{i}"))
    row = values.agg(*aggs).first()
    for i, c in enumerate(large):
        for j, r in enumerate(ranks[c].values()):
            marks = row[f"b{i}"] or [0.0] * (2 * len(ranks[c]))
            r.lo, r.hi = marks[2 * j], marks[2 * j + 1]

    everything = [r for c in large for r in ranks[c].values()]
    while open_ := [r for r in everything if r.value is None and not r.ready]:
        _share_brackets(open_)
        _count_brackets(df, x, open_, sizes, ends, distinct_limit)
        _tighten(df, x, [r for r in open_ if r.value is None and not r.ready], sketch)
    _read_brackets(df, x, [r for r in everything if r.value is None])
    for c in large:
        for j, p in enumerate(probs):
            low, high, weight = _neighbours(sizes[c], p)
            a, b = ranks[c][low].value, ranks[c][high].value
            result[c][j] = float(a + (b - a) * weight)
    return result, head


def _by_counts(df, x, columns: list[str], sizes, probs) -> dict[str, list[float]]:
    """Quantiles of columns with few distinct values: count by value, rank the counts."""
    ids = [f"c{i}" for i in range(len(columns))]
    melted = df.select(*[x[c].alias(i) for c, i in zip(columns, ids)]).unpivot([], ids, "id", "v")
    counts = melted.filter("v is not null").groupBy("id", "v").agg(F.count("*").alias("k"))
    upto = Window.partitionBy("id").orderBy("v")
    ranked = counts.withColumn("upto", F.sum("k").over(upto))
    wanted = F.create_map(
        *[
            cell
            for c, i in zip(columns, ids)
            for cell in (
                F.lit(i),
                F.array(*[F.lit(r) for p in probs for r in _neighbours(sizes[c], p)[:2]]),
            )
        ]
    )
    places = 2 * len(probs)
    found = (
        ranked.withColumn("at", F.element_at(wanted, F.col("id")))
        .groupBy("id")
        .agg(*[F.min(F.when(F.col("upto") > F.col("at")[j], F.col("v"))).alias(f"q{j}") for j in range(places)])
        .collect()  # one row per column
    )
    result = {}
    for row in found:
        c = columns[int(row["id"][1:])]
        result[c] = []
        for j, p in enumerate(probs):
            weight = _neighbours(sizes[c], p)[2]
            low, high = row[f"q{2 * j}"], row[f"q{2 * j + 1}"]
            result[c].append(float(low + (high - low) * weight))
    return result


def _share_brackets(open_: list[_Rank]) -> None:
    """Neighbouring ranks get one bracket around both, so that it is counted once."""
    for a, b in zip(open_, open_[1:]):
        if a.column == b.column and b.rank == a.rank + 1 and a.lo <= b.hi and b.lo <= a.hi:
            a.lo = b.lo = min(a.lo, b.lo)
            a.hi = b.hi = max(a.hi, b.hi)


def _count_brackets(df, x, open_: list[_Rank], sizes, ends, distinct_limit: int) -> None:
    """One scan: where does each rank lie - on an end of its bracket, inside, or outside?

    Ranks with the same bracket ask for the same sums, which are computed once.
    """
    aggs = []
    for i, r in enumerate(open_):
        v, lo, hi = x[r.column], F.lit(r.lo), F.lit(r.hi)
        aggs += [
            F.count(F.when(v < lo, 1)).alias(f"b{i}"),
            F.count(F.when(v == lo, 1)).alias(f"l{i}"),
            F.count(_inner(v, r)).alias(f"m{i}"),
            F.approx_count_distinct(_inner(v, r)).alias(f"d{i}"),
            F.count(F.when(v == hi, 1)).alias(f"h{i}"),
        ]
    row = df.agg(*aggs).first()
    for i, r in enumerate(open_):
        start = row[f"b{i}"]
        after_lo = start + row[f"l{i}"]
        after_inner = after_lo + row[f"m{i}"]
        end = after_inner if r.lo == r.hi else after_inner + row[f"h{i}"]
        if not start <= r.rank < end:
            (r.lo, r.hi), r.slack = ends[r.column], r.slack * 4
            r.below, r.inner = 0, sizes[r.column]
        elif r.rank < after_lo:
            r.value = r.lo
        elif r.rank >= after_inner:
            r.value = r.hi
        else:
            r.below, r.inner = after_lo, row[f"m{i}"]
            r.ready = row[f"d{i}"] <= distinct_limit


def _tighten(df, x, open_: list[_Rank], sketch: int) -> None:
    """One scan: a sketch of what lies strictly inside each bracket gives closer ends."""
    if not open_:
        return
    aggs = []
    for i, r in enumerate(open_):
        at = _marks(r.rank - r.below, r.inner, r.slack, sketch)
        v = x[r.column]
        inside = v if r.below == 0 and r.slack > 2.0 else _inner(v, r)
        aggs.append(F.percentile_approx(inside, at, sketch).alias(f"q{i}"))
    row = df.agg(*aggs).first()
    for i, r in enumerate(open_):
        r.lo, r.hi = row[f"q{i}"]


def _read_brackets(df, x, ready: list[_Rank]) -> None:
    """One scan: the order statistic itself, out of the few values inside the bracket."""
    if not ready:
        return
    inside = df.select(*[_inner(x[r.column], r).alias(f"v{i}") for i, r in enumerate(ready)])
    row = inside.agg(
        *[
            F.expr(
                f"percentile_disc({(r.rank - r.below + 0.5) / r.inner!r}D) "
                f"within group (order by v{i})"
            ).alias(f"q{i}")
            for i, r in enumerate(ready)
        ]
    ).first()
    for i, r in enumerate(ready):
        r.value = row[f"q{i}"]


def grouped_quantiles(
    df: DataFrame, by: str, value: str, probs: list[float], window_rows: int = WINDOW_ROWS
) -> DataFrame:
    """``by, n, q`` per non-null group that has values; ``q`` is the array of exact quantiles.

    Equal values of a group are added up before the shuffle, so no group is larger than its
    number of distinct values; where even that may be too many for one task, the running
    counts are taken over sorted slices.
    """
    work = df.select(col(by).alias("g"), as_number(df, value).alias("v")).filter(
        "g is not null and v is not null"
    )
    counts = work.groupBy("g", "v").agg(F.count("*").alias("k"))
    widest = work.agg(F.approx_count_distinct("v")).first()[0]
    # No group has more distinct values than the whole column.
    ranked = running_sums(counts, ["g"], ["v"], ["k"], widest, window_rows)
    ranked = ranked.withColumnRenamed("all_k", "n")
    at = [F.lit(float(p)) * (F.col("n") - 1) for p in probs]
    picks = []
    for j in range(len(probs)):
        low = F.floor(at[j])
        high = F.least(low + 1, F.col("n") - 1)
        picks += [
            F.min(F.when(F.col("cum_k") > low, F.col("v"))).alias(f"lo{j}"),
            F.min(F.when(F.col("cum_k") > high, F.col("v"))).alias(f"hi{j}"),
        ]
    found = ranked.groupBy("g", "n").agg(*picks)
    q = [
        F.col(f"lo{j}") + (F.col(f"hi{j}") - F.col(f"lo{j}")) * (at[j] - F.floor(at[j]))
        for j in range(len(probs))
    ]
    return found.select(F.col("g").alias(by), "n", F.array(*q).alias("q"))
