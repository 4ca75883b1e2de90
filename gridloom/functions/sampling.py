"""Reproducible exact-size partitions of a table by the order of a key hash.

Rows are ordered by a 32-bit md5 hash of their keys and the seed, then by the keys. A
partition (train/test, folds, a sample) is a handful of cut rows in that order, found by
counting ever narrower hash ranges; placing a row is then a comparison with the cuts, with
no shuffle of rows. The answer depends only on keys and seed, never on how the table
happens to be laid out, and the sizes are exact.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .columns import col, require

# Cuts are held on the driver: one per class and part.
MAX_CLASSES = 10_000
# Up to this many rows one counting pass looks at whole hashes; beyond it, ranges first.
FINE_ROWS = 50_000
# Up to this many cuts are found with the counts on the driver.
FEW_CUTS = 64
# Counts of hash ranges (and classes) that the first pass may bring to the driver.
FIRST_COUNTS = 262_144
# The hash is narrowed 12 bits at a time: 4,096 ranges per pass and class.
_SHIFTS = (20, 8)


def key_hash(keys: list[str], seed: int) -> Column:
    """First 32 bits of md5 over the keys and the seed, as a bigint."""
    text = F.concat_ws("-", *[col(k).cast("string") for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def class_sizes(df: DataFrame, by: str, limit: int = MAX_CLASSES) -> dict:
    """Rows per non-null class; more classes than ``limit`` is an error."""
    rows = df.filter(col(by).isNotNull()).groupBy(col(by)).count().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"`{by}` has more than {limit} classes; it cannot be stratified.")
    return {r[0]: r[1] for r in rows}


def share_out(sizes: dict, total: int) -> dict:
    """Split ``total`` over the classes in proportion, largest remainders first.

    Equal remainders go to the smaller class label. Integer arithmetic throughout.
    """
    n = sum(sizes.values())
    out = {c: k * total // n for c, k in sizes.items()}
    spare = total - sum(out.values())
    for c in sorted(sizes, key=lambda c: (-(sizes[c] * total % n), c))[:spare]:
        out[c] += 1
    return out


def assign_parts(
    df: DataFrame,
    keys: list[str] | None,
    seed: int,
    parts: dict,
    by: str | None = None,
    name: str = "part",
    fine_rows: int = FINE_ROWS,
    first: list[tuple] | None = None,
) -> DataFrame:
    """Add an int column: the index of the part that each row falls in.

    ``parts`` maps each class of ``by`` (or None) to its exact part sizes. Rows of a class
    that is not in ``parts`` get NULL. Without keys the whole row is the key; rows that
    share a key are told apart by the rest of the row, and exact copies by count. ``first``
    are counts of the first hash ranges, if they are known.
    """
    keys = list(keys or df.columns)
    require(df, *keys)
    hashed = df.withColumn("_h", key_hash(keys, seed)).withColumn(
        "_c", F.lit(None).cast("string") if by is None else col(by)
    )
    rows = sum(sum(sizes) for sizes in parts.values())
    # Each pass leaves 1/4096 of the rows; the last one counts whole hashes.
    shifts = [s for i, s in enumerate(_SHIFTS) if rows > fine_rows * 4096**i or i == 0 and first is not None]
    cuts = _find_cuts(hashed, keys, parts, shifts, first)
    placed = _place(hashed, keys, parts, cuts, by is None, name)
    torn: dict = {}
    for cut in cuts:
        if cut["need"] < cut["size"]:
            torn.setdefault((cut["label"], cut["hash"], tuple(cut["key"])), []).append(cut)
    if not torn:
        return placed.drop("_h", "_c")
    pieces = [placed.filter(~reduce(Column.__or__, [_is_tie(k, keys) for k in torn]))]
    for tie, inside in torn.items():
        rows = hashed.filter(_is_tie(tie, keys)).drop("_h", "_c")
        pieces.append(_split_tie(rows, keys, seed, inside, name))
    return reduce(DataFrame.unionByName, [p.drop("_h", "_c") for p in pieces])


def assign_planned_parts(
    df: DataFrame,
    keys: list[str] | None,
    seed: int,
    plan: Callable[[dict], dict],
    by: str | None = None,
    name: str = "part",
    fine_rows: int = FINE_ROWS,
    max_classes: int = MAX_CLASSES,
) -> DataFrame:
    """As ``assign_parts`` with the parts that ``plan`` makes of the class sizes.

    ``plan`` gets ``{class: rows}`` (``{None: rows}`` without ``by``; rows of a NULL class
    are counted under None). The pass that counts the first hash ranges gives the sizes too;
    only where there are more of them than the driver should hold are the sizes counted first.
    """
    keys = list(keys or df.columns)
    require(df, *keys)
    label = F.lit(None).cast("string") if by is None else col(by)
    ranges = df.select(label.alias("_c"), F.shiftright(key_hash(keys, seed), _SHIFTS[0]).alias("_v"))
    table = ranges.groupBy("_c", "_v").agg(F.count("*").alias("_k")).limit(FIRST_COUNTS + 1).collect()
    if len(table) > FIRST_COUNTS:
        sizes = class_sizes(df, by, max_classes) if by is not None else {None: df.count()}
        if by is not None:
            sizes[None] = df.filter(label.isNull()).count()
        return assign_parts(df, keys, seed, plan(sizes), by, name, fine_rows)
    sizes: dict = {None: 0}
    for c, _, k in table:
        sizes[c] = sizes.get(c, 0) + k
    _check_classes(sizes, by, max_classes)
    first = sorted(((c, 0, v, k) for c, v, k in table), key=lambda r: r[2])
    return assign_parts(df, keys, seed, plan(sizes), by, name, fine_rows, first)


def _check_classes(sizes: dict, by: str | None, limit: int) -> None:
    if len(sizes) > limit + 1:
        raise ValueError(f"`{by}` has more than {limit} classes; it cannot be stratified.")


def _ranks(parts: dict) -> list[tuple]:
    out = []
    for label, sizes in parts.items():
        seen = 0
        for i, size in enumerate(sizes[:-1]):
            seen += size
            if 0 < seen < sum(sizes):
                out.append((label, i, seen, 0))
    return out


def _find_cuts(
    hashed: DataFrame, keys: list[str], parts: dict, shifts: list[int], first: list[tuple] | None = None
) -> list[dict]:
    """The row at each wanted rank: its hash, its keys, and its place among equal keys."""
    targets = _ranks(parts)
    if not targets:
        return []
    steps = [F.lit(0).cast("bigint"), *[F.shiftright("_h", s) for s in shifts], F.col("_h")]
    levels = [*zip(steps, steps[1:]), (F.col("_h"), F.struct(*map(col, keys)))]
    find = _hits_on_driver if len(targets) <= FEW_CUTS else _hits_in_spark
    for i, (parent, child) in enumerate(levels):
        if i == 0 and first is not None:
            found = _picked(first, targets)
            targets = [(label, part, need, value) for label, part, need, _, value, _ in found]
            continue
        rows = hashed.select("_c", parent.alias("_p"), child.alias("_v"))
        found = find(rows, targets, first=i == 0, last=i == len(levels) - 1)
        targets = [(label, part, need, value) for label, part, need, _, value, _ in found]
    names = ("label", "part", "need", "hash", "key", "size")
    return [dict(zip(names, hit)) for hit in found]


def _hits_on_driver(rows: DataFrame, targets: list[tuple], first: bool, last: bool) -> list[tuple]:
    """``label, part, place in range, outer range, range, rows in range`` of each target.

    With few targets the counts fit the driver: 4,096 ranges per target and pass, then the
    whole hashes of one range, then the keys that share a hash.
    """
    if not first:
        inside = [
            F.col("_c").eqNullSafe(F.lit(label)) & (F.col("_p") == F.lit(within))
            for label, within in dict.fromkeys((t[0], t[3]) for t in targets)
        ]
        rows = rows.filter(reduce(Column.__or__, inside))
    counts = rows.groupBy("_c", "_p", "_v").agg(F.count("*").alias("_k"))
    # Keys are put in order by Spark; hash ranges are plain numbers.
    table = counts.orderBy("_v").collect() if last else sorted(counts.collect(), key=lambda r: r["_v"])
    return _picked(table, targets)


def _picked(table: list, targets: list[tuple]) -> list[tuple]:
    """The range of each target out of ``class, outer range, range, rows`` in order."""
    groups: dict = {}
    for label, outer, value, k in table:
        groups.setdefault((label, outer), []).append((value, k))
    found = []
    for label, part, rank, within in targets:
        seen = 0
        for value, k in groups[label, within]:
            if rank <= seen + k:
                found.append((label, part, rank - seen, within, value, k))
                break
            seen += k
    return found


def _hits_in_spark(rows: DataFrame, targets: list[tuple], first: bool, last: bool) -> list[tuple]:
    """The same for many classes: counts stay distributed, only the hits come back."""
    schema = T.StructType(
        [
            T.StructField("label", rows.schema["_c"].dataType),
            T.StructField("part", T.IntegerType()),
            T.StructField("rank", T.LongType()),
            T.StructField("within", T.LongType()),
        ]
    )
    # At most MAX_CLASSES x parts rows.
    wanted = F.broadcast(rows.sparkSession.createDataFrame(targets, schema))
    same = F.col("_c").eqNullSafe(F.col("label")) & (F.col("_p") == F.col("within"))
    if not first:
        rows = rows.join(wanted, same, "left_semi")
    counts = rows.groupBy("_c", "_p", "_v").agg(F.count("*").alias("_k"))
    upto = counts.withColumn("_upto", F.sum("_k").over(Window.partitionBy("_c", "_p").orderBy("_v")))
    before = F.col("_upto") - F.col("_k")
    hits = upto.join(wanted, same & F.col("rank").between(before + 1, F.col("_upto")))
    picked = hits.select("label", "part", (F.col("rank") - before).alias("need"), "_p", "_v", "_k")
    return [tuple(r) for r in picked.collect()]


def _place(hashed, keys, parts, cuts, single: bool, name: str) -> DataFrame:
    """Part of a row = how many cuts of its class lie before it."""
    names = [f"k{i}" for i in range(len(keys))]
    cut_type = T.StructType(
        [T.StructField("h", T.LongType())]
        + [T.StructField(n, hashed.schema[k].dataType) for n, k in zip(names, keys)]
    )
    rows = []
    for label, sizes in parts.items():
        leading = 0
        while leading < len(sizes) - 1 and sum(sizes[: leading + 1]) == 0:
            leading += 1
        rows.append((label, leading, [c for c in cuts if c["label"] == label]))
    here = F.struct(F.col("_h").alias("h"), *[col(k).alias(n) for k, n in zip(keys, names)])
    if single:
        _, leading, marks = rows[0]
        passed = F.lit(leading)
        for cut in marks:
            values = [F.lit(v).cast(t.dataType) for v, t in zip(cut["key"], cut_type[1:])]
            mark = F.struct(F.lit(cut["hash"]).cast("bigint"), *values)
            passed = passed + (here > mark.cast(cut_type)).cast("int")
        return hashed.withColumn(name, passed.cast("int"))
    schema = T.StructType(
        [
            T.StructField("_label", hashed.schema["_c"].dataType),
            T.StructField("_empty", T.IntegerType()),
            T.StructField("_cuts", T.ArrayType(cut_type)),
        ]
    )
    local = [(label, n, [(c["hash"], *c["key"]) for c in marks]) for label, n, marks in rows]
    # At most MAX_CLASSES rows.
    table = F.broadcast(hashed.sparkSession.createDataFrame(local, schema))
    passed = F.size(F.filter("_cuts", lambda cut: here > cut))
    return (
        hashed.join(table, F.col("_c") == F.col("_label"), "left")
        .withColumn(name, (F.col("_empty") + passed).cast("int"))
        .drop("_label", "_empty", "_cuts")
    )


def _is_tie(tie: tuple, keys: list[str]) -> Column:
    label, hash_, values = tie
    same = F.col("_c").eqNullSafe(F.lit(label)) & (F.col("_h") == F.lit(hash_))
    for k, v in zip(keys, values):
        same = same & col(k).eqNullSafe(F.lit(v))
    return same


def _split_tie(rows: DataFrame, keys, seed, cuts: list[dict], name: str) -> DataFrame:
    """A cut inside rows with one key: order those by the whole row, copies by number."""
    cuts = sorted(cuts, key=lambda c: (c["need"], c["part"]))
    needs = [0, *[c["need"] for c in cuts], cuts[0]["size"]]
    sizes = [b - a for a, b in zip(needs, needs[1:])]
    labels = [c["part"] for c in cuts] + [cuts[-1]["part"] + 1]
    renamed = F.get(F.array(*map(F.lit, labels)), F.col("_piece")).alias(name)
    if set(keys) != set(rows.columns):
        inner = assign_parts(rows, rows.columns, seed, {None: sizes}, name="_piece")
        return inner.select(*map(col, rows.columns), renamed)
    # Exact copies: one row and a number say everything, and the number is spread by range.
    piece = sum([(F.col("id") >= F.lit(n)).cast("int") for n in needs[1:-1]], F.lit(0))
    numbers = rows.sparkSession.range(cuts[0]["size"]).select(piece.alias("_piece"), F.lit(1).alias("_one"))
    one = F.broadcast(rows.limit(1).withColumn("_one", F.lit(1)))
    return numbers.join(one, "_one").select(*map(col, rows.columns), renamed)


def take_rows(
    df: DataFrame, n: int, keys: list[str] | None, seed: int, report_rows: int = 10_000
) -> DataFrame:
    """A seeded sample of ``n`` rows without replacement (all rows if there are fewer).

    A report-sized sample is a top-k by hash; a larger one is cut out in place. Both take the
    rows in the same order: by the hash of the key and the key, and rows that share one by
    the hash of the whole row and the row.
    """
    keys = list(keys or df.columns)
    if n <= report_rows:
        hashed = df.withColumn("_h", key_hash(keys, seed)).withColumn("_all", key_hash(df.columns, seed))
        order = ["_h", *map(col, keys), "_all", *map(col, df.columns)]
        return hashed.orderBy(*order).limit(n).drop("_h", "_all")
    total = df.count()
    n = min(n, total)
    parts = assign_parts(df, keys, seed, {None: [n, total - n]}, name="_part")
    return parts.filter("_part = 0").drop("_part")
