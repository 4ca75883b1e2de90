"""Mixing sources to target weights by Pareto order sampling.

Every document first gets the whole copies that its source's ratio makes certain. What is
missing to the target is drawn once more by Pareto order sampling: documents are ranked by
their random odds over their inclusion odds, and the first ones are taken until the words
of the source's target are reached. Inclusion odds are the odds of the source's open share,
tilted by the document's size over the mean size: large documents are settled early, so the
rank at which the target is met falls among small ones. The cut in the ranking is found by
adding up words per range of ranks, three times narrower each; no ranking is ever sorted
whole and no source meets in one task. All DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import require
from ..functions.ordering import running_sums
from ..functions.sampling import key_hash
from ..functions.storage import cut_lineage
from .common import fitting, quoted, words

WEIGHTS = (5, 2, 1)
TOTAL_SHARE = 1.5
MOST_COPIES = 2
SEED = 42
# Ranks are whole numbers of 48 bits, narrowed 12 bits at a time.
_BITS, _SHIFTS = 48, (36, 24)


def sizes_of(docs: DataFrame, id_col: str, text_col: str, source_col: str, payload: bool = False) -> DataFrame:
    """``doc_id, source, size`` (in words), and with ``payload`` the whole row as a struct."""
    require(docs, id_col, text_col, source_col)
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    return docs.select(
        quoted(id_col).alias("doc_id"), quoted(source_col).cast("string").alias("source"),
        F.size(words(text)).cast("bigint").alias("size"),
        *([F.struct(*map(quoted, docs.columns)).alias("row")] if payload else []),
    )


def targets(
    sized: DataFrame, weights=WEIGHTS, total_share: float = TOTAL_SHARE, most: int = MOST_COPIES
) -> DataFrame:
    """``source, docs, source_size, target``: shares by weight, none above ``most`` sizes.

    Sources in code point order, NULL last, weigh ``weights`` in turn. What a full source
    cannot take is shared by the others by weight: all open sources stand at one level of
    words per unit of weight, found by running sums over the sources in the order in which
    they fill up.
    """
    known = sized.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("source_size"))
    known = cut_lineage(known.withColumn("is_null", F.col("source").isNull().cast("int")).withColumn("one", F.lit(1)))
    n = known.count()
    placed = running_sums(known, [], ["is_null", "source"], ["one"], n)
    turn = F.pmod(F.col("cum_one") - 1, F.lit(len(weights))).cast("int")
    weighed = placed.select(
        "source", "is_null", "docs", "source_size",
        F.get(F.array(*map(F.lit, weights)), turn).cast("bigint").alias("weight"),
        (F.col("source_size") * most).alias("cap"),
    ).withColumn("fills_at", F.col("cap") / F.col("weight"))
    filled = cut_lineage(running_sums(weighed, [], ["fills_at", "is_null", "source"], ["cap", "weight"], n))
    total = F.lit(total_share) * F.col("all_cap") / most
    # Full if the level that all sources from here on could reach is at least their own.
    open_cap = total - (F.col("cum_cap") - F.col("cap"))
    open_weight = F.col("all_weight") - (F.col("cum_weight") - F.col("weight"))
    filled = filled.withColumn("full", open_cap / open_weight >= F.col("fills_at"))
    level = filled.agg(
        F.max(total).alias("total"),
        F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))), F.lit(0)).alias("cap"),
        F.sum(F.when(~F.col("full"), F.col("weight"))).alias("weight"),
    ).first()
    level = (level["total"] - level["cap"]) / level["weight"] if level["weight"] else 0.0
    return filled.select(
        "source", "docs", "source_size",
        F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.lit(level) * F.col("weight")).alias("target"),
    )


def pareto_rank(hash32: Column, share: Column, relative_size: Column) -> Column:
    """Random odds over inclusion odds, as a whole number that grows with them."""
    u = (hash32 + 0.5) / 4294967296.0
    odds = (u / (1 - u)) / ((share / (1 - share)) * relative_size)
    return F.floor(odds / (1 + odds) * float(1 << _BITS)).cast("bigint")


def _crossing(ranked: DataFrame, shift: int) -> DataFrame:
    """Per source the range of ranks in which the running words reach what is missing."""
    sums = ranked.groupBy("source", "missing", "before", F.shiftright("rank", shift).alias("range")).agg(
        F.sum("size").alias("words")
    )
    upto = sums.withColumn("upto", F.col("before") + F.sum("words").over(Window.partitionBy("source").orderBy("range")))
    hit = (F.col("upto") >= F.col("missing")) & (F.col("upto") - F.col("words") < F.col("missing"))
    return upto.filter(hit).select(
        F.col("source").alias("s"), F.col("range"), (F.col("upto") - F.col("words")).alias("start")
    )


def _ranked(sized: DataFrame, goal: DataFrame, seed: int) -> DataFrame:
    """Adds the source's goal and the document's rank; documents that need no draw have none."""
    rows = sized.join(goal, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    share = F.col("missing") / F.col("source_size")
    rank = pareto_rank(
        key_hash(["doc_id"], seed), share, F.col("size") * F.col("docs") / F.col("source_size")
    )
    return rows.withColumn("rank", F.when((F.col("missing") > 0) & (F.col("size") > 0), rank))


def _decided(docs, id_col, text_col, source_col, weights, total_share, most, seed, payload: bool) -> DataFrame:
    sized = cut_lineage(sizes_of(docs, id_col, text_col, source_col))
    goal = targets(sized, weights, total_share, most)
    ratio = F.col("target") / F.col("source_size")
    goal = goal.withColumn("whole", F.coalesce(F.floor(ratio).cast("int"), F.lit(0)))
    goal = goal.withColumn("missing", F.coalesce(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0)))
    goal = fitting(goal.withColumnRenamed("source", "s"))
    rows = _ranked(sized, goal, seed)
    left = rows.filter("rank IS NOT NULL").select(
        "doc_id", "source", "size", "rank", "missing", F.lit(0).cast("bigint").alias("before")
    )
    for shift in _SHIFTS:
        hit = fitting(_crossing(left, shift))
        same = F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("rank", shift) == F.col("range"))
        left = left.join(hit, same).select("doc_id", "source", "size", "rank", "missing", F.col("start").alias("before"))
    place = F.struct("rank", "doc_id")
    last = left.withColumn("place", place)
    upto = last.select(
        "source", "place", "missing",
        (F.col("before") + F.sum("size").over(Window.partitionBy("source").orderBy("place"))).alias("upto"),
        F.sum("size").over(Window.partitionBy("source", "place")).alias("words"),
    )
    short = F.col("missing") - (F.col("upto") - F.col("words"))
    hit = (F.col("upto") >= F.col("missing")) & (short > 0)
    cuts = upto.filter(hit).groupBy("source").agg(
        F.min("place").alias("cut"), F.max(F.col("upto") - F.col("missing") < short).alias("with_it")
    )
    cuts = fitting(cuts.withColumnRenamed("source", "s"))
    passed = (place < F.col("cut")) | (F.col("with_it") & place.eqNullSafe(F.col("cut")))
    drawn = F.col("rank").isNotNull() & F.coalesce(passed, F.lit(False))
    if payload:
        rows = _ranked(sizes_of(docs, id_col, text_col, source_col, payload=True), goal, seed)
    done = rows.join(cuts, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    return done.withColumn("copies", F.col("whole") + drawn.cast("int"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    total_share: float = TOTAL_SHARE,
    most: int = MOST_COPIES,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken``, one row per row of ``docs``.

    ``taken`` is copies times size; a source's sum is as near to its target as the document
    at which the target is met allows. Reruns agree: the random numbers are hashes of the id.

    NULL and empty texts have size 0 and are taken for 0 words; a NULL source is a source
    of its own, the last; rows that share an id and a source are taken or left together; an
    empty table gives an empty one; other columns are left out.
    """
    done = _decided(docs, id_col, text_col, source_col, weights, total_share, most, seed, False)
    return done.select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).cast("bigint").alias("taken"),
    )


def mix_rows(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    total_share: float = TOTAL_SHARE,
    most: int = MOST_COPIES,
    seed: int = SEED,
) -> DataFrame:
    """The rows of ``docs``, each as many times as the mix takes it, all columns as they were."""
    done = _decided(docs, id_col, text_col, source_col, weights, total_share, most, seed, True)
    return done.select(F.explode(F.array_repeat("row", F.col("copies"))).alias("row")).select("row.*")


def oracle_sql(weights=WEIGHTS, total_share: float = TOTAL_SHARE, most: int = MOST_COPIES, seed: int = SEED) -> str:
    """The same in DuckDB's SQL over ``documents`` with distinct ids."""
    ranks = f"floor(odds / (1 + odds) * {float(1 << _BITS)!r})"
    return f"""
    WITH sized AS (
        SELECT doc_id, source,
               len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> ''))::BIGINT AS size
        FROM documents
    ), known AS (
        SELECT source, count(*) AS docs, sum(size)::BIGINT AS source_size,
               row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1 AS turn
        FROM sized GROUP BY source
    ), weighed AS (
        SELECT source, docs, source_size, ([{', '.join(map(str, weights))}])[turn % {len(weights)} + 1] AS weight,
               source_size * {most} AS cap, turn
        FROM known
    ), filled AS (
        SELECT *, sum(cap) OVER upto AS cum_cap, sum(weight) OVER upto AS cum_weight,
               sum(cap) OVER () AS all_cap, sum(weight) OVER () AS all_weight
        FROM (SELECT *, cap::DOUBLE / weight AS fills_at FROM weighed)
        WINDOW upto AS (ORDER BY fills_at, turn ROWS UNBOUNDED PRECEDING)
    ), levels AS (
        SELECT *, {total_share}::DOUBLE * all_cap::DOUBLE / {most} AS total,
               ({total_share}::DOUBLE * all_cap::DOUBLE / {most} - (cum_cap - cap)) / (all_weight - (cum_weight - weight))::DOUBLE >= fills_at AS is_full
        FROM filled
    ), level AS (
        SELECT coalesce((max(total) - coalesce(sum(cap) FILTER (WHERE is_full), 0)::DOUBLE) / nullif(sum(weight) FILTER (WHERE NOT is_full), 0)::DOUBLE, 0) AS height
        FROM levels
    ), goal AS (
        SELECT source, docs, source_size, CASE WHEN is_full THEN cap::DOUBLE ELSE height * weight::DOUBLE END AS target
        FROM levels, level
    ), missing AS (
        SELECT *, coalesce(floor(target / nullif(source_size, 0)), 0)::BIGINT AS whole FROM goal
    ), rows AS (
        SELECT sized.*, docs, source_size, target, whole, target - whole * source_size::DOUBLE AS missing,
               (target - whole * source_size::DOUBLE) / nullif(source_size, 0)::DOUBLE AS share,
               (('0x' || substr(md5(concat_ws('-', doc_id::VARCHAR, '{seed}')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE AS u
        FROM sized JOIN missing ON sized.source IS NOT DISTINCT FROM missing.source
    ), tilted AS (
        SELECT *, (u / (1 - u)) / ((share / (1 - share)) * ((size * docs)::DOUBLE / source_size::DOUBLE)) AS odds
        FROM rows WHERE missing > 0 AND size > 0
    ), upto AS (
        SELECT doc_id, missing, size, sum(size) OVER (PARTITION BY source ORDER BY {ranks}, doc_id)::BIGINT AS upto FROM tilted
    ), drawn AS (
        SELECT doc_id FROM upto
        WHERE upto < missing OR (upto - size < missing AND upto - missing < missing - (upto - size))
    )
    SELECT rows.doc_id, rows.source, rows.size, rows.source_size, rows.target,
           (whole + (drawn.doc_id IS NOT NULL)::INT)::INT AS copies,
           ((whole + (drawn.doc_id IS NOT NULL)::INT) * rows.size)::BIGINT AS taken
    FROM rows LEFT JOIN drawn USING (doc_id)
    """
