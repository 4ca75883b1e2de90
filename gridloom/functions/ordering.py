"""Running totals and positions over a global order, without a one-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .columns import col
from .storage import cut_lineage

# A window over at most this many rows may sit in one task.
WINDOW_ROWS = 1_000_000


def _before(total: str, window) -> F.Column:
    return F.coalesce(F.sum(total).over(window), F.lit(0))


def running_sums(
    df: DataFrame,
    by: list[str],
    order: list[str],
    sums: list[str],
    rows: int,
    window_rows: int = WINDOW_ROWS,
    descending: bool = False,
) -> DataFrame:
    """Add ``cum_<s>`` and ``all_<s>``: running and whole total of each sum within ``by``.

    ``df`` holds one row per (by, order), already aggregated. ``rows`` is its size, or more. Small tables take a plain window. Larger ones are range-sorted
    and written once; every sorted slice sums itself, and the slices' totals (one row
    per slice and group) give the offsets.
    """
    directed = [col(c).desc() if descending else col(c).asc() for c in order]
    upto = (Window.unboundedPreceding, Window.currentRow)
    if rows <= window_rows:
        group = Window.partitionBy(*map(col, by))
        frame = group.orderBy(*directed).rowsBetween(*upto)
        return df.select(
            "*",
            *[F.sum(col(s)).over(frame).alias(f"cum_{s}") for s in sums],
            *[F.sum(col(s)).over(group).alias(f"all_{s}") for s in sums],
        )

    ranged = df.orderBy(*map(col, by), *directed).withColumn("_slice", F.spark_partition_id())
    ranged = cut_lineage(ranged)
    totals = ranged.groupBy("_slice", *map(col, by)).agg(
        *[F.sum(col(s)).alias(f"_t_{s}") for s in sums]
    )
    whole = Window.partitionBy(*map(col, by))
    earlier = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("_slice").alias("_o_slice"),
        *[col(b).alias(f"_o_{b}") for b in by],
        *[_before(f"_t_{s}", earlier).alias(f"_off_{s}") for s in sums],
        *[F.sum(f"_t_{s}").over(whole).alias(f"all_{s}") for s in sums],
    )
    inside = (
        Window.partitionBy("_slice", *map(col, by)).orderBy(*directed).rowsBetween(*upto)
    )
    local = ranged.select("*", *[F.sum(col(s)).over(inside).alias(f"_in_{s}") for s in sums])
    match = F.col("_slice") == F.col("_o_slice")
    for b in by:
        match = match & col(b).eqNullSafe(col(f"_o_{b}"))
    return local.join(offsets, match).select(
        *[col(c) for c in df.columns],
        *[(F.col(f"_in_{s}") + F.col(f"_off_{s}")).alias(f"cum_{s}") for s in sums],
        *[F.col(f"all_{s}") for s in sums],
    )


def position_codes(values: DataFrame, name: str, rows: int, window_rows: int = WINDOW_ROWS):
    """``name, code``: 0-based place of each distinct value in sorted order."""
    ones = values.select(col(name), F.lit(1).alias("_one"))
    ranked = running_sums(ones, [], [name], ["_one"], rows, window_rows)
    return ranked.select(col(name), (F.col("cum__one") - 1).alias("code"))


def value_codes(df: DataFrame, value: Column, window_rows: int = WINDOW_ROWS) -> DataFrame:
    """``_v, code`` of the distinct values that are not NULL, which are written once."""
    values = cut_lineage(df.select(value.alias("_v")).filter("_v is not null").distinct())
    return position_codes(values, "_v", values.count(), window_rows)


def join_codes(df: DataFrame, column: str, codes: DataFrame, name: str) -> DataFrame:
    """Adds the code of each value from ``_v, code``; NULL for unknown values and NULLs.

    NULLs match nothing, so they are dealt evenly over the tasks instead of meeting in one.
    """
    spread = F.when(col(column).isNull(), F.pmod(F.monotonically_increasing_id(), F.lit(4096))).otherwise(F.lit(0))
    left = df.withColumn("_spread", spread.cast("bigint"))
    right = codes.select(
        F.col("_v"), F.col("code").alias(name), F.lit(0).cast("bigint").alias("_at")
    )
    same = (col(column).cast("string") == F.col("_v")) & (F.col("_spread") == F.col("_at"))
    return left.join(right, same, "left").drop("_spread", "_v", "_at")
