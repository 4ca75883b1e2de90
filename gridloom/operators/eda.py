"""The numbers behind exploratory charts, and the facts told about them."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import as_number, col, pearson, require
from ..functions.quantiles import DISTINCT_LIMIT, column_quantiles, grouped_quantiles
from .profile import missing_values, worst_missing

# Chart defaults and the wording thresholds of the facts.
DEFAULT_BINS = 30
DENSITY_POINTS = 300
WHISKER = 1.5
SYMMETRIC_BELOW = 0.1
WEAK_BELOW, MODERATE_BELOW = 0.3, 0.7
AGGREGATIONS = ["mean", "sum", "median", "min", "max", "count"]


def bin_index(x: Column, lo: float, width: float, bins: int) -> Column:
    """Equal-width bin of a value; the largest value belongs to the last bin."""
    if width == 0:
        return F.when(x.isNotNull(), F.lit(0))
    # least() skips NULLs, so a missing value has to be kept out of it.
    place = F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1))
    return F.when(x.isNotNull(), place).cast("int")


def histogram(df: DataFrame, x: str, bins: int = DEFAULT_BINS) -> DataFrame:
    """``bin, lo, hi, count`` over equal-width bins, empty bins included."""
    require(df, x)
    v = as_number(df, x)
    lo, hi = df.agg(F.min(v), F.max(v)).first()
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, lo double, hi double, count bigint")
    width = (hi - lo) / bins
    counted = (
        df.select(bin_index(v, lo, width, bins).alias("bin"))
        .filter("bin is not null")
        .groupBy("bin")
        .agg(F.count("*").alias("count"))
    )
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    edge = F.lit(lo) + F.col("bin") * F.lit(width)
    return every.join(counted, "bin", "left").select(
        "bin", edge.alias("lo"), (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("hi"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def residual_histogram(df: DataFrame, x: str = "residual") -> DataFrame:
    """Histogram with a bin count that follows the number of rows: a quarter, 10 to 30."""
    rows = df.agg(F.count(col(x))).first()[0]
    return histogram(df, x, min(30, max(10, rows // 4)))


def box_plot(
    df: DataFrame, y: str, x: str | None = None, distinct_limit: int = DISTINCT_LIMIT
) -> DataFrame:
    """Quartiles, whiskers at the last points inside 1.5 IQR, and the points outside."""
    require(df, y, *([x] if x else []))
    if x is None:
        quartiles = column_quantiles(df, [y], [0.25, 0.5, 0.75], distinct_limit)[0][y]
        v = as_number(df, y)
        q1, q2, q3 = (F.lit(q).cast("double") for q in quartiles)
        return df.select(v.alias("v")).filter("v is not null").agg(*_box(q1, q2, q3))
    name = "group" if x == y else x
    quartiles = grouped_quantiles(df, x, y, [0.25, 0.5, 0.75])
    quartiles = quartiles.select(col(x).alias("_g"), "q")
    rows = df.select(col(x).alias("_x"), as_number(df, y).alias("v")).filter("v is not null")
    # The quartile side is aggregated; the optimizer broadcasts it when it is small, and
    # splits a group that is too large for one task when it is not.
    joined = rows.join(quartiles, F.col("_x") == F.col("_g"))
    q1, q2, q3 = (F.col("q")[i] for i in range(3))
    return (
        joined.groupBy("_x").agg(*_box(q1, q2, q3)).withColumnRenamed("_x", name)
    )


def _box(q1: Column, q2: Column, q3: Column) -> list[Column]:
    v = F.col("v")
    low, high = q1 - F.lit(WHISKER) * (q3 - q1), q3 + F.lit(WHISKER) * (q3 - q1)
    inside = F.when((v >= low) & (v <= high), v)
    return [
        F.count(v).alias("count"),
        F.min(v).alias("min"),
        F.max(q1).alias("q1"),
        F.max(q2).alias("median"),
        F.max(q3).alias("q3"),
        F.max(v).alias("max"),
        F.min(inside).alias("whisker_low"),
        F.max(inside).alias("whisker_high"),
        F.count(F.when((v < low) | (v > high), 1)).alias("outliers"),
    ]


def density(df: DataFrame, x: str, points: int = DENSITY_POINTS) -> DataFrame:
    """Gaussian kernel density on an even grid from min to max, Scott bandwidth.

    Every task adds its rows up into one vector of grid sums; only those vectors move.
    """
    require(df, x)
    v = as_number(df, x)
    n, lo, hi, std = df.agg(F.count(v), F.min(v), F.max(v), F.stddev_samp(v)).first()
    if n < 2:
        raise ValueError(f"A density of `{x}` takes two values or more.")
    if lo == hi or not std:
        raise ValueError(f"`{x}` never varies; its density has no width.")
    width = std * n ** (-1.0 / 5.0)
    step = (hi - lo) / (points - 1)
    scale = 1.0 / (n * width * math.sqrt(2.0 * math.pi))

    def grid_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grid = lo + step * np.arange(points)
        total = np.zeros(points)
        for batch in batches:
            values, weights = np.unique(batch["v"].to_numpy(), return_counts=True)
            for start in range(0, len(values), 4096):
                part = values[start : start + 4096]
                z = (grid[:, None] - part[None, :]) / width
                total += np.exp(-0.5 * z * z) @ weights[start : start + 4096]
        yield pd.DataFrame({"point": np.arange(points, dtype=np.int32), "s": total})

    partial = df.select(v.alias("v")).filter("v is not null").mapInPandas(
        grid_sums, "point int, s double"
    )
    return partial.groupBy("point").agg((F.sum("s") * F.lit(scale)).alias("density")).select(
        "point", (F.lit(lo) + F.col("point") * F.lit(step)).alias("x"), "density"
    )


def paired_rows(df: DataFrame, x: str, y: str) -> DataFrame:
    """Rows that have both values."""
    require(df, x, y)
    return df.dropna("any", subset=[x, y])


def scatter(df: DataFrame, x: str, y: str, color: str | None = None) -> DataFrame:
    """The points of a scatter plot: every row that has both coordinates."""
    wanted = dict.fromkeys([x, y, *([color] if color else [])])
    return paired_rows(df, x, y).select(*map(col, wanted))


def excluded_rows(df: DataFrame, x: str, y: str) -> DataFrame:
    """How many rows a pairwise chart leaves out, with the rows it shows."""
    require(df, x, y)
    both = F.count(F.when(col(x).isNotNull() & col(y).isNotNull(), 1))
    return df.agg(
        both.alias("paired_rows"), (F.count(F.lit(1)) - both).alias("excluded_rows")
    )


def grouped_bar(df: DataFrame, x: str, y: str, aggregation: str = "mean") -> DataFrame:
    """``group, value`` per non-null group; groups without a value are left out."""
    require(df, x, y)
    if aggregation not in AGGREGATIONS:
        raise ValueError(f"Unknown aggregation `{aggregation}`.")
    if aggregation == "median":
        return grouped_quantiles(df, x, y, [0.5]).select(
            col(x).alias("group"), F.col("q")[0].alias("value")
        )
    v = as_number(df, y)
    how = {
        "mean": F.avg(v),
        "sum": F.coalesce(F.sum(v), F.lit(0.0)),
        "min": F.min(v),
        "max": F.max(v),
        "count": F.count(v).cast("double"),
    }[aggregation]
    grouped = df.filter(col(x).isNotNull()).groupBy(col(x).alias("group"))
    return grouped.agg(how.alias("value")).filter("value is not null")


def frequency_distribution(df: DataFrame, x: str) -> DataFrame:
    """``category, count, percent``; NULL is a category of its own."""
    require(df, x)
    counts = df.groupBy(col(x).alias("category")).agg(F.count("*").alias("count"))
    total = df.count()
    share = F.col("count") * F.lit(100.0) / F.lit(float(max(total, 1)))
    return counts.withColumn("percent", share)


def count_plot(df: DataFrame, x: str) -> DataFrame:
    """``category, count`` without NULL, rarest first."""
    require(df, x)
    return (
        df.filter(col(x).isNotNull())
        .groupBy(col(x).alias("category"))
        .agg(F.count("*").alias("count"))
        .orderBy("count", "category")
    )


def missing_bar(df: DataFrame) -> DataFrame:
    return missing_values(df).filter("missing_count > 0").select("column", "missing_count")


def _pairwise(df: DataFrame, columns: list[str], most: int | None) -> list[str]:
    """The columns asked for; more than ``most``, if that is given, is an error."""
    chosen = list(columns)
    require(df, *chosen)
    if most is not None and len(chosen) > most:
        raise ValueError(f"{len(chosen)} columns were given for a matrix of at most {most}.")
    return chosen


def pairwise_points(df: DataFrame, columns: list[str], most: int | None = None) -> DataFrame:
    """Points of every pair of the columns, from one scan."""
    chosen = _pairwise(df, columns, most)
    cells = [
        F.struct(
            F.lit(a).alias("x_column"), F.lit(b).alias("y_column"),
            as_number(df, a).alias("x"), as_number(df, b).alias("y"),
        )
        for a, b in combinations(chosen, 2)
    ]
    return df.select(F.inline(F.array(*cells))).filter("x is not null and y is not null")


def pairwise_histograms(
    df: DataFrame, columns: list[str], bins: int = DEFAULT_BINS, most: int | None = None
) -> DataFrame:
    """The diagonal of the pairwise matrix: one histogram per column, from two scans."""
    chosen = _pairwise(df, columns, most)
    ends = df.agg(
        *[f(as_number(df, c)).alias(f"{n}{i}") for i, c in enumerate(chosen)
          for n, f in (("lo", F.min), ("hi", F.max))]
    ).first()
    cells, frame = [], []
    for i, c in enumerate(chosen):
        lo, hi = ends[f"lo{i}"], ends[f"hi{i}"]
        if lo is None:
            continue
        width = (hi - lo) / bins
        cells.append(
            F.struct(
                F.lit(c).alias("column"),
                bin_index(as_number(df, c), lo, width, bins).alias("bin"),
            )
        )
        frame += [(c, b, lo + b * width, lo + (b + 1) * width) for b in range(bins)]
    every = df.sparkSession.createDataFrame(
        frame, "column string, bin int, lo double, hi double"
    )
    if not cells:
        return every.withColumn("count", F.lit(0).cast("bigint"))
    counted = (
        df.select(F.inline(F.array(*cells)))
        .filter("bin is not null")
        .groupBy("column", "bin")
        .agg(F.count("*").alias("count"))
    )
    return every.join(counted, ["column", "bin"], "left").select(
        "column", "bin", "lo", "hi", F.coalesce("count", F.lit(0)).alias("count")
    )


def skew_facts(df: DataFrame, x: str, distinct_limit: int = DISTINCT_LIMIT) -> DataFrame:
    """Mean, median, spread and the shape of a distribution."""
    require(df, x)
    median = column_quantiles(df, [x], [0.5], distinct_limit)[0][x][0]
    v = as_number(df, x)
    wide = df.agg(
        F.count(v).alias("n"), F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("std"), F.min(v).alias("lo"), F.max(v).alias("hi"),
        (F.count(F.lit(1)) - F.count(v)).alias("missing"),
    ).withColumn("median", F.lit(median).cast("double"))
    distance = F.abs(F.col("mean") - F.col("median"))
    shape = (
        F.when(F.col("n") < 2, "too few values")
        .when(F.col("lo") == F.col("hi"), "constant")
        .when(distance < F.lit(SYMMETRIC_BELOW) * F.col("std"), "symmetric")
        .when(F.col("mean") > F.col("median"), "right-skewed")
        .otherwise("left-skewed")
    )
    return wide.select(
        "mean", "median", "std", shape.alias("shape"), (F.col("std") * 2).alias("spread"),
        "missing",
    )


def box_facts(
    df: DataFrame, y: str, x: str | None = None, distinct_limit: int = DISTINCT_LIMIT
) -> DataFrame:
    """Quartiles, outliers at 1.5 IQR, and the groups with the extreme medians."""
    box = box_plot(df, y, None, distinct_limit)
    facts = box.select(
        "q1", "median", "q3", (F.col("q1") == F.col("q3")).alias("iqr_is_zero"), "outliers",
        F.lit(1).alias("_one"),
    )
    if x is None or x not in df.columns:
        return facts.drop("_one")
    medians = grouped_bar(df, x, y, "median")
    return facts.join(_extremes(medians).withColumn("_one", F.lit(1)), "_one").drop("_one")


def _extremes(grouped: DataFrame) -> DataFrame:
    """Highest and lowest group; of equal ones the smallest group. One group has neither."""
    highest = F.min_by("group", F.struct((-F.col("value")).alias("v"), "group"))
    lowest = F.min_by("group", F.struct("value", "group"))
    facts = {
        "highest_group": highest.cast("string"), "highest_value": F.max("value"),
        "lowest_group": lowest.cast("string"), "lowest_value": F.min("value"),
    }
    return grouped.agg(*[F.when(F.count(F.lit(1)) > 1, fact).alias(name) for name, fact in facts.items()])


def bar_facts(df: DataFrame, x: str, y: str, aggregation: str = "mean") -> DataFrame:
    return _extremes(grouped_bar(df, x, y, aggregation))


def relationship_facts(df: DataFrame, x: str, y: str) -> DataFrame:
    """Pearson r on paired rows with its direction and strength; three pairs needed."""
    require(df, x, y)
    a, b = as_number(df, x), as_number(df, y)
    both = F.count(F.when(a.isNotNull() & b.isNotNull(), 1))
    wide = df.agg(
        both.alias("paired_rows"), (F.count(F.lit(1)) - both).alias("excluded_rows"),
        pearson(a, b).alias("r"),
    ).withColumn("r", F.when(F.col("paired_rows") >= 3, F.col("r")))
    size = F.abs("r")
    return wide.select(
        "paired_rows", "excluded_rows", F.col("r").alias("correlation"),
        F.when(F.col("r") > 0, "positive").when(F.col("r").isNotNull(), "negative").alias("direction"),
        F.when(size < WEAK_BELOW, "weak").when(size < MODERATE_BELOW, "moderate")
        .when(size.isNotNull(), "strong").alias("strength"),
    )


def category_facts(df: DataFrame, x: str) -> DataFrame:
    """Distinct values (NULL not counted), the top value with its share, missing rows."""
    counts = frequency_distribution(df, x)
    order = F.struct((-F.col("count")).alias("n"), F.col("category").isNull().alias("null"), "category")
    return counts.agg(
        F.count("category").alias("distinct_values"),
        F.min_by(F.col("category").cast("string"), order).alias("top"),
        F.max("percent").alias("top_percent"),
        F.coalesce(F.sum(F.when(F.col("category").isNull(), F.col("count"))), F.lit(0)).alias("missing"),
    )


def missing_facts(df: DataFrame) -> DataFrame:
    """All missing cells, and the three columns with the most."""
    total = missing_values(df).agg(F.sum("missing_count").alias("missing_cells"))
    worst = worst_missing(df).groupBy().agg(
        F.array_join(
            F.transform(
                F.sort_array(F.collect_list(F.struct((-F.col("missing_count")).alias("n"), "column"))),
                lambda c: c["column"],
            ),
            ",",
        ).alias("worst_columns")
    )
    one = F.lit(1)
    return total.withColumn("_one", one).join(worst.withColumn("_one", one), "_one").drop("_one")
