"""Connected components of a table of links, without collecting any."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.storage import cut_lineage
from .common import fitting


def mapped(df: DataFrame, column: str, names: DataFrame) -> DataFrame:
    """``column`` replaced by its label in ``node, label``, where there is one."""
    to = fitting(names.select(F.col("node").alias("_node"), F.col("label").alias("_label")))
    joined = df.join(to, F.col(column) == F.col("_node"), "left")
    return joined.withColumn(column, F.coalesce("_label", column)).drop("_node", "_label")


def _parents(links: DataFrame) -> DataFrame:
    """``node, label`` of the nodes with a smaller neighbour: the end of the way down.

    ``links`` has ``a < b``. Only nodes that move are joined, so no root gathers its tree.
    """
    moved = cut_lineage(links.groupBy("b").agg(F.min("a").alias("label")).withColumnRenamed("b", "node"))
    while True:
        after = mapped(moved.withColumn("old", F.col("label")), "label", moved)
        after = cut_lineage(after)
        moved = after.select("node", "label")
        if after.filter("old <> label").isEmpty():
            return moved


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for links ``a, b``: the smallest node of the component.

    A node that is the smaller end of no link hangs on its smallest neighbour, and links its
    other neighbours with that one; so the many members of a star leave in one step. Among
    the rest every node goes down to a smaller neighbour until there is none, links are
    carried over to where their ends went, and what has become a loop or equal to another
    link is dropped; that at least halves the nodes, and goes on until no link is left.
    Every step is written once; minima are added up before each shuffle. No links give no
    rows.
    """
    links = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b")
    links = cut_lineage(links.distinct())
    inner = links.select(F.col("a").alias("b")).distinct()
    outer = links.join(inner, "b", "left_anti")
    hung = cut_lineage(outer.groupBy("b").agg(F.min("a").alias("low")))
    across = outer.join(hung, "b").select(F.col("low").alias("a"), F.col("a").alias("b")).filter("a <> b")
    left = cut_lineage(links.join(inner, "b", "left_semi").select("a", "b").unionByName(across).distinct())
    ends = links.select(F.col("a").alias("node")).distinct().withColumn("label", F.col("node"))
    labels = cut_lineage(ends)
    while not left.isEmpty():
        moved = _parents(left)
        labels = cut_lineage(mapped(labels, "label", moved))
        carried = mapped(mapped(left, "a", moved), "b", moved)
        carried = carried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        left = cut_lineage(carried.filter("a <> b").distinct())
    leaves = mapped(hung.select(F.col("b").alias("node"), F.col("low").alias("label")), "label", labels)
    return cut_lineage(labels.unionByName(leaves))
