"""Train/test splits and cross-validation folds with exact sizes, by key hash."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import col, require
from ..functions.sampling import MAX_CLASSES, assign_planned_parts, share_out

TRAIN, TEST = "train", "test"
SPLIT = "split"


def split_train_test(
    df: DataFrame,
    target: str,
    keys: list[str] | None = None,
    test_size: float = 0.2,
    random_state: int = 42,
    stratify: bool = False,
    max_classes: int = MAX_CLASSES,
) -> DataFrame:
    """Add ``split`` ('train'/'test'); the test side has exactly ceil(n * test_size) rows.

    ``keys`` identify a row. With ``stratify`` every class keeps its share on both sides;
    more than ``max_classes`` classes are refused.
    """
    if target not in df.columns:
        raise ValueError(f"The table has no column `{target}` to split by.")
    require(df, *(keys or []))

    def plan(sizes: dict) -> dict:
        n = sum(sizes.values())
        test = math.ceil(n * test_size)
        if not 0 < test < n:
            raise ValueError(f"A test share of {test_size} of {n} rows leaves one side empty.")
        if not stratify:
            return {None: [test, n - test]}
        if sizes.pop(None, 0):
            raise ValueError("Rows without a target cannot be stratified; filter them first.")
        if min(sizes.values()) < 2 or min(test, n - test) < len(sizes):
            raise ValueError(
                "Some class is too small for a stratified split: two rows per class are the "
                "minimum, and each side must have room for every class."
            )
        quota = share_out(sizes, test)
        return {c: [quota[c], sizes[c] - quota[c]] for c in sizes}

    by = target if stratify else None
    placed = assign_planned_parts(df, keys, random_state, plan, by, SPLIT, max_classes=max_classes)
    side = F.when(F.col(SPLIT) == 0, TEST).otherwise(TRAIN)
    return placed.withColumn(SPLIT, side)


def split_summary(split: DataFrame, target: str) -> DataFrame:
    """Train rows, test rows, feature count and the number of train classes, one row."""
    train = F.col(SPLIT) == TRAIN
    return split.agg(
        F.count(F.when(train, 1)).alias("train_rows"),
        F.count(F.when(~train, 1)).alias("test_rows"),
        F.lit(len(split.columns) - 2).alias("features"),
        F.count_distinct(F.when(train, col(target))).alias("train_classes"),
    )


def fold_sizes(n: int, folds: int) -> list[int]:
    return [n // folds + (1 if i < n % folds else 0) for i in range(folds)]


def assign_folds(
    df: DataFrame,
    keys: list[str] | None = None,
    n_folds: int = 5,
    random_state: int = 42,
    target: str | None = None,
    max_classes: int = MAX_CLASSES,
) -> DataFrame:
    """Add ``fold`` (0 to n_folds-1); with a target every class is spread over all folds."""
    if n_folds < 2:
        raise ValueError("Ask for two folds or more.")

    def plan(sizes: dict) -> dict:
        if target is None:
            n = sizes[None]
            if n < n_folds:
                raise ValueError(f"{n} rows cannot be spread over {n_folds} folds.")
            return {None: fold_sizes(n, n_folds)}
        sizes.pop(None, None)
        if not sizes or min(sizes.values()) < n_folds:
            raise ValueError(
                f"The smallest class has fewer than {n_folds} rows, so some fold would miss it."
            )
        return {c: fold_sizes(k, n_folds) for c, k in sizes.items()}

    return assign_planned_parts(df, keys, random_state, plan, target, "fold", max_classes=max_classes)
