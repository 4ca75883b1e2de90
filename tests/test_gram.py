"""Correlations of wide tables against pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridloom.functions import gram
from gridloom.operators import profile


def _frame(width, rows=400, seed=3):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(rows, 8)) @ rng.normal(size=(8, width)) + rng.normal(size=(rows, width)) + 1e5
    frame = pd.DataFrame(base, columns=[f"c{i}" for i in range(width)])
    return frame.mask(rng.random(frame.shape) < 0.2)


def _spark(spark, frame):
    rows = [[None if pd.isna(v) else float(v) for v in r] for r in frame.itertuples(index=False)]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in frame.columns)).repartition(5)


def _agree(df, frame, names=("column_a", "column_b")):
    got = {(r[names[0]], r[names[1]]): r["correlation"] for r in df.collect()}
    want = frame.corr(min_periods=2)
    assert len(got) == len(frame.columns) * (len(frame.columns) - 1) // 2
    for (a, b), r in got.items():
        if np.isnan(want.loc[a, b]):
            assert r is None or np.isnan(r)
        else:
            assert r == pytest.approx(want.loc[a, b], abs=1e-7)


def test_wide_correlations(spark):
    frame = _frame(40)
    _agree(profile.correlations(_spark(spark, frame)), frame)


def test_wide_correlations_of_constants_and_gaps(spark):
    """Columns that are constant, empty, constant only where another holds, or hardly vary."""
    frame = _frame(24)
    frame["flat"], frame["none"] = 7.25, np.nan
    frame["tiny"] = 1e9 + np.where(np.arange(len(frame)) % 2 == 0, 0.0, 1e-3)
    frame["half"] = np.where(np.arange(len(frame)) % 2 == 0, 1.1, np.arange(len(frame)))
    frame["even"] = np.where(np.arange(len(frame)) % 2 == 0, frame["c0"].fillna(1.0), np.nan)
    df = _spark(spark, frame)
    got = {(r[0], r[1]): r[2] for r in profile.correlations(df).collect()}
    assert len(got) == 29 * 28 // 2
    assert all(r is None for pair, r in got.items() if {"flat", "none"} & set(pair))
    assert got["half", "even"] is None
    frame["tiny"] -= 1e9
    want = frame.corr()
    for a, b in (("c1", "tiny"), ("c2", "c3"), ("tiny", "half")):
        assert got[a, b] == pytest.approx(want.loc[a, b], abs=1e-6)


def test_blocks_of_columns(spark):
    """Beyond the columns of one scan, pairs of blocks give the same."""
    frame = _frame(11)
    df = _spark(spark, frame)
    rows, doubtful = gram.pair_correlations(df, scan_columns=6)
    assert not doubtful
    names = F.array(*map(F.lit, frame.columns))
    _agree(rows.select(F.get(names, F.col("a")).alias("column_a"), F.get(names, F.col("b")).alias("column_b"), "correlation"), frame)


def test_values_that_are_not_finite_and_empty_tables(spark):
    frame = _frame(24)
    df = _spark(spark, frame).withColumn("c3", F.when(F.col("c5") > 1e5, F.lit(float("inf"))).otherwise(F.col("c3")))
    got = {(r[0], r[1]): r[2] for r in profile.correlations(df).collect()}
    want = frame.corr()
    assert got["c0", "c1"] == pytest.approx(want.loc["c0", "c1"], abs=1e-7)
    assert len(got) == 24 * 23 // 2
    empty = {r[2] for r in profile.correlations(df.limit(0)).collect()}
    assert empty == {None}


def test_five_hundred_columns_take_one_scan(spark):
    frame = _frame(500, rows=60)
    df = _spark(spark, frame)
    sums = gram.pair_sums(df)
    assert sums._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    rows, doubtful = gram.pair_correlations(df)
    assert rows.count() + len(doubtful) == 500 * 499 // 2
