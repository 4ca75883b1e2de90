"""Quantiles, orderings and partitions: the large-table paths against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.functions import ordering, quantiles, sampling, storage
from gridloom.functions.columns import blank_nan, categorical_columns, numeric_columns


def frame(spark, values, parts=5):
    rows = [(None if v is None else float(v),) for v in values]
    return spark.createDataFrame(rows, "x double").repartition(parts)


PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


@pytest.mark.parametrize("limit", [20, 10_000_000])
@pytest.mark.parametrize("kind", ["normal", "heavy", "two hot values", "few"])
def test_column_quantiles_match_numpy(spark, kind, limit):
    rng = np.random.default_rng(1)
    values = {
        "normal": rng.normal(size=3000),
        "heavy": rng.pareto(0.4, 3000) * 1e6,
        # Two values hold almost everything, and the wanted ranks lie between them.
        "two hot values": np.r_[np.zeros(1500), rng.uniform(0, 1, 301), np.ones(1500)],
        "few": rng.integers(0, 7, 3000).astype(float),
    }[kind]
    found, _ = quantiles.column_quantiles(frame(spark, values), ["x"], PROBS, limit, sketch=50)
    assert found["x"] == pytest.approx(list(np.quantile(values, PROBS)), rel=1e-12, abs=1e-12)


def test_column_quantiles_skip_nulls_and_all_null(spark):
    df = frame(spark, [None, 1, None, 2, 4]).withColumn("y", F.lit(None).cast("double"))
    found, _ = quantiles.column_quantiles(df, ["x", "y"], [0.5])
    assert found == {"x": [2.0], "y": [None]}


def test_quantile_guess_may_miss_and_is_put_right(spark, monkeypatch):
    # A guess from a handful of rows is mostly wrong; the count must notice.
    monkeypatch.setattr(quantiles, "GUESS_ROWS", 100)
    values = np.random.default_rng(5).exponential(size=2000)
    found, _ = quantiles.column_quantiles(frame(spark, values), ["x"], [0.25, 0.5], 20, sketch=1000)
    assert found["x"] == pytest.approx(list(np.quantile(values, [0.25, 0.5])), rel=1e-12)


@pytest.mark.parametrize("window_rows", [10, 1_000_000])
def test_grouped_quantiles_with_a_hot_group(spark, window_rows):
    rng = np.random.default_rng(2)
    data = [("hot", float(v)) for v in rng.normal(size=900)] + [("cold", float(v)) for v in range(7)]
    data += [("empty", None), (None, 3.0)]
    df = spark.createDataFrame(data, "g string, v double").repartition(6)
    found = {r["g"]: r for r in quantiles.grouped_quantiles(df, "g", "v", [0.25, 0.5], window_rows).collect()}
    assert set(found) == {"hot", "cold"}
    for g in found:
        values = [v for k, v in data if k == g]
        assert found[g]["n"] == len(values)
        assert found[g]["q"] == pytest.approx(list(np.quantile(values, [0.25, 0.5])))


@pytest.mark.parametrize("descending", [False, True])
def test_running_sums_over_slices_equal_the_window(spark, descending):
    df = spark.range(1000).select(
        F.when(F.col("id") < 800, "a").otherwise("b").alias("g"), F.col("id").alias("o"), (F.col("id") % 7).alias("s")
    )
    both = [
        sorted(map(tuple, ordering.running_sums(df, ["g"], ["o"], ["s"], 1000, limit, descending).collect()))
        for limit in (10, 10_000)
    ]
    assert both[0] == both[1]


def test_position_codes_over_slices(spark):
    values = spark.range(500).select(F.concat(F.lit("v"), F.col("id")).alias("v"))
    codes = {r["v"]: r["code"] for r in ordering.position_codes(values, "v", 500, 10).collect()}
    assert codes == {v: i for i, v in enumerate(sorted(codes))}


def sizes_of(df, name="part"):
    return {r[0]: r[1] for r in df.groupBy(name).count().collect()}


@pytest.mark.parametrize("fine_rows", [1, 10**9])
def test_parts_are_exact_and_do_not_depend_on_layout(spark, fine_rows):
    df = spark.range(2000).withColumn("x", F.col("id") * 2)
    sizes = {None: [300, 0, 500, 1200]}
    a = sampling.assign_parts(df, ["id"], 42, sizes, fine_rows=fine_rows)
    b = sampling.assign_parts(df.repartition(13), ["id"], 42, sizes)
    assert sizes_of(a) == {0: 300, 2: 500, 3: 1200}
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    c = sampling.assign_parts(df, ["id"], 43, sizes)
    assert sorted(map(tuple, a.collect())) != sorted(map(tuple, c.collect()))


def test_many_classes_take_the_distributed_way(spark, monkeypatch):
    df = spark.range(1200).withColumn("c", F.concat(F.lit("c"), F.col("id") % 40))
    parts = {f"c{i}": [10, 20] for i in range(40)}
    few = sampling.assign_parts(df, ["id"], 9, parts, by="c")
    monkeypatch.setattr(sampling, "FEW_CUTS", 0)
    many = sampling.assign_parts(df, ["id"], 9, parts, by="c", fine_rows=1)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))
    assert sizes_of(many) == {0: 400, 1: 800}


def test_parts_when_a_third_of_the_rows_share_a_key(spark):
    df = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.col("id").alias("x")
    )
    parts = sampling.assign_parts(df, ["k"], 1, {None: [100] * 9})
    assert sizes_of(parts) == {i: 100 for i in range(9)}
    assert parts.select("k", "x").exceptAll(df).count() == 0 and parts.count() == 900


def test_parts_of_exact_copies(spark):
    df = spark.range(600).select(F.when(F.col("id") < 400, "same").otherwise(F.col("id").cast("string")).alias("t"))
    parts = sampling.assign_parts(df, None, 3, {None: [150, 150, 300]})
    assert sizes_of(parts) == {0: 150, 1: 150, 2: 300}
    assert parts.select("t").exceptAll(df).count() == 0 and parts.count() == 600


def test_share_out_uses_largest_remainders():
    assert sampling.share_out({"a": 5, "b": 5, "c": 2}, 4) == {"a": 2, "b": 2, "c": 0}  # equal remainders: smaller labels first
    assert sum(sampling.share_out({"x": 333, "y": 333, "z": 334}, 201).values()) == 201


def test_take_rows_small_and_large_agree(spark):
    df = spark.range(500)
    a = sampling.take_rows(df, 40, ["id"], 5)
    b = sampling.take_rows(df, 40, ["id"], 5, report_rows=1)
    assert sorted(a.collect()) == sorted(b.collect())
    assert sampling.take_rows(df, 9999, ["id"], 5, report_rows=1).count() == 500


def test_nan_becomes_null_and_kinds(spark):
    df = spark.createDataFrame([(float("nan"), True, "a", 1)], "x double, b boolean, s string, i int")
    assert blank_nan(df).first()["x"] is None
    assert numeric_columns(df) == ["x", "i"] and categorical_columns(df) == ["b", "s"]


def test_shared_dir_comes_from_the_session(spark):
    named = spark.conf.get(storage.SETTING, None)
    if named:
        assert storage.shared_dir(spark) == named
    assert storage.cut_lineage(spark.range(5)).count() == 5


def test_samples_of_a_shared_key_do_not_depend_on_layout(spark):
    df = spark.range(100).selectExpr("id % 5 AS k", "id AS v")
    picks = set()
    for parts in (1, 3, 7):
        for limit in (0, 1000):
            rows = sampling.take_rows(df.repartition(parts), 13, ["k"], 42, report_rows=limit).collect()
            picks.add(tuple(sorted((r["k"], r["v"]) for r in rows)))
    assert len(picks) == 1 and len(next(iter(picks))) == 13


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Context:
        master = "spark://somewhere:7077"

        def getConf(self):
            return self

        def get(self, key, default=None):
            return default

    class Session:
        conf = sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage.shared_dir(Session())


def test_null_keys_are_spread_before_a_code_join(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("z",), (None,)], "c string")
    codes = spark.createDataFrame([("a", 0), ("b", 1)], "_v string, code long")
    got = ordering.join_codes(df, "c", codes, "n").collect()
    assert sorted(map(str, ((r["c"], r["n"]) for r in got))) == sorted(
        map(str, [("b", 1), (None, None), ("a", 0), ("z", None), (None, None)])
    )
