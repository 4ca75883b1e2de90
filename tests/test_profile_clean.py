import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows_as
from gridloom.operators import clean, eda, preview, profile
from gridloom.operators.prepare import fit_features, fit_preparation
from gridloom.operators.split import assign_folds, split_summary, split_train_test
from gridloom.plans.workflow import Workflow


def test_numeric_stats(small):
    stats = {r["column"]: r for r in profile.numeric_stats(small).collect()}
    assert set(stats) == {"age", "score"}
    age = stats["age"]
    assert (age["count"], age["missing"], age["mean"], age["q50"]) == (4, 1, 35.0, 35.0)
    assert age["std"] == pytest.approx(np.std([20, 30, 40, 50], ddof=1))
    assert (age["q25"], age["q75"], age["min"], age["max"]) == (27.5, 42.5, 20.0, 50.0)


def test_numeric_stats_without_numbers(small):
    assert profile.numeric_stats(small.select("name")).count() == 0


def test_categorical_stats(small):
    stats = {r["column"]: r for r in profile.categorical_stats(small).collect()}
    assert (stats["city"]["count"], stats["city"]["unique"], stats["city"]["top"], stats["city"]["frequency"], stats["city"]["missing"]) == (4, 3, "X", 2, 1)
    assert stats["name"]["top"] == "Ann"  # all equally frequent: the smallest


def test_all_null_text_column(spark):
    df = spark.createDataFrame([(None, 1), (None, 2)], "a string, b int")
    stats = profile.categorical_stats(df).first()
    assert (stats["count"], stats["unique"], stats["top"], stats["frequency"]) == (0, 0, None, 0)
    assert rows_as(profile.unique_counts(df), "column", "unique_values") == [("a", 0), ("b", 2)]
    assert rows_as(profile.constant_columns(df), "column") == [("a",)]


def test_missing_duplicates_quality(small, messy):
    missing = {r["column"]: (r["missing_count"], r["missing_pct"]) for r in profile.missing_values(small).collect()}
    assert missing["age"] == (1, 20.0) and missing["score"] == (0, 0.0)
    assert profile.duplicate_rows(messy).first()[0] == 1
    assert profile.duplicate_rows(small).first()[0] == 0
    assert rows_as(profile.constant_columns(small), "column") == [("status",)]
    assert profile.data_quality_score(small).first()[0] == pytest.approx(1 - 2 / 25)
    assert profile.missing_cells(small).first()[0] == 2
    assert rows_as(profile.columns_with_missing(small), "column") == [("age",), ("city",)]


def test_empty_table(spark):
    df = spark.createDataFrame([], "a int, b string")
    assert profile.data_quality_score(df).first()[0] == 0.0
    assert {r["missing_pct"] for r in profile.missing_values(df).collect()} == {0.0}
    assert profile.duplicate_rows(df).first()[0] == 0


def test_correlation_of_constant_is_left_out(spark):
    rows = [(float(i), 2.0 * i, 3.0, None if i == 2 else -float(i)) for i in range(6)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    top = {(r[0], r[1]): r[2] for r in profile.top_correlations(df).collect()}
    assert top == {("a", "b"): pytest.approx(1.0), ("a", "d"): pytest.approx(-1.0), ("b", "d"): pytest.approx(-1.0)}
    with pytest.raises(ValueError):
        profile.correlations(df.select("a"))


def test_defaults(spark, small):
    assert profile.default_features(small, "age") == ["score", "name", "city", "status"]
    assert profile.default_target(small) == "name"
    assert profile.default_target(small, "regression") == "age"


def test_preview(spark):
    df = spark.range(20).repartition(4)
    assert [r[0] for r in preview.head(df, ["id"], 3).collect()] == [0, 1, 2]
    assert [r[0] for r in preview.tail(df, ["id"], 3).collect()] == [17, 18, 19]
    a = preview.random_sample(df, 5, 1, ["id"]).collect()
    assert sorted(a) == sorted(preview.random_sample(df.repartition(7), 5, 1, ["id"]).collect())
    assert preview.random_sample(df, 99, 1, ["id"]).count() == 20


# Charts


def test_histogram_counts_no_null_and_keeps_empty_bins(spark):
    df = spark.createDataFrame([(v,) for v in [0.0, 0.1, 10.0, None]], "x double")
    bins = sorted(eda.histogram(df, "x", 5).collect())
    assert [r["count"] for r in bins] == [2, 0, 0, 0, 1]


def test_box_and_bar(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 2.0), ("a", 3.0), ("a", 4.0), ("a", 100.0), ("b", None), ("b", 5.0), (None, 7.0)],
        "g string, v double",
    )
    box = {r["g"]: r for r in eda.box_plot(df, "v", "g").collect()}
    assert box["a"]["outliers"] == 1 and box["a"]["whisker_high"] == 4.0 and None not in box
    means = dict(map(tuple, eda.grouped_bar(df, "g", "v", "mean").collect()))
    assert means == {"a": 22.0, "b": 5.0}
    sums = dict(map(tuple, eda.grouped_bar(df.filter("v is null"), "g", "v", "sum").collect()))
    assert sums == {"b": 0.0}


def test_density_integrates_and_refuses(spark):
    values = np.random.default_rng(0).normal(size=400)
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    points = sorted(eda.density(df, "x").collect())
    h = values.std(ddof=1) * 400 ** (-0.2)
    x0 = points[150]["x"]
    want = np.exp(-0.5 * ((x0 - values) / h) ** 2).sum() / (400 * h * np.sqrt(2 * np.pi))
    assert points[150]["density"] == pytest.approx(want, rel=1e-9) and len(points) == 300
    with pytest.raises(ValueError):
        eda.density(df.limit(1), "x")
    with pytest.raises(ValueError):
        eda.density(df.select(F.lit(1.0).alias("x")), "x")


def test_facts(spark):
    df = spark.createDataFrame([(1.0, 2.0, "u"), (2.0, 4.1, "u"), (3.0, 6.2, "v"), (50.0, None, None)], "x double, y double, c string")
    assert eda.skew_facts(df, "x").first()["shape"] == "right-skewed"
    facts = eda.relationship_facts(df, "x", "y").first()
    assert (facts["strength"], facts["direction"], facts["excluded_rows"]) == ("strong", "positive", 1)
    assert eda.relationship_facts(df.limit(2), "x", "y").first()["correlation"] is None
    cat = eda.category_facts(df, "c").first()
    assert (cat["distinct_values"], cat["top"], cat["missing"], cat["top_percent"]) == (2, "u", 1, 50.0)
    assert eda.missing_facts(df).first()["worst_columns"] == "c,y"
    flat = df.select(F.lit(4.0).alias("x"))
    assert eda.skew_facts(flat, "x").first()["shape"] == "constant"


# Cleaning


def test_missing_strategies(messy):
    assert clean.handle_missing(messy, ["age", "city"], "drop rows").count() == 6
    assert "age" not in clean.handle_missing(messy, ["age"], "drop columns").columns
    filled = clean.handle_missing(messy, ["age", "city"], "median")
    assert filled.filter("age is null").count() == 0
    assert filled.filter("city is null").count() == 1  # text is skipped
    assert clean.handle_missing(messy, ["city"], "mode").filter("city = 'X'").count() == 5
    assert clean.handle_missing(messy, ["nope"], "median").columns == messy.columns
    fills, warnings = clean.fit_fill_values(messy, ["city"], "median")
    assert fills == {} and len(warnings) == 1
    with pytest.raises(ValueError):
        clean.handle_missing(messy, ["age"], "magic")


def test_constant_fill_keeps_the_type(spark):
    df = spark.createDataFrame([(1, "a"), (None, None)], "n int, s string")
    done = clean.handle_missing(df, ["n", "s"], "constant", "0")
    assert dict(done.dtypes) == {"n": "int", "s": "string"} and done.filter("n = 0").count() == 1
    with pytest.raises(ValueError):
        clean.handle_missing(df, ["n"], "constant", "zero")


def test_all_null_column_is_left_alone(spark):
    df = spark.createDataFrame([(None, 1), (None, 2)], "a double, b int")
    assert clean.handle_missing(df, ["a"], "mean").filter("a is null").count() == 2
    assert clean.fit_fill_values(df, ["a"], "mean")[1]


def test_mode_orders_ties_as_numbers(spark):
    df = spark.createDataFrame([(10,), (9,), (None,)], "n int")
    assert clean.column_modes(df, ["n"]) == {"n": 9}


def test_median_of_whole_numbers_may_be_fractional(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "n int")
    assert sorted(r[0] for r in clean.handle_missing(df, ["n"], "median").collect()) == [1.0, 1.5, 2.0]


def test_outliers(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (5.0,), (100.0,), (None,)], "value double")
    mask = clean.outlier_mask(df, ["value"]).filter("value_outlier").collect()
    assert [r["value"] for r in mask] == [100.0]
    assert clean.outlier_counts(df, ["value"]).first()["outliers"] == 1
    assert clean.remove_outliers(df, ["value"]).count() == 6  # the NULL row stays
    tight = spark.createDataFrame([(v,) for v in [1, 2, 3, 4, 5, 6, 7, 15]], "value int")
    assert clean.outlier_counts(tight, ["value"], 1.0).first()["outliers"] == 1
    assert clean.outlier_counts(tight, ["value"], 3.0).first()["outliers"] == 0


def test_encoding(messy):
    hot = clean.encode_categorical(messy, ["city"], "one-hot")
    assert hot.columns[-3:] == ["city_X", "city_Y", "city_Z"] and "city" not in hot.columns
    assert hot.filter("city_X + city_Y + city_Z = 0").count() == 1
    codes = clean.encode_categorical(messy, ["city"], "label", window_rows=1)
    assert sorted(r["city"] for r in codes.collect()) == [-1, 0, 0, 0, 0, 1, 1, 2]
    assert codes.columns == messy.columns
    with pytest.raises(ValueError):
        clean.encode_categorical(messy, ["name"], "one-hot", max_categories=3)


def test_scaling(messy):
    full = messy.dropna()
    age = [r["age"] for r in clean.scale_numeric(full, ["age"], "StandardScaler").collect()]
    assert np.mean(age) == pytest.approx(0, abs=1e-9) and np.std(age) == pytest.approx(1)
    unit = [r["age"] for r in clean.scale_numeric(full, ["age"], "MinMaxScaler").collect()]
    assert (min(unit), max(unit)) == (0.0, 1.0)
    with pytest.raises(ValueError):
        clean.scale_numeric(messy, ["age"])
    flat = full.withColumn("f", F.lit(0.1))
    for method in clean.SCALING_METHODS:
        assert {r["f"] for r in clean.scale_numeric(flat, ["f"], method).select(F.round("f", 9).alias("f")).collect()} == {0.0}


def test_duplicates_and_comparison(messy):
    once = clean.remove_duplicates(messy)
    assert once.count() == 7
    report = {r["metric"]: (r["before"], r["after"]) for r in profile.compare_before_after(messy, once).collect()}
    assert report["Rows"] == (8, 7) and report["Duplicate rows"] == (1, 0) and report["Missing cells"] == (2, 2)


# Splits and preparation


def test_split_sizes_and_repeatability(spark, messy):
    df = messy.dropna()
    for stratify in (False,):
        split = split_train_test(df.dropDuplicates(), "status", ["name"], 0.25, 42, stratify)
        assert sorted(r["split"] for r in split.collect()).count("test") == 2
    a = split_train_test(df, "status", None, 0.25)  # the whole row is the key, two rows are equal
    assert a.groupBy("split").count().orderBy("split").collect()[0][1] == 2 and a.count() == 6
    summary = split_summary(split_train_test(df, "status", None, 0.25), "status").first()
    assert (summary["train_rows"], summary["test_rows"], summary["features"]) == (4, 2, 4)
    with pytest.raises(ValueError):
        split_train_test(df, "nope")
    with pytest.raises(ValueError):
        split_train_test(df, "status", None, 1.0)


def test_stratified_split_and_folds(spark):
    df = spark.range(1000).withColumn("c", F.when(F.col("id") < 900, "big").otherwise("small"))
    split = split_train_test(df, "c", ["id"], 0.2, 42, True)
    counts = {(r["c"], r["split"]): r["count"] for r in split.groupBy("c", "split").count().collect()}
    assert counts == {("big", "test"): 180, ("big", "train"): 720, ("small", "test"): 20, ("small", "train"): 80}
    with pytest.raises(ValueError):
        split_train_test(df.withColumn("c", F.when(F.col("id") == 0, "one").otherwise("rest")), "c", ["id"], stratify=True)
    folds = assign_folds(df, ["id"], 3, 1, "c")
    sizes = {(r["c"], r["fold"]): r["count"] for r in folds.groupBy("c", "fold").count().collect()}
    assert sizes == {("big", 0): 300, ("big", 1): 300, ("big", 2): 300, ("small", 0): 34, ("small", 1): 33, ("small", 2): 33}
    with pytest.raises(ValueError):
        assign_folds(df.filter("id > 895"), ["id"], 5, 1, "c").count() and assign_folds(df.filter("id > 897 and id < 903"), ["id"], 5, 1, "c")


def test_preparation(spark, messy):
    assert fit_preparation(messy) is None
    fitted = fit_preparation(messy, impute_columns=["age"], encode_columns=["city"], scale_columns=["age", "score"])
    out = fitted.apply(messy)
    assert out.columns == ["age", "city_X", "city_Y", "city_Z", "city_nan", "score", "name", "status"]
    assert out.filter("age is null").count() == 0
    fresh = spark.createDataFrame([(1.0, 1.0, "N", "NEW", "p")], messy.schema)
    row = fitted.apply(fresh).first()
    assert (row["city_X"], row["city_Y"], row["city_Z"], row["city_nan"]) == (0, 0, 0, 0)
    codes = fit_preparation(messy, encode_columns=["city"], encode_method="label")
    assert codes.apply(fresh).first()["city"] == -1
    assert codes.apply(messy.filter("city is null")).first()["city"] is None


def test_feature_table_vectors_match_columns(spark, messy):
    fitted = fit_features(messy, ["age", "score", "city", "name", "unknown"])
    wide = [tuple(r)[1:] for r in fitted.columns(messy, ["name"]).collect()]
    vectors = [list(r["features"].toArray()) for r in fitted.vectors(messy, ["name"]).collect()]
    assert len(fitted.names) == len(vectors[0])
    np.testing.assert_allclose(np.array(wide, dtype=float), np.array(vectors))
    ages = [25, 30, 25, 35, 30, 45, 50, 28]  # the hole takes the median of the others
    assert fitted.scaler["age"][0] == pytest.approx(np.mean(ages))
    assert fitted.scaler["age"][1] == pytest.approx(np.std(ages))
    assert fit_features(messy.select(F.current_date().alias("d")), ["d"]) is None


def test_workflow(messy):
    flow = Workflow(
        missing={"columns": ["age"], "strategy": "mean"}, duplicates=True, outliers={"columns": ["score"]},
        encode={"columns": ["city"], "method": "label"}, scale={"columns": ["score"]},
        split={"target": "status", "keys": ["name"], "test_size": 0.25},
    )
    done = flow.run(messy)
    assert done.count() == 7 and done.filter("split = 'test'").count() == 2 and done.filter("age is null").count() == 0
    split, fitted = flow.fit_on_train(messy)
    assert set(fitted.fills) == {"age"} and fitted.apply(split).count() == 8
