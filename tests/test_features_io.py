import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows_as
from gridloom.errors import DataLoadError
from gridloom.operators import clean, eda, features as fe
from gridloom.plans import chain
from gridloom.plans.chain import OpChain, apply_feature_op, fold_ops
from gridloom.sources.readers import load_table
from gridloom.sources.writers import write_csv, write_result


@pytest.fixture(scope="module")
def numbers(spark):
    rows = [(25, 100, 1), (30, 200, 2), (35, 300, 3), (40, 400, 4), (45, 500, 5)]
    return spark.createDataFrame(rows, "age int, income int, score int")


def test_arithmetic_and_names(numbers):
    df = fe.create_numeric_feature(numbers, "age", "score", "sum")
    df = fe.create_numeric_feature(df, "income", "score", "ratio", "r")
    row = df.filter("score = 2").first()
    assert (row["age_plus_score"], row["r"]) == (32, 100.0)
    with pytest.raises(ValueError):
        fe.create_numeric_feature(numbers, "age", "nope")
    zero = numbers.withColumn("score", F.col("score") - 1)
    with pytest.raises(ValueError):
        fe.create_numeric_feature(zero, "age", "score", "ratio")
    assert fe.create_numeric_feature(zero, "age", "score", "ratio", on_zero="null").filter("age_over_score is null").count() == 1


def test_products_do_not_overflow(spark):
    df = spark.createDataFrame([(2_000_000_000, 2_000_000_000)], "a int, b int")
    assert fe.create_interaction(df, "a", "b").first()["a_x_b"] == 4 * 10**18


def test_math_guards(spark, numbers):
    assert "age_log" in fe.apply_math_transform(numbers, ["age"], "log").columns
    assert rows_as(fe.apply_math_transform(numbers, ["score"], "square"), "score_squared") == [(1,), (16,), (25,), (4,), (9,)]
    bad = spark.createDataFrame([(0.0, -1.0)], "z double, m double")
    for column, method in (("z", "log"), ("m", "sqrt")):
        with pytest.raises(ValueError):
            fe.apply_math_transform(bad, [column], method)


def test_bins(spark):
    df = spark.range(1, 21).select(F.col("id").alias("x"))
    q = fe.bin_numeric(df, "x", 4, "quantile")
    assert sorted(r["count"] for r in q.groupBy("x_binned").count().collect()) == [5, 5, 5, 5]
    w = fe.bin_numeric(df, "x", 4, "equal width", ["a", "b", "c", "d"])
    assert {r["x_bin"]: r["x_binned"] for r in w.collect()} == {1: "a", 2: "b", 3: "c", 4: "d"}
    ages = spark.createDataFrame([(25,), (35,), (45,), (None,)], "age int")
    shown = fe.bin_numeric(ages, "age", 2, "equal width")
    assert {r["age"]: r["age_binned"] for r in shown.collect()} == {
        25: "(24.979, 35.0]", 35: "(24.979, 35.0]", 45: "(35.0, 45.0]", None: None
    }
    flat = fe.bin_numeric(df.select(F.lit(5.0).alias("x")), "x", 2, "equal width")
    assert flat.select("x_bin").distinct().count() == 1


def test_date_and_text_parts(spark):
    df = spark.createDataFrame([("2024-01-01", " two  words "), ("bad", ""), (None, None)], "d string, t string")
    parts = fe.extract_datetime_features(df, "d", fe.DATETIME_PARTS)
    assert rows_as(parts, "d_year", "d_month", "d_day", "d_weekday")[0] == (2024, 1, 1, 0)
    assert parts.filter("d_year is null").count() == 2
    typed = spark.createDataFrame([(datetime.date(2024, 3, 10),)], "d date")
    assert fe.extract_datetime_features(typed, "d", ["weekday"]).first()["d_weekday"] == 6
    with pytest.raises(ValueError):
        fe.extract_datetime_features(df, "t", ["year"])
    text = fe.extract_text_features(df, "t", fe.TEXT_PARTS)
    assert rows_as(text, "t_length", "t_word_count") == [(0, 0), (12, 2), (None, None)]
    assert fe.extract_text_features(df, "t", ["length"], "nan").filter("t_length = 3").count() == 1


def test_polynomial(spark, numbers):
    df = spark.createDataFrame([(2.0, 3.0)], "a double, b double")
    out = fe.create_polynomial_features(df, ["a", "b"], 2)
    assert out.columns == ["a", "b", "a_pow2", "a_x_b", "b_pow2"] and tuple(out.first())[2:] == (4.0, 6.0, 9.0)
    with pytest.raises(ValueError):
        fe.create_polynomial_features(df.withColumn("a", F.lit(None).cast("double")), ["a"])


def test_selection(spark):
    df = spark.createDataFrame([(1.0, 7.0, 1.0), (2.0, 7.0, 1.5), (3.0, 7.0, 2.0), (4.0, 7.0, 3.0)], "a double, b double, c double")
    assert fe.select_by_variance(df, ["a", "b", "c"]).columns == ["a", "c"]
    with pytest.raises(ValueError):
        fe.select_by_variance(df, ["b"])
    rows = [(1.0, 1.1, 5.0, "x"), (2.0, 2.1, 1.0, "y"), (3.0, 2.9, 4.0, "x"), (4.0, 4.2, 2.0, "y"), (5.0, 4.8, 3.0, "x")]
    target = spark.createDataFrame(rows, "target double, strong double, weak double, s string")
    assert fe.select_by_correlation(target, "target", 0.8).columns == ["target", "strong", "s"]
    with pytest.raises(ValueError):
        fe.select_by_correlation(target, "s")


def test_chain(numbers):
    chain = OpChain().add("math", columns=["age"], method="sqrt").add("interaction", col_a="age", col_b="score")
    assert chain.replay(numbers).columns[-2:] == ["age_sqrt", "age_x_score"]
    assert chain.undo().replay(numbers).columns[-1] == "age_sqrt"
    assert chain.reset().replay(numbers).columns == numbers.columns
    broken = chain.add("numeric", col_a="age", col_b="none").add("math", columns=["score"], method="log")
    assert broken.replay(numbers).columns == chain.replay(numbers).columns
    with pytest.raises(ValueError):
        apply_feature_op(numbers, {"key": "zzz", "params": {}})
    assert fold_ops(numbers, []).columns == numbers.columns
    effect = fe.operation_effect(numbers, chain.replay(numbers).drop("income"))
    assert rows_as(effect, "change", "column", "filled") == [
        ("added", "age_sqrt", 5), ("added", "age_x_score", 5), ("removed", "income", 5)
    ]


# Files


def test_csv_missing_tokens_types_and_bom(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_bytes("﻿id,x,flag,note,all\n1,1.5,True,nan,\n2,NA,False,\"a,b\",NULL\n3,,True,c d,\n".encode())
    df = load_table(spark, str(path))
    assert dict(df.dtypes) == {"id": "bigint", "x": "double", "flag": "boolean", "note": "string", "all": "double"}
    assert rows_as(df, "id", "x", "note") == [(1, 1.5, None), (2, None, "a,b"), (3, None, "c d")]


def test_csv_latin_1(spark, tmp_path):
    path = tmp_path / "l.csv"
    path.write_bytes(b"name,v\ncaf\xe9,1\n")
    assert load_table(spark, "l.csv", base_dir=str(tmp_path)).first()["name"] == "café"


@pytest.mark.parametrize("content", [b"", b"a,b\n", b'a,b\n1,"open\n', b"a,b\n1,2,3\n"])
def test_bad_csv(spark, tmp_path, content):
    path = tmp_path / "bad.csv"
    path.write_bytes(content)
    with pytest.raises(DataLoadError):
        load_table(spark, str(path))


def test_short_line_is_padded(spark, tmp_path):
    path = tmp_path / "short.csv"
    path.write_text("a,b\n1\n2,x\n")
    assert rows_as(load_table(spark, str(path)), "a", "b") == [(1, None), (2, "x")]


def test_load_errors(spark, tmp_path):
    for name in ("x.txt", "x.xlsx", "missing.csv", "missing.parquet"):
        with pytest.raises(DataLoadError):
            load_table(spark, str(tmp_path / name))


def test_writers(spark, tmp_path, numbers):
    back = load_table(spark, write_csv(numbers, str(tmp_path / "n.csv")))
    assert rows_as(back, "age", "income", "score") == rows_as(numbers, "age", "income", "score")
    report = spark.createDataFrame([("m", 0.123456)], "model string, score double")
    assert load_table(spark, write_result(report, str(tmp_path / "r.csv"))).first()["score"] == 0.1235


def test_csv_quotes_and_wide_numbers(spark, tmp_path):
    """Bare quotes are text, quoted cells may hold line breaks, whole numbers stay exact."""
    path = tmp_path / "q.csv"
    big, small = "1234567890123456789", "1234567890123456788"
    path.write_text(f'id,size,note\n{big},5" pipe,"one\ntwo, ""three"""\n{small},2" x 4",plain\n')
    df = load_table(spark, str(path))
    assert dict(df.dtypes)["id"] == "bigint"
    rows = sorted(tuple(r) for r in df.collect())
    assert rows == [(int(small), '2" x 4"', "plain"), (int(big), '5" pipe', 'one\ntwo, "three"')]
    path.write_text("a,b\n" + "9" * 25 + "," + "9" * 45 + "\n1,2\n")
    df = load_table(spark, str(path))
    assert dict(df.dtypes) == {"a": "decimal(38,0)", "b": "string"}
    assert {str(r["a"]) for r in df.collect()} == {"9" * 25, "1"}
    path.write_text('a,b\n1,"open\n2,3\n')
    with pytest.raises(DataLoadError, match="never closed"):
        load_table(spark, str(path))


def test_a_replay_tells_where_it_stopped(numbers):
    ops = [
        {"key": "math", "params": {"columns": ["age"], "method": "square"}},
        {"key": "nonsense", "params": {}}, {"key": "math", "params": {"columns": ["age"], "method": "sqrt"}},
    ]
    df, failure = chain.replay_ops(numbers, ops)
    assert "age_squared" in df.columns and (failure.step, failure.key) == (1, "nonsense") and "nonsense" in failure.error
    assert chain.replay_ops(numbers, ops[:1])[1] is None


def test_warnings_come_back(spark):
    df = spark.createDataFrame([(None, 1, "x"), (None, 2, None)], "a double, b int, c string")
    told = []
    filled = clean.handle_missing(df, ["a", "b", "c"], "median", warnings=told)
    assert filled.columns == df.columns and len(told) == 2
    assert any("`a`" in w for w in told) and any("`c`" in w for w in told)


def test_correlations_behind_a_choice(spark):
    df = spark.createDataFrame([(float(i), i * 2.0, float(i % 2), 3.0) for i in range(10)], "t double, strong double, weak double, flat double")
    rows = {r["feature"]: (r["correlation"], r["kept"]) for r in fe.correlation_choice(df, "t", 0.8).collect()}
    assert rows["strong"] == (pytest.approx(1.0), True) and rows["flat"] == (None, False) and not rows["weak"][1]


def test_pairs_of_many_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0, 5.0)], "a double, b double, c double, d double, e double")
    assert eda.pairwise_points(df, df.columns).count() == 10
    with pytest.raises(ValueError):
        eda.pairwise_points(df, df.columns, most=4)
