"""Each operator on rows that a corpus should not have but does."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridloom.llm import common, copies, extraction, mixing, near, quality, urls

NAMES = ["rules", "tokens", "copies", "pieces", "mixing", "near", "private", "quality"]


@pytest.mark.parametrize("name", NAMES)
def test_one_row_per_row(operators, odd, name):
    got = [r["doc_id"] for r in operators[name](odd).collect()]
    want = [r["doc_id"] for r in odd.select("doc_id").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(operators, none, name):
    assert operators[name](none).collect() == []


@pytest.mark.parametrize("name", NAMES)
def test_layout_does_not_matter(operators, odd, name):
    one, many = (sorted(map(str, operators[name](odd.repartition(n)).collect())) for n in (1, 5))
    assert one == many


def test_null_text_counts_as_empty(operators, odd):
    by = {r.doc_id: r for r in operators["tokens"](odd).collect()}
    assert (by[3].n_bytes, by[3].n_tokens, by[3].over_limit) == (0, 0, False)
    by = {r.doc_id: r for r in operators["copies"](odd).collect()}
    assert by[3].group_size == by[4].group_size == 3 and by[4].kept and not by[3].kept
    by = {r.doc_id: r for r in operators["private"](odd).collect()}
    assert by[3].spans == "" and by[3].n_card == 0
    by = {r.doc_id: r for r in operators["rules"](odd).collect()}
    assert by[3].n_words == 0 and by[3].base_failed and not by[3].kept
    by = {r.doc_id: r for r in operators["pieces"](odd).collect()}
    assert by[3].n_tokens == 1 and by[3].ids_sha256 == by[4].ids_sha256


def test_repeated_rows_leave_one(odd):
    for dedup in (copies.exact_dedup, near.near_dedup):
        left = dedup(odd)
        assert left.columns == odd.columns
        same = left.filter(F.col("text").startswith("the same")).collect()
        assert len(same) == 1
        wordless = left.filter(F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), "\\s+", "")) == "").count()
        assert wordless == (2 if dedup is copies.exact_dedup else 1)


def test_stages_keep_columns(odd, labels):
    model = quality.fit_quality(odd, labels)
    assert quality.keep_good(odd, model).columns == odd.columns
    assert mixing.mix_rows(odd).columns == odd.columns
    counts = {r[0]: r[1] for r in mixing.mix_rows(odd).groupBy("doc_id").count().collect()}
    taken = mixing.mix(odd).groupBy("doc_id").agg(F.sum("copies").alias("n")).filter("n > 0").collect()
    assert counts == {r.doc_id: r.n for r in taken}


def test_pages(spark):
    rows = [
        (1, "http://a.com/x", None, 1), (2, None, "", 2), (2, None, "", 2), (None, "", "plain & text", None),
        (3, "no mark", "<p>" * 5000, 3), (4, "HTTP://User@A.NET:80/En?q#f", "<p>cut off <b", 4),
        (5, "://net/", "<nav>" + "<li><a href=x>a</a>" * 3000, 5),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text long").withColumn("rule", F.lit(1))
    texts = extraction.extract_main_text(pages)
    assert texts.columns == ["page_id", "url", "text", "n_chars"]
    got = texts.collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    judged = urls.judge_urls(pages).collect()
    assert len(judged) == len(rows)
    by = {r.page_id: r for r in judged}
    assert (by[2].host, by[2].path, by[2].rule, by[2].verdict) == ("", "", None, "allow")
    assert (by[4].host, by[4].path) == ("user@a.net:80", "/En")
    assert (by[5].host, by[5].path, by[5].rule, by[5].verdict) == ("net", "/", "net/", "block")
    assert extraction.extract_main_text(pages.limit(0)).collect() == [] and urls.judge_urls(pages.limit(0)).collect() == []


def test_batches_are_bounded_by_bytes(spark):
    """Long texts reach a worker a few at a time; a bound that the user has set stays."""
    setting = common._BATCH_SETTING
    before = spark.conf.get(setting)
    sizes = lambda batches: (pa.RecordBatch.from_pydict({"rows": [b.num_rows], "bytes": [b.nbytes]}) for b in batches)
    long = spark.range(0, 40, 1, 1).select(F.repeat(F.lit("x"), 1 << 20).alias("text"))
    try:
        spark.conf.set(setting, common._BATCH_DEFAULT)
        got = common.map_batches(long, sizes, "rows long, bytes long").collect()
        assert sum(r.rows for r in got) == 40 and max(r.bytes for r in got) <= common.BATCH_BYTES + (2 << 20)
        spark.conf.set(setting, "1000000")
        got = common.map_batches(long, sizes, "rows long, bytes long").collect()
        assert sum(r.rows for r in got) == 40 and max(r.rows for r in got) <= 2
    finally:
        spark.conf.set(setting, before)


def test_quality_model_of_repeated_ids_ignores_the_layout(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    known = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    twice = docs.unionByName(docs.withColumn("text", F.reverse("text"))).unionByName(docs)
    x = np.random.RandomState(0).normal(size=(60, len(quality.NAMES)))
    scores = [quality.fit_quality(twice.repartition(n), known).score(x) for n in (1, 3, 7)]
    assert np.array_equal(scores[0], scores[1]) and np.array_equal(scores[0], scores[2])
