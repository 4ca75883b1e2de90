"""The order of quality rules, and url vocabularies of many terms."""

import random
import re

from gridloom.llm import rules, urls


def _texts(spark, n=900):
    rng = random.Random(5)
    words = "the of and quick brown fox jumps over lazy dog while rain falls in town".split()
    rows = []
    for i in range(n):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(25, 90)))
        if i % 3 == 0:
            text = "\n".join(f"- {w} item" for w in text.split())
        elif i % 7 == 0:
            text = text.replace(" ", "! ")
        rows.append((i, text))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(6)


def test_order_is_the_same_in_every_call(spark):
    docs = _texts(spark)
    found = []
    for _ in range(5):
        sample = rules.measured(rules.sampled(docs, 300), "doc_id", "text")
        found.append([r.name for r in rules.ordered(rules.RULES, rules.estimate(sample))])
    assert all(f == found[0] for f in found)
    # Two thirds of these texts pass; the cheap rule that rejects a third comes before those that reject none.
    assert found[0].index("bullet_lines") < found[0].index("ellipsis_lines")


def test_estimate_looks_at_rows_that_the_base_keeps(spark):
    rows = [(i, "!!! !!!") for i in range(50)] + [(100 + i, " ".join(f"word{j}" for j in range(30))) for i in range(10)]
    measured = rules.measured(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
    found = rules.estimate(measured)
    assert found["exclamations"][1] == 0.0
    assert found["letters"] == (rules.ITEM * 30, 0.0)
    assert set(rules.estimate(measured.limit(0)).values()) == {(1.0, 0.0)}


def test_the_sample_is_taken_below_the_measures(spark):
    plan = rules.measured(rules.sampled(_texts(spark), 100), "doc_id", "text")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("xxhash64") < plan.index("Sample")


def test_ten_thousand_terms(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(3, 7)))
    terms = sorted({word() for _ in range(13_000)})
    rng.shuffle(terms)
    strict, soft = terms[:50], terms[50:]
    assert len(soft) > 10_000
    glue = ["-", ".", "/", "x", "", "%20", "é"]
    rows = []
    for i in range(400):
        rest = "".join(w + rng.choice(glue) for w in ([word() for _ in range(6)] + rng.choices(terms, k=rng.randint(0, 2))))
        rows.append((i, f"http://{rest.upper() if i % 5 == 0 else rest}"))
    got = urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), rules=(), strict=strict, soft=soft)
    strict, soft = set(strict), set(soft)
    for r in got.collect():
        rest = rows[r.page_id][1].partition("://")[2]
        rest = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest)
        found = set(re.findall(r"[a-z0-9]+", rest))
        assert (r.n_strict, r.n_soft) == (len(found & strict), len(found & soft))
        assert r.verdict == ("block" if r.n_strict or r.n_soft >= urls.SOFT_HITS else "allow")
