"""Queries without an SQL twin against plain Python over whole tables of the smallest scale."""

import hashlib
import html
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gridloom.llm import extraction, near, pieces, private, quality, tokens
from gridloom.llm.common import tokenizer_path
from gridloom.llm.graph import components
from gridloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
BIGGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{BIGGER}/documents.parquet").collect()}


def strings(alphabet, count, longest, seed=3):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, longest))) for _ in range(count)]


def test_token_counts(spark, docs):
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(tokenizer_path(tokens.VOCABULARY))
    for r in QUERIES["op2_token_counts"](spark, BIGGER).collect():
        n = len(encoder.encode(docs[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 512)


def test_tokens_at_cuts(spark):
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(tokenizer_path(tokens.VOCABULARY))
    alphabet = [*"  \n\tab1c'sthe!?é中　😀\x1c\x85\xa0", "<|endoftext|>", "'ll"]
    texts = strings(alphabet, 1500, 60)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in tokens.token_counts(df, batch_bytes=50).collect()}
    assert got == {i: len(encoder.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}


def test_balanced_batches():
    batches = list(tokens.balanced(["aa", "é", "b" * 9, "c", "d"], 4))
    assert batches == [["aa", "é"], ["b" * 9], ["c", "d"]]


def test_pieces(spark, docs):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(pieces.MODEL))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    texts = dict(docs)
    extra = strings([*" ▁  \n\tabctheinq.é中字　😀<s>#\x85﻿", "▁▁▁"], 1500, 60)
    extra += [" " * k + x for k in range(0, 40) for x in ("", "a", "the", " \n")]
    extra_rows = {10**9 + i: t for i, t in enumerate(extra)}
    df = spark.createDataFrame(list(extra_rows.items()), "doc_id long, text string")
    got = QUERIES["op5_sentencepiece"](spark, BIGGER).collect() + pieces.encode_decode(df).collect()
    texts |= extra_rows
    assert len(got) == len(texts)
    for r in got:
        ids = lib.encode(texts[r.doc_id], add_eos=True)
        want = (len(ids), sha(" ".join(map(str, ids))), sha(lib.decode(ids)))
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == want


def test_pieces_give_ids_and_texts(spark):
    df = spark.createDataFrame([(1, "two  spaces and é\U0001f600"), (2, "")], "doc_id long, text string")
    got = {r.doc_id: r for r in pieces.encode_decode(df, texts=True).collect()}
    assert got[1].decoded == "two  spaces and é\U0001f600" and len(got[1].ids) == got[1].n_tokens
    assert got[2].decoded == "" and got[2].ids == [2]


def test_other_vocabularies_are_encoded_whole(spark):
    from tokenizers import Tokenizer

    name = "word_bpe_49k.json"
    texts = ["Some  Text here", "", "ABC def\n\nghi <|endoftext|>"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    encoder = Tokenizer.from_file(tokenizer_path(name))
    got = {r.doc_id: r.n_tokens for r in tokens.token_counts(df, vocabulary=name).collect()}
    assert got == {i: len(encoder.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    def fits(kind, match):
        digits = re.sub("[^0-9]", "", match)
        if kind == "email":
            return True
        if kind == "ip":
            return all(int(p) <= 255 for p in match.split("."))
        if kind == "phone":
            return 9 <= len(digits) <= 15
        twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in twice) % 10 == 0

    found = [
        (m.start(), k, m.end(), kind)
        for k, (kind, p) in enumerate(PLAIN.items()) for m in re.finditer(p, text) if fits(kind, m[0])
    ]
    listed = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found))
    return [sum(f[1] == k for f in found) for k in range(4)], hashlib.sha256(listed.encode()).hexdigest()


def test_private_base(spark, docs):
    alphabet = [*"ab.@-+ ()0123456789_%é😀\n", "a@b.c", "1.2.3.4", "+1 (555) 123-4567", "4111 1111 1111 1111", "x@y.z_d@e.fg"]
    extra = strings(alphabet, 2000, 60) + ["1 2 " * 20_000, "a" * 200_000, "9" * 100_000, "a.b@" + "c." * 400 + "d", "1.2.3.4.5.6.7.8"]
    texts = dict(docs) | {10**9 + i: t for i, t in enumerate(extra)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(8)
    for r in private.find_private(df).collect():
        counts, digest = plain_spans(texts[r.doc_id])
        assert ([r.n_email, r.n_ip, r.n_card, r.n_phone], r.base_sha256) == (counts, digest), texts[r.doc_id][:100]


def test_private_survives_hostile_texts(spark):
    texts = ["a.b@" + "c." * 5000 + "d", "@" * 50_000, "1." * 50_000, "+1" * 30_000, "a1 " * 30_000, "- 1 -" * 20_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert private.find_private(df).count() == len(texts)


def test_private_learns_from_contexts(spark):
    """A card with a wrong check digit is found behind words that cards stand behind."""
    good = ["4111111111111111", "5500005555555559", "4012888888881881", "6011111111111117", "30569309025904"]
    rows = [(i, f"please charge card number {c} today") for i, c in enumerate(good)]
    rows += [(10, "please charge card number 4111111111111112 today"), (11, "we saw 4111111111111112 birds")]
    rows += [(12 + i, f"we saw {i}000 birds") for i in range(9)]
    got = {r.doc_id: r for r in private.find_private(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[10].spans == "card:26:42" and got[10].n_card == 0 and got[10].n_added == 1
    assert all(got[i].n_added == 0 for i in range(11, 21))
    assert all(got[i].n_card == 1 and got[i].n_added == 0 for i in range(5))


GOOD_CARDS = ["4111111111111111", "5500005555555559", "4012888888881881", "6011111111111117", "30569309025904"]


def found_spans(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.spans for r in sorted(private.find_private(df).collect())]


def test_private_context_reaches_over_an_earlier_identifier(spark):
    texts = [f"SSN 078-05-11{i}0 DOB {c}" for i, c in enumerate(GOOD_CARDS)]
    got = found_spans(spark, [*texts, "SSN 078-05-1120 DOB 1980-01-01"])
    assert got[-1] == "card:20:30"
    texts = [f"my card number a1 - {c}" for c in GOOD_CARDS]  # no word in between
    assert found_spans(spark, [*texts, "card number b2 - 4111111111111112"])[-1] == "card:17:33"


def test_private_takes_a_run_of_any_number_of_tokens(spark):
    texts = [f"account is held at {c}" for c in GOOD_CARDS]
    account = "FR14 2004 1010 0505 0001 3M02 606"
    more = [t.replace("held", "kept") for t in texts]
    got = found_spans(spark, [*texts, *more, f"it is held at {account}", "kept at" + " 1234" * 500 + " end"])
    assert got[-2:] == ["card:14:47", "card:8:2507"]


def test_private_cuts_candidates_at_base_spans(spark):
    texts = [f"card number {c}" for c in GOOD_CARDS]
    got = found_spans(spark, [
        *texts, "card number 4111111111111112 +1 (555) 123-4567", "our card number 4111111111111112/+1 (555) 123-4567.",
        "card number 5500005555555559, 12345",
    ])
    assert got[5] == "card:12:28,phone:29:46"
    assert got[6] == "card:16:32,phone:33:50"
    assert got[7] == "card:12:28"


def test_private_long_words_and_gaps_are_a_context(spark):
    texts = [f"{'x' * 60} number   {' ' * 60} {c}" for c in GOOD_CARDS]
    got = found_spans(spark, [*texts, f"{'x' * 60} number 4111111111111112"])
    assert got[-1] == "card:68:84"


@pytest.mark.parametrize("labels", [1200, 5000, 200_000])
def test_private_emails_of_many_labels(spark, labels):
    text = "a.b@" + "c." * labels + "d, x@y.z"
    df = spark.createDataFrame([(text,)], "text string")
    [r] = df.select(private.base_spans(F.col("text"), "email").alias("s")).collect()
    assert [(x.start, x.end) for x in r.s] == [m.span() for m in re.finditer(PLAIN["email"], text)]


def test_private_patterns_behind_discovered_instances(spark):
    """Two hops: seeds make one pattern confident, what it discovers the next one."""
    edges = [("first", f"s{i}", "card") for i in range(27)] + [("first", f"x{i}", None) for i in range(3)]
    edges += [("second", f"x{i}", None) for i in range(3)] + [("third", f"x{i}", None) for i in range(2)]
    df = spark.createDataFrame(edges, "pattern string, instance string, kind string")
    assert {r.pattern for r in private.scored_patterns(df).collect()} == {"first", "second"}


def components_of(pairs, n):
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in pairs:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    return [root(i) for i in range(n)]


def test_components(spark):
    rnd = random.Random(1)
    pairs = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(300, 360)]
    links = spark.createDataFrame(pairs, "a long, b long")
    roots = components_of(pairs, 361)
    got = {r.node: r.label for r in components(links).collect()}
    assert got == {n: roots[n] for n in {x for a, b in pairs if a != b for x in (a, b)}}
    assert components(links.limit(0)).collect() == []


def test_probability_jaccard_by_definition():
    rnd = random.Random(5)
    for _ in range(200):
        x = {rnd.randrange(12): rnd.randint(1, 4) for _ in range(rnd.randint(1, 9))}
        y = {rnd.randrange(12): rnd.randint(1, 4) for _ in range(rnd.randint(1, 9))}
        both = x.keys() & y.keys()
        want = sum(
            1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in x.keys() | y.keys()) for i in both
        )
        arrays = [np.array(v, t) for s in (x, y) for v, t in ((sorted(s), np.int64), ([s[k] for k in sorted(s)], float))]
        assert near.probability_jaccard(*arrays) == pytest.approx(want)


def test_bounds_of_the_open_pairs():
    """No pair is more similar than its shared masses, or its differing shingles, allow."""
    rnd = random.Random(6)
    for _ in range(3000):
        pool = list(range(rnd.choice((8, 30))))
        x, y = ({k: rnd.choice((1, 1, 1, 2, 5)) for k in rnd.sample(pool, rnd.randint(1, len(pool)))} for _ in range(2))
        both = x.keys() & y.keys()
        if not both:
            continue
        arrays = [np.array(v, t) for s in (x, y) for v, t in ((sorted(s), np.int64), ([s[k] for k in sorted(s)], float))]
        similarity = near.probability_jaccard(*arrays)
        mx, my = sum(x.values()), sum(y.values())
        shared = [sum(s[k] for k in both) / m for s, m in ((x, mx), (y, my))]
        assert similarity <= 1 / (1 / shared[0] + 1 / shared[1] - 1) + 1e-9
        apart = len(x.keys() ^ y.keys())
        for limit in (0.5, 0.8, 0.9):
            c = 1 / limit - 1
            if similarity >= limit:
                assert apart <= c / (1 + c / 2) * max(mx, my) + 1e-9


def test_prob_min_hash_estimates():
    rnd = random.Random(2)
    words = [f"w{rnd.randrange(10**9)}" for _ in range(400)]
    for swap in (5, 12, 40):
        other = [f"z{i}" if i % (400 // swap) == 0 else w for i, w in enumerate(words)]
        doc, value, weight = near.shingles([words, other], near._WordHashes())
        signature = near.prob_min_hash(doc, value, weight, 2, 4000)
        sides = [(np.sort(value[doc == k]), weight[doc == k][np.argsort(value[doc == k])].astype(float)) for k in (0, 1)]
        exact = near.probability_jaccard(*sides[0], *sides[1])
        assert (signature[0] == signature[1]).mean() == pytest.approx(exact, abs=0.04)


def near_by_brute_force(texts):
    """Groups by comparing every pair of different texts."""
    nodes = {}
    for i, t in texts.items():
        nodes.setdefault(tuple(near.split_words(t)), []).append(i)
    names = list(nodes)
    doc, value, weight = near.shingles([list(n) for n in names], near._WordHashes())
    sets = [(value[doc == k], weight[doc == k].astype(float)) for k in range(len(names))]
    holders = {}
    for k, (v, _) in enumerate(sets):
        for key in v.tolist():
            holders.setdefault(key, []).append(k)
    pairs = {(a, b) for h in holders.values() for a in h for b in h if a < b}
    links = [p for p in pairs if near.probability_jaccard(*sets[p[0]], *sets[p[1]], 0.8) >= 0.8 - 1e-9]
    roots = components_of(links, len(names))
    groups = {}
    for k, n in enumerate(names):
        groups.setdefault(roots[k], []).extend(nodes[n])
    return {i: (min(g), len(g)) for g in groups.values() for i in g}


def test_near_groups(spark, docs):
    rnd = random.Random(8)
    texts = {i: t for i, t in docs.items() if i < 300}
    base = [f"word{rnd.randrange(400)}" for _ in range(150)]
    for k in range(150):  # one large group with similarities around the limit
        words = list(base)
        for _ in range(rnd.choice((0, 1, 2, 3, 4, 6))):
            words[rnd.randrange(150)] = f"new{rnd.randrange(10**6)}"
        texts[10_000 + k] = " ".join(words)
    texts |= {20_000: "", 20_001: "one two", 20_002: "one two", 20_003: "one two three"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(6)
    got = {r.doc_id: (r.group_id, r.group_size) for r in near.near_groups(df).collect()}
    want = near_by_brute_force(texts)
    wrong = [i for i in want if got[i] != want[i]]
    assert len(wrong) <= 0.002 * len(want), wrong  # banding misses a pair in some 2,500


def test_near_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = {r.doc_id: (r.group_id, r.group_size) for r in QUERIES["op7_near_dedup"](spark, FOLDER).collect()}
    assert got == near_by_brute_force(texts)


def test_classifier_on_held_out_rows(spark):
    scored = QUERIES["op9_quality_classifier"](spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = scored.join(labels, "doc_id").select("doc_id", "held_out", "score", "predicted", "quality").collect()
    for r in rows[:500]:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.7)
    held = [r for r in rows if r.held_out]
    assert len(held) > 500
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.98
    good = [r for r in held if r.quality == 1]
    assert sum(r.predicted for r in good) / len(good) > 0.99


def test_additive_model_learns_an_interaction():
    rnd = np.random.default_rng(0)
    x = rnd.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x[:3000], y[:3000])
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95
    assert (quality.fit(x[:5], np.ones(5)).score(x) > 0.99).all() and (quality.fit(x[:0], y[:0]).score(x) > 0.99).all()


def article(page):
    """Text of the test pages' one article, cut at its block tags."""
    inside = re.search("<article>(.*?)</article>", page, re.S)[1]
    blocks = [re.sub("<[^>]+>", lambda m: " " if m[0] == "<br>" else "", b) for b in re.split("</?(?:p|h1)>", inside)]
    texts = [re.sub(r"\s+", " ", html.unescape(b)).strip() for b in blocks]
    return "\n".join(t for t in texts if t)


def test_extraction(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{BIGGER}/pages.parquet").collect()}
    got = QUERIES["op4_html_text"](spark, BIGGER).collect()
    assert len(got) == len(pages)
    for r in got:
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, article(pages[r.page_id].html), len(r.text))


def test_extraction_on_unseen_layouts():
    field = extraction.trained_field()
    pages = extraction.labelled_pages(150, seed=99)
    right = sum(a == b for blocks, labels in pages for a, b in zip(field.label(blocks), labels))
    assert right / sum(len(labels) for _, labels in pages) > 0.97


def test_viterbi_is_the_best_labelling():
    field = extraction.trained_field(40)
    for blocks, _ in extraction.labelled_pages(60, seed=5):
        if len(blocks) > 10:
            continue
        gains = [sum(field.weights[k] for k in on) for on in extraction.active(blocks)]

        def total(labels):
            return sum(g for g, y in zip(gains, labels) if y) + sum(field.steps[a][b] for a, b in zip(labels, labels[1:]))

        every = [[n >> i & 1 for i in range(len(blocks))] for n in range(2 ** len(blocks))]
        assert total(field.label(blocks)) == pytest.approx(max(map(total, every)))


def test_pipeline_is_its_stages(spark):
    """Each stage does what its operator says, on what the one before kept."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality classifier", "exact dedup", "near dedup", "mixing", "sentencepiece"]
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    scores = quality.score_quality(docs, quality.fit_quality(docs, labels)).collect()
    rows = stages["quality classifier"](spark, docs, FOLDER).cache()
    assert sorted(r.doc_id for r in rows.collect()) == sorted(r.doc_id for r in scores if r.predicted)
    texts = {}
    for r in rows.collect():
        texts[r.text] = max(r.doc_id, texts.get(r.text, -1))
    rows = stages["exact dedup"](spark, rows, FOLDER).cache()
    assert sorted(r.doc_id for r in rows.collect()) == sorted(texts.values())
    groups = near_by_brute_force({r.doc_id: r.text for r in rows.collect()})
    rows = stages["near dedup"](spark, rows, FOLDER).cache()
    assert sorted(r.doc_id for r in rows.collect()) == sorted({g for g, _ in groups.values()})
    rows = stages["mixing"](spark, rows, FOLDER).cache()
    assert rows.columns == docs.columns
    last = stages["sentencepiece"](spark, rows, FOLDER)
    assert sorted(map(str, last.collect())) == sorted(map(str, corpus_pipeline.run(spark, FOLDER).collect()))


def test_hot_copies_are_dealt_and_counted(spark):
    from gridloom.llm import copies

    df = spark.range(2000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), (F.col("id") % 700).cast("string"))).alias("text")
    )
    plain = {}
    for r in df.collect():
        plain.setdefault(r.text, []).append(r.doc_id)
    got = copies.exact_groups(df, hot_rows=10).join(df, "doc_id").collect()
    assert len(got) == 2000
    for r in got:
        ids = plain[r.text]
        assert (r.keep_id, r.group_size, r.kept) == (max(ids), len(ids), r.doc_id == max(ids))
    assert sorted(r.doc_id for r in copies.exact_dedup(df, hot_rows=10).collect()) == sorted(max(v) for v in plain.values())
