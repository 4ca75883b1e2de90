"""Centroid clusters, source divergence and packing against plain Python."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from gridloom.llm import centroids, divergence, packing
from gridloom.llm.common import table, tokenizer_path

FOLDER = "/root/testdata/sf0.001"


# Centroid clusters


def clusters_by_brute_force(rows, k, rounds, width):
    kept = [(i, v) for i, v in rows if v is not None and len(v) == width and all(x is not None and np.isfinite(x) for x in v)]
    kept = [(i, [int(np.floor(64 * float(x))) for x in v]) for i, v in kept]
    name = lambda i: hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    c = [v for _, v in sorted(((name(i), v) for i, v in kept))[:k]]
    assign = lambda: [min((sum((a - b) ** 2 for a, b in zip(v, m)), j) for j, m in enumerate(c)) for _, v in kept]
    for _ in range(rounds):
        groups = defaultdict(list)
        for (_, v), (_, j) in zip(kept, assign()):
            groups[j].append(v)
        c = [[sum(col) // len(groups[j]) for col in zip(*groups[j])] if j in groups else m for j, m in enumerate(c)]
    best, by = assign(), Counter()
    for d, j in best:
        by[j] += d
    sha = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in c]
    return sorted(((i, j, d, by[j], sum(by.values()), sha[j]) for (i, _), (d, j) in zip(kept, best)), key=str)


VECTORS = "vec_id long, embedding array<float>, label int, v int, distance string"


def test_clusters_equal_brute_force_on_odd_vectors(spark):
    rng = np.random.RandomState(5)
    rows = [(i, [float(x) for x in rng.normal(size=4).astype(np.float32)]) for i in range(60)]
    rows += [(7, [0.5, -0.5, 0.25, 1.0])] * 40 + [(None, [1.0, 2.0, 3.0, 4.0]), (None, [0.0, 2.0, 3.0, 4.0])]
    bad = [(90, None), (91, []), (92, [1.0] * 3), (93, [1.0, None, 2.0, 3.0]), (94, [float("nan")] * 4), (95, [float("-inf"), 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, None, 1, "x") for i, v in rows + bad], VECTORS)
    want = clusters_by_brute_force(rows + bad, 6, 3, 4)
    for parts in (1, 5):
        got = centroids.cluster(df.repartition(parts), clusters=6, width=4)
        assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
        assert sorted(map(tuple, got.collect()), key=str) == want


def test_clusters_few_vectors_none_and_huge_numbers(spark):
    few = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert sorted(r.distance for r in centroids.cluster(few, width=2).collect()) == [0, 0]
    assert centroids.cluster(few.limit(0), width=2).collect() == [] and centroids.cluster(few, width=3).collect() == []
    huge = spark.createDataFrame([(i, [3e38 * (-1) ** i] * 64) for i in range(3)], "vec_id long, embedding array<float>")
    got = centroids.cluster(huge, clusters=1, rounds=0).collect()
    assert {r.distance for r in got} == {0, 64 * (2 * centroids.LARGEST) ** 2} and got[0].inertia <= 2**63 - 1


def test_equal_first_centroids_leave_the_later_empty(spark):
    df = spark.range(30).select(F.col("id").alias("vec_id"), F.array(F.lit(0.5), F.lit(0.25)).cast("array<float>").alias("embedding"))
    got = centroids.cluster(df, clusters=4, width=2).collect()
    assert {r.cluster for r in got} == {0} and {r.distance for r in got} == {0}


# Source divergence


def audit_by_brute_force(rows, least, top):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source, text = (x or "" for x in (lang, source, text))
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(lower))
        groups.add((lang, source))
        counts[lang, source].update(words)
        docs[lang].update(set(words))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        sources = sorted(s for g, s in groups if g == lang)
        share = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[u] for u in kept) + 5 * len(kept)) for t in kept}
        p = {s: share(counts[lang, s]) for s in sources}
        q = share(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            over = [(p[s][t] - q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", over)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, i, v, k) for k, (v, i) in enumerate(ranked[: top if part == "term" else None], 1)]
    return sorted(out)


def odd_texts():
    rng = np.random.RandomState(3)
    words = ["the", "The", "été", "ÉTÉ", "don't", "a1b", "日本", "x", "Straße", "i", "İ", "end.", "one", "two", "sea"]
    rows = []
    for i in range(120):
        text = " ".join(words[w] for w in np.minimum(rng.geometric(0.2, size=rng.randint(0, 30)) - 1, len(words) - 1))
        rows.append((["en", "de", None][i % 3], ["a", "b", None, "cé"][rng.randint(4)], text))
    rows += [("en", "a", "the sea the sea")] * 30 + [("en", "empty", None), (None, None, None), ("xx", "s", "..."), ("xx", "t", "")]
    return rows + [("fr", "only", "le mot " * 20000)]


@pytest.mark.parametrize("bits, digests, parts", [(64, 500_000, 3), (3, 500_000, 1), (1, 2, 5), (64, 0, 2), (4, 0, 3)])
def test_audit_equals_brute_force(spark, bits, digests, parts):
    """Few bits make terms share digests; no digests to broadcast makes the joins shuffle."""
    rows = odd_texts()
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "lang string, source string, text string, n int, `a.b` int").repartition(parts)
    got = divergence.audit(df, least_docs=5, top=4, digest_bits=bits, digests=digests)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == audit_by_brute_force(rows, 5, 4)


def test_audit_of_nothing(spark, none):
    assert divergence.audit(none).collect() == []


def test_audit_gives_on_what_a_task_holds(spark, monkeypatch):
    rows = odd_texts()
    df = spark.createDataFrame(rows, "lang string, source string, text string").coalesce(1)
    monkeypatch.setattr(divergence, "HELD", 5)
    monkeypatch.setattr(divergence, "CELLS", 3)
    assert sorted(map(tuple, divergence.audit(df, least_docs=5, top=4).collect())) == audit_by_brute_force(rows, 5, 4)


def test_terms_are_those_of_the_pattern():
    text = "Aé1b_C d E\U0001f600 `z{~\x7f\x80Ǆ-İ"
    lower = text.translate({c: c + 32 for c in range(65, 91)})
    assert [t.decode() for t in divergence.terms(text.encode())] == re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)


# Packing


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path(packing.VOCABULARY))


def check_packed(rows, texts, tokenizer, capacity):
    """Every document whole, every sequence gapless and within the capacity."""
    ids = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]
    parts = [(k, i, len(x[i : i + capacity]), zlib.crc32(np.array(x[i : i + capacity], "<u4").tobytes())) for x in ids for k, i in enumerate(range(0, len(x), capacity))]
    assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(parts)
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for placed in by.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by), sum(map(len, ids))


def test_packing_of_the_documents(spark, tokenizer):
    docs = table(spark, FOLDER, "documents")
    texts = [r.text for r in docs.collect()]
    for capacity in (4096, 700):
        rows = packing.pack(docs.repartition(5), capacity=capacity).collect()
        n, total = check_packed(rows, texts, tokenizer, capacity)
        assert n <= 1.02 * total / capacity + 1
    assert len({(r.doc_id, r.piece) for r in rows}) == len(rows)


def test_packing_of_odd_rows(spark, odd, none, tokenizer):
    rows = packing.pack(odd, capacity=512).collect()
    check_packed(rows, [r.text for r in odd.collect()], tokenizer, 512)
    assert Counter(r.doc_id for r in rows if r.piece == 0) == Counter(r.doc_id for r in odd.collect())
    assert packing.pack(none).collect() == []


def test_sequences_hold_the_ids(spark, odd, tokenizer):
    packed = packing.pack(odd.repartition(3), capacity=512, keep_ids=True)
    texts = Counter((*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1) for r in odd.collect())
    found = Counter()
    parts = defaultdict(list)
    for r in packing.sequences(packed).collect():
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.n_tokens <= 512 and len(r.doc_ids) == len(r.starts)
        for a, b in zip(r.starts, [*r.starts[1:], len(ids)]):
            parts[zlib.crc32(ids[a:b].tobytes())].append(tuple(ids[a:b].tolist()))
    for r in packed.collect():
        assert len(parts[r.ids_crc32][0]) == r.length
        found[r.length] += 1
    assert found == Counter(len(x[i : i + 512]) for x, n in texts.items() for _ in range(n) for i in range(0, len(x), 512))


TEXTS = st.lists(st.text(st.sampled_from("aB1 .'st\n\t  \x1c\x85é́İßΣ日가ᄀ\U0001f600<|endoftext>"), max_size=40), max_size=8)


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(tokenizer_path(packing.VOCABULARY))


def by_text(encoder, texts):
    ids, ends = encoder.encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip([0, *ends], ends)]


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_and_parts_give_the_tokens_of_the_text(encoder, texts):
    texts += ["a <|endoftext|> b", "<|startoftext|>x don'T WE'RE it'Ll ''s -'s \xbd\xb2x\xaa \u0149 \u01c5 \xad", "", " " + "long" * 30]
    assert encoder.by_parts
    assert by_text(encoder, texts) == [encoder.library.encode(t, add_special_tokens=False).ids for t in texts]


def test_every_latin_character_next_to_others(encoder, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 100)
    texts = [f"a{chr(c)} {chr(c)}b 1{chr(c)}2 .{chr(c)}'s {chr(c)}{chr(c)}" for c in [*range(1, 0x280), 0x3A3, 0x2160, 0x1E9E]]
    got = [x for i in range(0, len(texts), 50) for x in by_text(encoder, texts[i : i + 50])]
    assert got == [encoder.library.encode(t, add_special_tokens=False).ids for t in texts]


def test_other_vocabularies_are_encoded_whole(spark, tokenizer):
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    df = spark.createDataFrame([(1, " a  b\n c"), (2, None)], "doc_id long, text string")
    check_packed(packing.pack(df, vocabulary="byte_bpe_50k.json").collect(), [" a  b\n c", None], other, 4096)


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 40).flatmap(lambda c: st.tuples(st.just(c), st.dictionaries(st.integers(1, c), st.integers(1, 60), max_size=12))))
def test_plan_places_every_piece_once(case):
    capacity, counts = case
    runs = packing.plan(counts, capacity)
    bins = defaultdict(list)
    for length, n in counts.items():
        own = runs[runs[:, 0] == length]
        for rank in range(n):
            _, first, per, sequence, offset = own[np.searchsorted(own[:, 1], rank, side="right") - 1]
            turn, along = divmod(rank - first, per)
            bins[sequence + turn].append((offset + along * length, length))
    for placed in bins.values():
        ends = np.cumsum([0] + [n for _, n in sorted(placed)])
        assert [o for o, _ in sorted(placed)] == ends[:-1].tolist() and ends[-1] <= capacity
        assert sum(3 * n > capacity for _, n in placed) <= 2
    # No worse than the bound of best fit: all but one sequence of small pieces are two thirds full.
    total = sum(length * n for length, n in counts.items())
    large = sum(n for length, n in counts.items() if 3 * length > capacity)
    assert len(bins) <= max(large, 1.5 * total / capacity + 1)


def test_plan_is_small_for_any_number_of_pieces():
    rng = np.random.RandomState(1)
    few = {int(n): int(c) for n, c in zip(range(1, 4097), rng.randint(1, 50, 4096))}
    sizes = [len(packing.plan({n: c * k for n, c in few.items()}, 4096)) for k in (1, 1000, 10**8)]
    assert max(sizes) < 40_000 and sizes[2] < 2 * sizes[1]
    # No packing can do with less than the tokens fill, or with fewer than pieces above a half.
    least = max(sum(n * c for n, c in few.items()) / 4096, sum(c for n, c in few.items() if n > 2048)) * 10**8
    runs = packing.plan({n: c * 10**8 for n, c in few.items()}, 4096)
    assert runs[:, 3].max() < 1.001 * least
