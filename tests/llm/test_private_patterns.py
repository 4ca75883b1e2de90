"""Back-off patterns of the private data operator against a plain bootstrap, and on planted variants."""

import math
import random
from collections import defaultdict

import pytest
import regex

from gridloom.llm import private

FOLDER = "/root/testdata/sf0.01"
WORD = regex.compile(r"[\p{L}\p{N}=:#]+")
FORMS = [regex.compile(p) for p in (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
    r"[0-9](?:[\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
)]
TOKEN = r"[^\x20\x09-\x0D0-9@]*[0-9@][^\x20\x09-\x0D]*"
RUN = regex.compile(rf"(?<![^\x20\x09-\x0D]){TOKEN}(?:\x20{TOKEN})*+")


def luhn(digits):
    twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in twice) % 10 == 0


def base(text):
    for k, form in enumerate(FORMS):
        for m in form.finditer(text):
            digits = regex.sub("[^0-9]", "", m[0])
            if k == 1 and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if k == 2 and not (12 <= len(digits) <= 19 and luhn(digits)) or k == 3 and not 9 <= len(digits) <= 15:
                continue
            yield m.start(), k, m.end(), m[0]


def shape(hit):
    hit = regex.sub("[0-9]", "9", regex.sub(r"\p{L}+", "a", hit))
    return regex.sub(r" *([.-]) *", r"\1", regex.sub(r"^\++", "", hit))


def bare(start, hit):
    end = len(hit)
    while end and not regex.match(r"[\p{L}\p{N}]", hit[end - 1]):
        end -= 1
    first = 0
    while first < end and not regex.match(r"[\p{L}\p{N}@+(]", hit[first]):
        first += 1
    return start + first, start + end, hit[first:end]


def plain_bootstrap(texts):
    """Spans by the same rules, one loop at a time."""
    seeds, places = {}, []
    edges, need = defaultdict(set), {}
    kinds = defaultdict(set)
    for doc, text in texts.items():
        seeds[doc] = sorted(base(text))
        words, at = [], 0
        runs = list(RUN.finditer(text))
        for n, run in enumerate(runs):
            words += [w.lower()[-48:] for w in WORD.findall(text[at:run.start()])]
            at = run.end()
            behind = WORD.search(text, at, runs[n + 1].start() if n + 1 < len(runs) else len(text))
            cuts = [s for s in seeds[doc] if s[0] < run.end() and s[2] > run.start()]
            parts, here = [], run.start()
            for start, k, end, hit in [*cuts, (run.end(), None, None, None)]:
                if here < start:
                    a, b, left = bare(here, text[here:start])
                    if regex.search("[0-9@]", left):
                        parts.append((a, b, left, None))
                if k is not None:
                    if start >= max(here, run.start()):
                        parts.append((start, end, hit, k))
                    here = max(here, end)
            for i, (start, end, hit, k) in enumerate(parts):
                before = words[-2:] + ["0"] * min(i, 2)
                after = (behind[0].lower()[:48] if behind else "") if i == len(parts) - 1 else "0"
                like = sum(c in "0123456789" for c in hit) >= 4 or "@" in hit
                names = {}
                if len(before) >= 2:
                    names["2 " + " ".join(before[-2:])] = 3
                if like or k is not None:
                    if before:
                        names[f"b {before[-1]} {shape(hit)}"] = 5
                    if after:
                        names[f"a {after} {shape(hit)}"] = 5
                    names[f"s {shape(hit)}"] = 20
                found = [(doc, start, start, end, hit, k, like, names, True)]
                if k is None and " " in hit:
                    for token in regex.finditer("[^ ]+", hit):
                        a, b, t = bare(start + token.start(), token[0])
                        if sum(c in "0123456789" for c in t) >= 4 or "@" in t:
                            found.append((doc, start, a, b, t, None, True, {f"s {shape(t)}": 20}, False))
                places += found
                for *_, instance, kind, _, many, _ in found:
                    for name, wanted in many.items():
                        edges[name].add(instance.lower())
                        need[name] = wanted
                        if kind is not None:
                            kinds[instance.lower()].add(kind)
            words = [*words, "0"][-3:]
    sure = {(i, k): 1.0 for i, many in kinds.items() for k in many}
    fixed, scores = set(sure), {}
    for _ in range(3):
        scores = {}
        for name, instances in edges.items():
            for k in range(4):
                mine = [sure[i, k] for i in instances if (i, k) in sure]
                score = round(sum(mine) / len(instances), 9)
                if score >= 0.8 and sum(round(v, 9) >= 0.8 for v in mine) >= need[name]:
                    scores[name, k] = score
        doubt = defaultdict(float)
        for name, k in scores:
            for i in edges[name]:
                doubt[i, k] += math.log(1 - min(scores[name, k], 0.99))
        sure = {**{key: 1 - math.exp(d) for key, d in doubt.items()}, **{key: 1.0 for key in fixed}}
    best = {}
    for (name, k), score in scores.items():
        best[name] = max(best.get(name, (-1, 0)), (score, -k))
    out, found = {}, defaultdict(list)
    for doc, run, start, end, _, k, like, names, whole in places:
        known = [best[n] for n in names if n in best]
        if k is None and like and known:
            found[doc, run].append((whole, start, -max(known)[1], end))
    for doc in texts:
        spans = [(a, k, b) for a, k, b, _ in seeds[doc]]
        for (d, _), many in found.items():
            if d == doc:
                spans += [m[1:] for m in many if m[0] == max(many)[0]]
        out[doc] = ",".join(f"{private.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))
    return out


def card(rng, valid=True):
    digits = "".join(rng.choice("0123456789") for _ in range(15))
    [good] = [d for d in "0123456789" if luhn(digits + d)]
    return digits + (good if valid else rng.choice([d for d in "0123456789" if d != good]))


def planted(rng):
    """Texts of random words with an identifier each, rare variants of the same, and plain numbers."""
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    ip = lambda dot: dot.join(str(rng.randint(100, 255)) for _ in range(4))
    phone = lambda: f"1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
    texts, wanted, plain = [], {}, []
    for i in range(240):
        for identifier in (card(rng), ip("."), "+" + phone()):
            texts.append(f"{word()} {word()} {identifier}, {word()}")
        if i % 20:
            continue
        for variant in (card(rng, False), ip(". "), phone(), card(rng) + " " + card(rng)):
            texts.append(f"{word()} {word()} {variant} {word()}")
            wanted[len(texts) - 1] = len(texts[-1].split(" ", 2)[2].rsplit(" ", 1)[0])
        for number in (rng.randint(1000, 99_999_999), f"{rng.randint(1900, 2100)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}"):
            texts.append(f"{word()} {word()} {number} {word()}")
            plain.append(len(texts) - 1)
    return texts, wanted, plain


def test_variants_are_found_and_numbers_left_alone(spark):
    texts, wanted, plain = planted(random.Random(4))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in private.find_private(df).collect()}
    caught = 0
    for doc, length in wanted.items():
        covered = sum(int(b) - int(a) for _, a, b in (span.split(":") for span in got[doc].spans.split(",") if span))
        caught += covered >= length - 1
    assert caught >= 0.9 * len(wanted)
    assert sum(got[doc].n_spans > 0 for doc in plain) <= 0.02 * len(plain)
    assert {doc: r.spans for doc, r in got.items()} == plain_bootstrap(dict(enumerate(texts)))


@pytest.mark.parametrize("part", [0, 1])
def test_equal_to_a_plain_bootstrap(spark, part):
    """Documents of the test table, and strings made of identifiers and marks."""
    if part:
        rng = random.Random(8)
        bits = [*" .-,!?()\n", "card", "number", "a@b.c", "1.2.3.4", "4111111111111111", "4111111111111112", "+1 (555) 123-4567", "12", "2024", "é"]
        texts = {i: "".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(rng.randint(1, 30))) for i in range(400)}
    else:
        rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
        texts = {r.doc_id: r.text or "" for r in rows}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.spans for r in private.find_private(df).collect()}
    expected = plain_bootstrap(texts)
    assert {d: (got[d], texts[d][:200]) for d in texts if got[d] != expected[d]} == {}
