"""How the word use of the sources of a language differs.

Terms are counted by fixed-width digests: a task adds up what it reads, and only digests with
numbers are shuffled. A second pass gives the smallest and the largest string behind every
digest that is kept. Where the two differ, texts share a digest; those are counted anew by
the string itself. Strings are joined back just for the rows that come out. Shares are whole
numbers throughout.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import require
from ..functions.storage import cut_lineage
from .common import BROADCAST_ROWS, fitting, map_batches, parts_of, quoted

LEAST_DOCS, TOP, ADDED, UNITS = 30, 50, 5, 1_000_000_000
# Entries that a task adds up before it gives them on, and numbers of one matrix at a time.
HELD, CELLS = 300_000, 1 << 20
# So many digests of eight bytes are sent to the tasks; beyond it joins shuffle.
DIGESTS = 500_000
# ASCII bytes that are no letters become spaces, A-Z become a-z; other bytes are parts of terms.
_TERM_BYTES = bytes(
    b if b >= 0x80 or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256)
)


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text: runs of ASCII letters and characters above ASCII, in order."""
    return text.translate(_TERM_BYTES).split()


def _digests(words: list[bytes], bits: int) -> np.ndarray:
    import xxhash

    got = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    return (got >> np.uint64(64 - bits)).view(np.int64) if bits < 64 else got.view(np.int64)


def _rows(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    require(docs, text_col, lang_col, source_col)
    held = {"lang": lang_col, "source": source_col, "text": text_col}
    rows = docs.select(*[F.coalesce(quoted(c).cast("string"), F.lit("")).alias(n) for n, c in held.items()])
    return rows.withColumn("text", F.col("text").cast("binary"))


def _counted(rows: DataFrame, bits: int, strings: bool) -> DataFrame:
    """``lang, source, digest, n, docs`` (and ``term``): occurrences and rows with the term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        occurrences, documents = defaultdict(Counter), defaultdict(Counter)

        def given() -> Iterator[pa.RecordBatch]:
            for (lang, source), counts in occurrences.items():
                words, docs = list(counts), documents[lang, source]
                columns = {
                    "lang": pa.array([lang] * len(words), pa.string()), "source": pa.array([source] * len(words), pa.string()),
                    "digest": pa.array(_digests(words, bits)), "n": pa.array(list(counts.values()), pa.int64()),
                    "docs": pa.array([docs[w] for w in words], pa.int64()),
                }
                if strings:
                    columns["term"] = pa.array(words, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_pydict(columns)
            occurrences.clear()
            documents.clear()

        for whole in batches:
            for batch in parts_of(whole, 200):
                for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
                    words = terms(text)
                    occurrences[lang, source].update(words)
                    documents[lang, source].update(set(words))
                if sum(map(len, occurrences.values())) > HELD:
                    yield from given()
        yield from given()

    schema = "lang string, source string, digest bigint, n bigint, docs bigint" + (", term string" if strings else "")
    return map_batches(rows, count, schema)


def _spelled(rows: DataFrame, bits: int, wanted: np.ndarray | None) -> DataFrame:
    """``digest, term``: the strings of the texts, each about once a task.

    With ``wanted``, which is sorted, only those behind these digests, and each just once a
    task: what a task has given is no more than there are digests wanted.
    """

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        given: set = set()
        for whole in batches:
            for batch in parts_of(whole, 200):
                new = set()
                for text in batch.column(0).to_pylist():
                    new.update(terms(text))
                words = list(new - seen)
                if len(seen) > HELD:
                    seen.clear()
                seen.update(words)
                found = _digests(words, bits)
                if wanted is not None:
                    at = np.minimum(np.searchsorted(wanted, found), len(wanted) - 1)
                    hits = [i for i in np.flatnonzero(wanted[at] == found).tolist() if words[i] not in given]
                    words, found = [words[i] for i in hits], found[hits]
                    given.update(words)
                columns = [pa.array(found), pa.array(words, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["digest", "term"])

    return map_batches(rows.select("text"), spell, "digest bigint, term string")


def _frequent(counted: DataFrame, key: list[str], least_docs: int) -> DataFrame:
    """``lang, source, <key>, n`` of the terms in at least so many rows of their language."""
    added = counted.groupBy("lang", "source", *key).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    everywhere = F.sum("docs").over(Window.partitionBy("lang", *key))
    return added.withColumn("all_docs", everywhere).filter(F.col("all_docs") >= least_docs).select("lang", "source", *key, "n")


def kept_terms(rows: DataFrame, least_docs: int, bits: int, digests: int) -> tuple[DataFrame, DataFrame]:
    """``lang, source, digest, tag, n`` and the names ``digest, low``.

    ``tag`` is empty, but for the terms that share a digest: for those it is the term.
    """
    kept = cut_lineage(_frequent(_counted(rows, bits, False), ["digest"], least_docs))
    wanted = cut_lineage(kept.select("digest").distinct())
    n = wanted.count()
    # Few digests go to the texts; many meet the strings where equal ones have been put together.
    small = np.sort(wanted.toPandas()["digest"].to_numpy()) if 0 < n <= digests else None
    names = _spelled(rows, bits, small).groupBy("digest").agg(F.min("term").alias("low"), F.max("term").alias("high"))
    names = cut_lineage(names if small is not None else names.join(wanted, "digest", "left_semi"))
    shared = fitting(names.filter("low <> high").select("digest"), digests)
    plain = kept.withColumn("tag", F.lit(""))
    if shared.isEmpty():
        return plain.select("lang", "source", "digest", "tag", "n"), names
    split = _counted(rows, bits, True).join(shared, "digest", "left_semi").withColumnRenamed("term", "tag")
    exact = _frequent(split, ["digest", "tag"], least_docs)
    whole = plain.join(shared, "digest", "left_anti").select("lang", "source", "digest", "tag", "n")
    return cut_lineage(whole.unionByName(exact)), names


def share(n: Column, all_n: Column, v: Column, added: int = ADDED, units: int = UNITS) -> Column:
    """1 + floor(units * (n + added) / (all_n + added * v)), exact; without terms just a number."""
    above = (n + F.lit(added)).cast("decimal(19,0)") * F.lit(units).cast("decimal(10,0)")
    below = F.greatest(all_n + F.lit(added) * v, F.lit(1)).cast("decimal(20,0)")
    return F.call_function("div", above, below).cast("bigint") + F.lit(1)


def _gaps(vectors: DataFrame) -> DataFrame:
    """``lang, g, h, value``: summed absolute differences of the shares of two sources.

    ``vectors`` has a row per kept term: the shares of sources without the term (``base``, by
    number) and the numbers and shares of those with it. A task adds its terms up; it holds a
    slice of terms by all sources of the language, and sums up to ``CELLS`` numbers.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}

        def given() -> Iterator[pa.RecordBatch]:
            for (lang, g), sums in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang]), pa.array([g], pa.int32()), pa.array([sums], pa.list_(pa.int64()))], ["lang", "g", "sums"]
                )
            held.clear()

        for batch in batches:
            by_lang = defaultdict(list)
            for lang, base, numbers, shares in zip(*(c.to_pylist() for c in batch.columns)):
                by_lang[lang].append((base, numbers, shares))
            for lang, some in by_lang.items():
                base = np.array(some[0][0], np.int64)
                step = max(1, CELLS // len(base))
                for start in range(0, len(some), step):
                    part = some[start : start + step]
                    matrix = np.tile(base, (len(part), 1))
                    for row, (_, numbers, shares) in zip(matrix, part):
                        row[numbers] = shares
                    for g in range(len(base)):
                        sums = np.abs(matrix - matrix[:, g : g + 1]).sum(axis=0)
                        held[lang, g] = held[lang, g] + sums if (lang, g) in held else sums
                        if sum(map(len, held.values())) > CELLS and len(held) > 1:
                            yield from given()
        yield from given()

    rows = vectors.select("lang", "base", "numbers", "shares")
    sums = map_batches(rows, add, "lang string, g int, sums array<bigint>")
    each = sums.select("lang", "g", F.posexplode("sums").alias("h", "v"))
    return each.groupBy("lang", "g", "h").agg(F.sum("v").alias("value"))


def audit(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
    least_docs: int = LEAST_DOCS, top: int = TOP, digest_bits: int = 64, digests: int = DIGESTS,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: how far sources are apart, and by which terms.

    Part ``pair``: every other source of the language by summed difference of term shares.
    Part ``term``: the terms that the source uses more than its language does, up to ``top``.
    Only terms in at least ``least_docs`` rows of the language count; ties go by item. NULLs
    in any of the three columns are empty strings; repeated rows count again; a language
    without kept terms gives pairs of value 0; an empty table gives an empty one; other
    columns are left out.
    """
    rows = _rows(docs, text_col, lang_col, source_col)
    kept, names = kept_terms(rows, least_docs, digest_bits, digests)
    key = ["lang", "digest", "tag"]
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    kinds = kept.groupBy(*key).agg(F.sum("n").alias("t")).groupBy("lang").agg(F.count("*").alias("v"), F.sum("t").alias("lang_n"))
    groups = rows.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(kinds, "lang", "left")
    groups = groups.select(
        "lang", "source", *[F.coalesce(c, F.lit(0)).alias(f"of_{c}") for c in ("n", "v", "lang_n")],
        (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("g"),
    )
    groups = cut_lineage(groups.withColumn("base", share(F.lit(0), F.col("of_n"), F.col("of_v"))))
    few = groups.count() <= BROADCAST_ROWS
    sized = (lambda df: F.broadcast(df)) if few else (lambda df: df)

    shares = kept.join(sized(groups), ["lang", "source"])
    shares = shares.withColumn("p", share(F.col("n"), F.col("of_n"), F.col("of_v")))
    in_lang = F.sum("n").over(Window.partitionBy(*key))
    excess = shares.withColumn("value", F.col("p") - share(in_lang, F.col("of_lang_n"), F.col("of_v")))
    own = Window.partitionBy("lang", "source")
    # Ties at the last rank stay until their strings decide.
    best = excess.filter("value > 0").select(*key, "source", "value")
    best = best.withColumn("place", F.rank().over(own.orderBy(F.desc("value")))).filter(F.col("place") <= top)
    named = best.join(names.select("digest", "low"), "digest").withColumn("item", F.when(F.col("tag") == "", F.col("low")).otherwise(F.col("tag")))
    order = own.orderBy(F.desc("value"), "item")
    by_term = named.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)

    langs = groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("g", "base", "source"))).alias("all"))
    langs = langs.select("lang", F.col("all.base").alias("base"), F.col("all.source").alias("sources"))
    vectors = shares.groupBy(*key).agg(F.collect_list(F.struct("g", "p")).alias("x"))
    vectors = vectors.select("lang", F.col("x.g").alias("numbers"), F.col("x.p").alias("shares")).join(sized(langs), "lang")
    others = groups.select("lang", "source", "g").join(sized(langs.select("lang", "sources")), "lang")
    others = others.select("lang", "source", "g", F.posexplode("sources").alias("h", "item")).filter("g <> h")
    by_pair = others.join(_gaps(vectors), ["lang", "g", "h"], "left").withColumn("value", F.coalesce("value", F.lit(0)))
    by_pair = by_pair.withColumn("rank", F.row_number().over(order))

    def part(df: DataFrame, name: str) -> DataFrame:
        return df.select("lang", "source", F.lit(name).alias("part"), "item", F.col("value").cast("bigint"), F.col("rank").cast("int"))

    return part(by_pair, "pair").unionByName(part(by_term, "term"))


ORACLE_SQL = r"""
    WITH words AS (
        SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
        FROM documents
    ),
    flat AS (SELECT lang, source, r, unnest(w) AS term FROM words),
    terms AS (SELECT lang, term, count(*) AS t FROM flat GROUP BY ALL HAVING count(DISTINCT r) >= 30),
    langs AS (
        SELECT lang, count(term) AS v, coalesce(sum(t), 0)::BIGINT AS lang_n
        FROM (SELECT DISTINCT lang FROM words) LEFT JOIN terms USING (lang) GROUP BY lang
    ),
    groups AS (SELECT DISTINCT lang, source FROM words),
    used AS (SELECT lang, source, term, count(*) AS n FROM flat GROUP BY ALL),
    cells AS (
        SELECT g.lang, g.source, term, t, coalesce(n, 0) AS n, v, lang_n, (sum(coalesce(n, 0)) OVER (PARTITION BY g.lang, g.source))::BIGINT AS all_n
        FROM groups g JOIN terms USING (lang) JOIN langs USING (lang) LEFT JOIN used USING (lang, source, term)
    ),
    shares AS (
        SELECT lang, source, term, n,
               1 + (1000000000 * (n + 5)::HUGEINT) // (all_n + 5 * v) AS p, 1 + (1000000000 * (t + 5)::HUGEINT) // (lang_n + 5 * v) AS q
        FROM cells
    ),
    pairs AS (
        SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
        FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
    ),
    found AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
        FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
        UNION ALL
        SELECT lang, source, 'term', term, (p - q)::BIGINT FROM shares WHERE n > 0 AND p > q
    )
    SELECT lang, source, part, item, value,
           row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
    FROM found QUALIFY part = 'pair' OR rank <= 50
    """
