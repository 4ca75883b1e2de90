"""Quality rules as a short-circuit cascade, ordered by rejections per cost on a sample.

All DataFrame functions. The base measures of every document are exact; the further rules
stand in one CASE, so a document that a rule rejects is not shown to the later ones. The
order only saves work: the verdict is the same in any order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import narrow, words

WINDOW = 8
# Words that running text of the four languages cannot do without.
STOP_WORDS = (
    "the of and to in is that it for on was with as by be are this at from "
    "der die und das den von zu mit ist sich auf des "
    "le de la les et des un une en est que dans pour "
    "el los las y por con para se del una"
).split()
SYMBOLS = r"[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """``rejects`` over the measures, the text, its words ``_w`` and lines ``_l``; ``sql`` is its twin.

    ``work`` is what the condition costs on a row: the characters it goes through, and ``ITEM``
    for each word or line that it takes up.
    """

    name: str
    rejects: str
    sql: str
    work: str = "length(text)"

    @property
    def column(self) -> Column:
        return F.expr(self.rejects)


# Starting on one word or line costs about as much as so many characters of a scan.
ITEM = 8


def _same(name: str, condition: str) -> Rule:
    """A rule on measures that are there already."""
    return Rule(name, condition, condition, "1")


_STOPS = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
RULES = (
    _same("word_length", "word_chars < 2 * n_words OR word_chars > 14 * n_words"),
    _same("symbols", "5 * n_symbols > n_words"),
    Rule("repeated_lines", "2 * n_dup_lines > size(_l)", "2 * n_dup_lines > len(l)", "1"),
    Rule(
        "exclamations", "5 * length(regexp_replace(text, '[^!]+', '')) > n_words",
        "5 * length(regexp_replace(text, '[^!]+', '', 'g')) > n_words",
    ),
    Rule(
        "letters", "10 * size(filter(_w, w -> w RLIKE '[\\\\p{L}]')) < 7 * n_words",
        "10 * len(list_filter(w, lambda x: regexp_matches(x, '\\p{L}'))) < 7 * n_words",
        f"{ITEM} * n_words",
    ),
    Rule(
        "ellipsis_lines", "10 * size(filter(_l, x -> x RLIKE '(\\\\.\\\\.\\\\.|…)[ \\\\t]*$')) > 3 * size(_l)",
        "10 * len(list_filter(l, lambda x: regexp_matches(x, '(\\.\\.\\.|…)[ \\t]*$'))) > 3 * len(l)",
        f"length(text) + {ITEM} * size(_l)",
    ),
    Rule(
        "bullet_lines", "10 * size(filter(_l, x -> x RLIKE '^[ \\\\t]*[-*•]')) > 9 * size(_l)",
        "10 * len(list_filter(l, lambda x: regexp_matches(x, '^[ \\t]*[-*•]'))) > 9 * len(l)",
        f"{ITEM} * size(_l)",
    ),
    Rule(
        "stop_words", f"n_words >= 50 AND size(array_intersect(_w, array({_STOPS}))) < 2",
        f"n_words >= 50 AND len(list_intersect(w, [{_STOPS}])) < 2",
        f"word_chars + {ITEM} * n_words",
    ),
)


def measured(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text, _w, _l`` and the exact base measures, as longs."""
    df = narrow(docs, id_col, text_col).withColumn("_w", words(F.col("text")))
    last = F.size("_w") - WINDOW
    hashes = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.slice(F.col("_w"), i + 1, WINDOW))
    )
    none = F.array().cast("array<bigint>")
    df = df.select(
        "*",
        F.size("_w").cast("bigint").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace("text", "[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_l"),
        F.when(last >= 0, hashes).otherwise(none).alias("_h"),
    )
    # Windows with different hashes differ. Only where two hashes agree are the windows
    # themselves sorted and compared, each with its neighbours.
    windows = F.array_sort(
        F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.struct(F.array_join(F.slice(F.col("_w"), i + 1, WINDOW), " ").alias("k"), i.alias("i")),
        )
    )
    df = df.select(
        "*",
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("_h")) < F.size("_h"), windows).alias("_s"),
    ).drop("_h")
    key = lambda j: F.get(F.col("_s"), j)["k"]
    twice = F.filter(
        F.transform(
            F.sequence(F.lit(0), F.size("_s") - 1),
            lambda j: F.when(
                F.coalesce(key(j) == key(j - 1), F.lit(False)) | F.coalesce(key(j) == key(j + 1), F.lit(False)),
                F.get(F.col("_s"), j)["i"],
            ),
        ),
        lambda i: i.isNotNull(),
    )
    # Starts in order; each adds the words that the windows before it do not reach.
    covered = F.aggregate(
        F.sort_array(F.col("_t")),
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, i: F.struct(
            (a["n"] + i + WINDOW - F.greatest(i, a["end"])).alias("n"), (i + WINDOW).alias("end")
        ),
        lambda a: a["n"],
    )
    df = df.withColumn("_t", F.when(F.col("_s").isNotNull(), twice)).drop("_s")
    repeated = F.when(F.col("_t").isNull(), 0).otherwise(covered)
    return df.withColumn("n_repeat_words", repeated.cast("bigint")).drop("_t")


BASE = "n_words < 20 OR 100 * n_repeat_words > 30 * n_words"


def estimate(rows: DataFrame, rules=RULES) -> dict[str, tuple[float, float]]:
    """Rule -> (work a row, rejected share) over measured rows that the base rule keeps.

    One job for all rules; the measures are kept for it, so that they are not computed rule by
    rule. Work is counted, not timed: the same sample always gives the same order, whatever else
    the machines do. Without such rows (1, 0).
    """
    rows = rows.persist()
    figures = [
        f
        for i, rule in enumerate(rules)
        for f in (F.avg(F.expr(rule.work)).alias(f"w{i}"), F.avg(rule.column.cast("int")).alias(f"r{i}"))
    ]
    try:
        seen = rows.filter(f"NOT ({BASE})").agg(F.count("*").alias("n"), *figures).first()
    finally:
        rows.unpersist()
    if not seen["n"]:
        return {r.name: (1.0, 0.0) for r in rules}
    return {r.name: (max(seen[f"w{i}"], 1.0), seen[f"r{i}"] or 0.0) for i, r in enumerate(rules)}


def ordered(rules, estimates: dict[str, tuple[float, float]]) -> list[Rule]:
    """Most rejections per work first; of equal ones the cheaper."""
    return sorted(rules, key=lambda r: (-estimates[r.name][1] / estimates[r.name][0], estimates[r.name][0]))


def sampled(docs: DataFrame, sample_rows: int, seed: int = 7) -> DataFrame:
    """About so many random rows; all rows of a smaller table."""
    total = docs.count()
    return docs if total <= sample_rows else docs.sample(sample_rows / total, seed=seed)


def judge(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES, sample_rows: int = 2_000
) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept``.

    One pass over the texts, and before it a sample of about ``sample_rows`` documents; no
    shuffle of texts. A NULL or empty text has no words and fails the base rule. Repeated
    rows give repeated rows, an empty table an empty one; a NULL id stays NULL; other
    columns are left out.
    """
    rows = measured(docs, id_col, text_col)
    cascade = F.when(F.col("base_failed"), False)
    sample = measured(sampled(docs, sample_rows), id_col, text_col)
    for rule in ordered(rules, estimate(sample, rules)):
        cascade = cascade.when(rule.column, False)
    return rows.withColumn("base_failed", F.expr(BASE)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        cascade.otherwise(True).alias("kept"),
    )


def oracle_sql(rules=RULES) -> str:
    """The same in DuckDB's SQL over ``documents`` with distinct ids."""
    verdict = " OR ".join(f"({r.sql})" for r in rules)
    return f"""
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS text,
               list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
               list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
        FROM documents
    ), windows AS (
        SELECT doc_id, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS k
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d)
    ), twice AS (
        SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS n FROM windows) WHERE n > 1
    ), covered AS (
        SELECT doc_id, count(DISTINCT i + o) AS n FROM twice, range({WINDOW}) AS r(o) GROUP BY doc_id
    ), m AS (
        SELECT d.*, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
               length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
               (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words
        FROM d LEFT JOIN covered USING (doc_id)
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           ({BASE}) AS base_failed, NOT ({BASE}) AND NOT ({verdict}) AS kept
    FROM m
    """
