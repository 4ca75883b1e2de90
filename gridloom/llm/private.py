"""Personal data: base patterns, and unseen identifiers by bootstrapped contextual extraction.

The base finds e-mail addresses, IP addresses, card and phone numbers by their form. Its
finds are seeds: what stands around them becomes lexical patterns - the two words before,
and backing off from these one word before or after with the identifier's shape, and the
shape alone. Patterns and the identifiers that show them form a graph, and a few rounds pass
confidence from instances to patterns and back. Identifiers with a pattern of high confidence
are added to the spans. All DataFrame functions; texts are read once and never shuffled, only
spans are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.storage import cut_lineage
from .common import fitting, narrow

KINDS = ("email", "ip", "card", "phone")
_LOCAL, _HOST = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
# The same matches as the plain patterns, written so that Java's matcher neither goes back
# over long runs nor recurses deeply: a match starts where a run does, or at the end of the
# match before. A possessive group is matched in a loop, over any number of labels.
EMAIL = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Separators that do not stand between two digits; without them a card is a plain run.
_LOOSE = r"[\x20-](?![0-9])|(?<![0-9])[\x20-]"
CARD = r"[0-9][\x200-9-]{11,}"
_CARD_HINT = r"[0-9](?:[\x20-]?[0-9]){11}"
# Something like an identifier: neighbouring tokens with a digit or an at sign, however many.
_INK = r"[^\x20\x09-\x0D]"
_TOKEN = rf"[^\x20\x09-\x0D0-9@]*+[0-9@]{_INK}*+"
CANDIDATE = rf"(?<!{_INK}){_TOKEN}(?:\x20{_TOKEN})*+"
# Marks around a candidate, or around what base spans leave of it, are no part of it.
_HEAD_GLUE, _TAIL_GLUE = r"^[^\p{L}\p{N}@+(]++", r"(?<![^\p{L}\p{N}])[^\p{L}\p{N}]++$"
# An identifier as a word of the context of what follows it; a word there is known by its last characters.
_STAND_IN, _WORD_END = "0", 48
ROUNDS, CONFIDENT, SUPPORT, DIGITS = 3, 0.8, 3, 4
# Backed-off patterns say less, so they need more confident instances.
WORD_SUPPORT, SHAPE_SUPPORT = 5, 20

_SPAN = "array<struct<start:int,end:int,hit:string>>"
_CUT = "struct<start:int,k:int,end:int,hit:string>"
_PART = "struct<start:int,end:int,k:int,hit:string>"
_NAMED = "array<struct<pattern:string,need:int>>"


def located(text: Column, pattern: str) -> Column:
    """Matches in order: start and end in code points, and the match."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.slice(F.split(text, pattern), F.lit(1), F.size(hits))
    start = lambda a, x: a["at"] + F.length(x["b"])
    end = lambda a, x: a["at"] + F.length(x["b"]) + F.length(x["h"])
    found = lambda a, x: F.struct(start(a, x).alias("start"), end(a, x).alias("end"), x["h"].alias("hit"))
    return F.aggregate(
        F.arrays_zip(between.alias("b"), hits.alias("h")),
        F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out")),
        lambda a, x: F.struct(end(a, x).alias("at"), F.concat(a["out"], F.array(found(a, x))).alias("out")),
        lambda a: a["out"],
    )


def _placed(text: Column, pattern: str, words_of: Callable) -> Column:
    """Matches with the last two ``words_of`` all that stands before them, and the next word.

    The next word is looked for up to the next match. A match stands in the words of those behind it as one stand-in, so contexts that differ in
    an earlier identifier only are one.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern)
    between = F.slice(pieces, F.lit(1), F.size(hits))
    behind = F.transform(F.slice(pieces, F.lit(2), F.size(hits)), _first_word)
    start = lambda a, x: a["at"] + F.length(x["b"])
    end = lambda a, x: a["at"] + F.length(x["b"]) + F.length(x["h"])
    words = lambda a, x: _last_two(F.concat(a["words"], x["w"]))
    found = lambda a, x: F.struct(
        start(a, x).alias("start"), end(a, x).alias("end"), x["h"].alias("hit"), words(a, x).alias("words"),
        x["n"].alias("after"),
    )
    return F.aggregate(
        F.arrays_zip(between.alias("b"), hits.alias("h"), F.transform(between, words_of).alias("w"), behind.alias("n")),
        F.struct(
            F.lit(0).alias("at"), F.array().cast("array<string>").alias("words"),
            F.array().cast("array<struct<start:int,end:int,hit:string,words:array<string>,after:string>>").alias("out"),
        ),
        lambda a, x: F.struct(
            end(a, x).alias("at"), F.concat(words(a, x), F.array(F.lit(_STAND_IN))).alias("words"),
            F.concat(a["out"], F.array(found(a, x))).alias("out"),
        ),
        lambda a: a["out"],
    )


def _last_two(words: Column) -> Column:
    return F.slice(words, F.greatest(F.size(words) - 1, F.lit(1)), F.lit(2))


def _last_words(before: Column) -> Column:
    """The last two words of a stretch of text, or fewer, in lower case."""
    plain = F.lower(F.regexp_replace(before, r"[^\p{L}\p{N}=:#]+", " "))
    words = F.filter(F.split(plain, " "), lambda w: w != "")
    last = F.flatten(F.transform(F.array(words), _last_two))  # the words are split once
    return F.transform(last, lambda w: F.right(w, F.lit(_WORD_END)))


def _first_word(behind: Column) -> Column:
    """The first word of a stretch of text, in lower case; empty without one."""
    return F.left(F.lower(F.regexp_extract(behind, r"[\p{L}\p{N}=:#]++", 0)), F.lit(_WORD_END))


def shape(hit: Column) -> Column:
    """Digits as 9, runs of letters as a; a plus in front and spaces around dots and dashes do not matter."""
    marks = F.regexp_replace(F.regexp_replace(hit, r"\p{L}+", "a"), "[0-9]", "9")
    return F.regexp_replace(F.regexp_replace(marks, r"^\++", ""), r"\x20*+([.-])\x20*+", "$1")


def _patterns(words: Column, place: Column, after: Column, hit: Column, support: int) -> Column:
    """Patterns of the part at ``place`` of a candidate, with the support each needs.

    A pattern whose words lie outside the text is left out. Shapes tell something where the
    part has enough digits only; the caller drops them otherwise.
    """
    words = F.concat(words, F.array_repeat(F.lit(_STAND_IN), F.least(place, F.lit(2))))
    made = [
        (F.when(F.size(words) >= 2, F.concat(F.lit("2 "), F.array_join(_last_two(words), " "))), support),
        (F.when(F.size(words) >= 1, F.concat(F.lit("b "), F.element_at(words, -1), F.lit(" "), shape(hit))), WORD_SUPPORT),
        (F.when(after != "", F.concat(F.lit("a "), after, F.lit(" "), shape(hit))), WORD_SUPPORT),
        (F.concat(F.lit("s "), shape(hit)), SHAPE_SUPPORT),
    ]
    made = F.array(*[F.struct(name.alias("pattern"), F.lit(max(need, support)).alias("need")) for name, need in made])
    return F.filter(made, lambda m: m["pattern"].isNotNull())


def _once(value: Column, use: Callable) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _parts(c: Column) -> Column:
    """A candidate in order: the base spans that start in it, and what they leave of it."""
    part = lambda start, end, k, hit: F.struct(
        start.cast("int").alias("start"), end.cast("int").alias("end"), k.cast("int").alias("k"), hit.alias("hit")
    )
    none = F.array().cast(f"array<{_PART}>")
    gap = lambda start, end, b: F.struct(start.alias("start"), end.alias("end"), b.alias("b"))
    gaps = F.aggregate(
        c["cuts"],
        F.struct(c["start"].alias("at"), F.array().cast(f"array<struct<start:int,end:int,b:{_CUT}>>").alias("out")),
        lambda a, b: F.struct(
            F.greatest(a["at"], b["end"]).alias("at"), F.concat(a["out"], F.array(gap(a["at"], b["start"], b))).alias("out")
        ),
        lambda a: F.concat(a["out"], F.array(gap(a["at"], c["end"], F.lit(None).cast(_CUT)))),
    )

    def left(g: Column) -> Column:
        hit = F.substring(c["hit"], g["start"] - c["start"] + 1, g["end"] - g["start"])
        headless = lambda t: F.regexp_replace(t, _HEAD_GLUE, "")
        tailless = lambda t: F.regexp_replace(t, _TAIL_GLUE, "")
        begin = lambda t, w: g["start"] + F.length(t) - F.length(w)
        found = lambda t, w: part(begin(t, w), begin(t, w) + F.length(w), F.lit(None), w)
        parts = lambda t: _once(headless(t), lambda w: F.when(w.rlike("[0-9@]"), F.array(found(t, w))).otherwise(none))
        return F.when(
            g["start"] < g["end"], _once(hit, lambda h: F.when(h.rlike("[0-9@]"), _once(tailless(h), parts)).otherwise(none))
        ).otherwise(none)

    b = lambda g, name: g["b"][name]
    seed = lambda g: F.when(
        b(g, "start") >= g["start"], F.array(part(b(g, "start"), b(g, "end"), b(g, "k"), b(g, "hit")))
    ).otherwise(none)
    parts = F.flatten(F.transform(gaps, lambda g: F.concat(left(g), seed(g))))
    return _once(parts, lambda all_: F.transform(all_, lambda p, i: p.withField("last", i == F.size(all_) - 1)))


def _tokens(parts: DataFrame) -> DataFrame:
    """``row, run, start, end, hit``: the tokens of parts of several, each without the marks around it."""
    split = parts.filter(F.col("hit").contains(" ")).select("row", "run", F.posexplode(F.split("hit", " ")).alias("n", "token"))
    order = Window.partitionBy("row", "run").orderBy("n")
    ends = split.withColumn("begin", F.col("run") + F.sum(F.length("token") + 1).over(order) - F.length("token") - 1)
    lead = F.length(F.regexp_extract("token", _HEAD_GLUE, 0))
    bare = F.regexp_replace(F.regexp_replace("token", _TAIL_GLUE, ""), _HEAD_GLUE, "")
    found = ends.select("row", "run", (F.col("begin") + lead).cast("int").alias("start"), bare.alias("hit"))
    return found.withColumn("end", F.col("start") + F.length("hit"))


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]+", "")


def _luhn(digits: Column) -> Column:
    places = F.sequence(F.lit(1), F.length(digits))
    value = lambda i: F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
    twice = lambda i: value(i) * 2 - F.when(value(i) > 4, 9).otherwise(0)
    total = F.aggregate(places, F.lit(0), lambda a, i: a + F.when(i % 2 == 1, value(i)).otherwise(twice(i)))
    return total % 10 == 0


def _ip_fits(hit: Column) -> Column:
    parts = F.transform(F.split(hit, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.substring(p, 1, 3).cast("int") <= 255))


def base_spans(text: Column, kind: str) -> Column:
    """Spans of one kind; a match that fails its check is dropped and not retried."""
    none = F.array().cast(_SPAN)
    within = lambda hit, low, high: F.length(_digits(hit)).between(low, high)
    if kind == "email":
        hint, found, fits = text.contains("@"), located(text, EMAIL), lambda s: F.lit(True)
    elif kind == "ip":
        hint, found, fits = text.rlike(r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]"), located(text, IP), lambda s: _ip_fits(s["hit"])
    elif kind == "card":
        hint = text.rlike(_CARD_HINT)
        found = located(F.regexp_replace(text, _LOOSE, "\u0001"), CARD)
        fits = lambda s: within(s["hit"], 12, 19) & _luhn(_digits(s["hit"]))
    else:
        hint, found, fits = text.contains("+"), located(text, PHONE), lambda s: within(s["hit"], 9, 15)
    return F.when(hint, F.filter(found, fits)).otherwise(none)


def scored_patterns(
    edges: DataFrame, rounds: int = ROUNDS, confident: float = CONFIDENT, support: int = SUPPORT
) -> DataFrame:
    """``pattern, kind, score`` of confident patterns of a pattern-instance graph.

    ``edges`` has distinct ``pattern, instance, kind``; ``kind`` is that of a seed or NULL.
    A pattern's score for a kind is the mean confidence of its instances, an instance's is
    what its confident patterns leave no doubt about; seeds are certain. A pattern needs
    ``support`` instances that are themselves confident, seeds or discovered in a round before;
    a column ``need`` names it pattern by pattern.
    """
    edges = cut_lineage(edges if "need" in edges.columns else edges.withColumn("need", F.lit(support)))
    seeds = edges.filter("kind IS NOT NULL").select("instance", "kind", F.lit(1.0).alias("sure")).distinct()
    sizes = edges.groupBy("pattern").agg(F.countDistinct("instance").alias("n"), F.max("need").alias("need"))
    links = edges.select("pattern", "instance").distinct()
    known, patterns = seeds, None
    for _ in range(rounds):
        sums = links.join(known, "instance").groupBy("pattern", "kind").agg(
            F.sum("sure").alias("sure"), F.count_if(F.round("sure", 9) >= confident).alias("backing")
        )
        patterns = sums.join(sizes, "pattern").select(
            "pattern", "kind", F.round(F.col("sure") / F.col("n"), 9).alias("score"), "backing", "need"
        )
        patterns = cut_lineage(patterns.filter((F.col("score") >= confident) & (F.col("backing") >= F.col("need"))))
        doubt = F.sum(F.log(1 - F.least(F.col("score"), F.lit(0.99))))
        reached = links.join(patterns, "pattern").groupBy("instance", "kind").agg((1 - F.exp(doubt)).alias("sure"))
        reached = reached.join(seeds.select("instance", "kind"), ["instance", "kind"], "left_anti")
        known = seeds.unionByName(reached)
    return patterns.select("pattern", "kind", "score")


def _listed(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    name = lambda s: F.get(F.array(*map(F.lit, KINDS)), s["k"])
    one = lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(F.array_sort(spans), one), ",")


def find_private(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS,
    confident: float = CONFIDENT, support: int = SUPPORT, digits: int = DIGITS,
) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added, n_spans``,
    one row per row.

    Base spans are always kept; the method adds identifiers of at least ``digits`` digits, or
    with an at sign, that show a confident pattern: two words before them (``support``
    confident instances), a word before or after and their shape (5), or their shape (20).
    Where a run of tokens shows none, its tokens are looked at by shape one by one. A run of tokens that base spans
    lie in is cut there: the rest is looked at, the base spans are the seeds.

    NULL and empty texts have no spans (the digest of nothing, an empty list); repeated rows
    give repeated rows and count as one instance; an empty table gives an empty one; a NULL
    id stays NULL; other columns are left out.
    """
    rows = narrow(docs, id_col, text_col)
    for kind in KINDS:
        rows = rows.withColumn(kind, base_spans(F.col("text"), kind))
    tagged: Callable = lambda kind, k: F.transform(
        kind, lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("k"), s["end"].alias("end"), s["hit"].alias("hit"))
    )
    base = F.array_sort(F.concat(*[tagged(F.col(kind), k) for k, kind in enumerate(KINDS)]))
    rows = rows.select(
        "doc_id", *[F.size(kind).cast("bigint").alias(f"n_{kind}") for kind in KINDS], base.alias("base"),
        F.when(F.col("text").rlike("[0-9@]"), _placed(F.col("text"), CANDIDATE, _last_words)).alias("maybe"),
    )
    rows = cut_lineage(rows.withColumn("row", F.monotonically_increasing_id()))

    cut: Callable = lambda c: F.filter("base", lambda b: (b["start"] < c["end"]) & (b["end"] > c["start"]))
    seen = rows.select("row", F.explode(F.transform("maybe", lambda c: c.withField("cuts", cut(c)))).alias("c"))
    part = F.posexplode(_parts(F.col("c"))).alias("place", "p")
    seen = seen.select("row", "c.words", "c.after", part).select(
        "row", F.col("p.start").alias("start"), F.col("p.end").alias("end"), F.col("p.hit").alias("hit"), F.col("p.k").alias("kind"),
        _patterns(
            F.col("words"), F.col("place"), F.when(F.col("p.last"), F.col("after")).otherwise(_STAND_IN), F.col("p.hit"), support
        ).alias("patterns"),
    )
    seen = cut_lineage(seen.withColumn("run", F.col("start")))
    # The tokens of a part of several are looked at by shape, and count where the whole is not found.
    by_shape = F.array(F.struct(F.concat(F.lit("s "), shape(F.col("hit"))).alias("pattern"), F.lit(max(SHAPE_SUPPORT, support)).alias("need")))
    like_one = (F.length(_digits(F.col("hit"))) >= digits) | F.col("hit").contains("@")
    alone = _tokens(seen.filter(F.col("kind").isNull() & like_one)).filter(like_one)
    alone = alone.select("*", F.lit(None).cast("int").alias("kind"), by_shape.alias("patterns"), F.lit(False).alias("whole"))
    every = seen.withColumn("whole", F.lit(True)).unionByName(alone)
    # Short numbers can be no find; they count against the words before them, not as shapes.
    told = F.filter("patterns", lambda m: F.col("like_one") | m["pattern"].startswith("2 "))
    every = every.withColumn("like_one", like_one | F.col("kind").isNotNull()).select(
        "row", "run", "whole", "start", "end", "kind", "like_one", F.lower("hit").alias("instance"), F.explode(told.cast(_NAMED)).alias("m")
    ).select("*", "m.pattern", "m.need").drop("m")
    patterns = scored_patterns(every.select("pattern", "instance", "kind", "need").distinct(), rounds, confident, support)
    best = patterns.groupBy("pattern").agg(F.max(F.struct("score", (-F.col("kind")).alias("minus"))).alias("best"))
    unseen = every.filter("kind IS NULL AND like_one").join(fitting(best), "pattern")
    finds = unseen.groupBy("row", "run", "whole", "start", "end").agg((-F.max("best")["minus"]).alias("k"))
    finds = finds.groupBy("row", "run").agg(
        F.max("whole").alias("whole"), F.collect_list(F.struct("start", "k", "end", "whole")).alias("spots")
    )
    spots = F.transform(F.filter("spots", lambda x: x["whole"] == F.col("whole")), lambda x: x.dropFields("whole"))
    added = finds.select("row", spots.alias("spots")).groupBy("row").agg(
        F.flatten(F.collect_list("spots")).alias("added")  # spans of one text
    )
    none = F.array().cast("array<struct<start:int,k:int,end:int>>")
    spots = F.transform("base", lambda b: b.dropFields("hit"))
    rows = rows.withColumn("base", spots).drop("maybe").join(added, "row", "left").withColumn("added", F.coalesce("added", none))
    return rows.select(
        "doc_id", *[f"n_{kind}" for kind in KINDS], F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.concat("base", "added")).alias("spans"), F.size("added").cast("bigint").alias("n_added"),
        (F.size("base") + F.size("added")).cast("bigint").alias("n_spans"),
    )
