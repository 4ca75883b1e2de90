"""URL filter: rules by host and path, and a weighted vocabulary found by Aho-Corasick."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from ..functions.columns import require
from .common import map_batches, once_per_worker, parts_of, quoted

# (verdict, host, path): a rule fits the host and its subdomains where the path starts so.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
# One strict term rejects; of soft terms several distinct ones do.
STRICT = ("adult", "camgirl", "casino", "cialis", "escort", "hentai", "malware", "phishing", "porn", "porno", "viagra", "warez", "xxx")
SOFT = (
    "ads", "bet", "bets", "bonus", "buy", "cheap", "crack", "deal", "deals", "discount", "farm", "free", "gambling",
    "hot", "jackpot", "keygen", "loan", "loans", "nude", "offer", "payday", "pills", "poker", "prize", "promo", "sexy",
    "slots", "spam", "torrent", "track", "tracker", "tracking", "win", "winner",
)
SOFT_HITS = 2
_LOWER = {c: c + 32 for c in range(65, 91)}
_WORD = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


def parts(url: str | None) -> tuple[str, str]:
    """Host (ASCII letters lower-cased) and path; both empty without ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host, path = rest[:end].translate(_LOWER), rest[end:]
    stop = min((i for i in map(path.find, "?#") if i >= 0), default=len(path))
    return host, path[:stop]


def rule_for(host: str, path: str, rules) -> tuple[str, str] | None:
    """``(rule, verdict)`` of the longest rule that fits."""
    fits = [
        (len(h + p), h + p, verdict)
        for verdict, h, p in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[1:] if fits else None


def build_automaton(strict, soft):
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for kind, terms in (("soft", soft), ("strict", strict)):
        for term in terms:
            automaton.add_word(term, (term, kind))
    automaton.make_automaton()
    return automaton


def term_hits(text: str, automaton) -> tuple[int, int]:
    """Distinct strict and soft terms in the text that stand between non-alphanumerics."""
    found = {"strict": set(), "soft": set()}
    for end, (term, kind) in automaton.iter(text):
        start = end - len(term) + 1
        before = start == 0 or text[start - 1] not in _WORD
        if before and (end + 1 == len(text) or text[end + 1] not in _WORD):
            found[kind].add(term)
    return len(found["strict"]), len(found["soft"])


def judge_urls(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules=RULES,
    strict=STRICT,
    soft=SOFT,
    soft_hits: int = SOFT_HITS,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, n_strict, n_soft`` of every url.

    The longest fitting rule decides. Where none fits, the vocabulary does: terms are
    searched in all that follows ``://`` (in the whole url without it). Terms are lower-case and
    may be any number: a worker builds its automaton once, and a url is read once.

    A NULL or empty url has empty host and path, no hits, and is allowed. Repeated rows
    give repeated rows, an empty table an empty one; other columns are left out.
    """
    require(pages, id_col, url_col)
    strict, soft = tuple(strict), tuple(soft)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = once_per_worker(("urls", strict, soft), lambda: build_automaton(strict, soft))
        for whole in batches:
            for batch in parts_of(whole, 5000):
                rows = []
                for url in batch.column(1).to_pylist():
                    host, path = parts(url)
                    rule = rule_for(host, path, rules)
                    rest = (url or "").partition("://")
                    hard, mild = term_hits((rest[2] if rest[1] else rest[0]).translate(_LOWER), automaton)
                    verdict = rule[1] if rule else "block" if hard or mild >= soft_hits else "allow"
                    rows.append((host, path, rule and rule[0], verdict, hard, mild))
                columns = list(zip(*rows)) if rows else [()] * 6
                kinds = [pa.string()] * 4 + [pa.int64()] * 2
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                    ["page_id", "host", "path", "rule", "verdict", "n_strict", "n_soft"],
                )

    rows = pages.select(quoted(id_col).alias("page_id"), quoted(url_col).cast("string").alias("url"))
    kind = rows.schema["page_id"].dataType.simpleString()
    return map_batches(
        rows, judge, f"page_id {kind}, host string, path string, rule string, verdict string, n_strict bigint, n_soft bigint"
    )


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def oracle_sql(rules=RULES, strict=STRICT, soft=SOFT, soft_hits: int = SOFT_HITS) -> str:
    """The same in DuckDB's SQL over ``pages``."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    hits = lambda terms: " + ".join(
        f"regexp_matches(rest, '(^|[^a-z0-9]){t}([^a-z0-9]|$)')::BIGINT" for t in terms
    )
    ranked = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    fits = [
        f"WHEN (host = {_sql_text(h)} OR ends_with(host, {_sql_text('.' + h)})) AND starts_with(path, {_sql_text(p)}) THEN "
        for _, h, p in ranked
    ]
    rule = " ".join(f + _sql_text(h + p) for f, (_, h, p) in zip(fits, ranked))
    verdict = " ".join(f + _sql_text(v) for f, (v, _, _) in zip(fits, ranked))
    return f"""
    WITH cut AS (
        SELECT page_id, coalesce(url, '') AS url, strpos(coalesce(url, ''), '://') AS mark FROM pages
    ), split AS (
        SELECT page_id,
               CASE WHEN mark > 0 THEN translate(regexp_extract(url[mark + 3:], '^[^/?#]*'), '{upper}', '{lower}') ELSE '' END AS host,
               CASE WHEN mark > 0 THEN regexp_extract(regexp_replace(url[mark + 3:], '^[^/?#]*', ''), '^[^?#]*') ELSE '' END AS path,
               translate(CASE WHEN mark > 0 THEN url[mark + 3:] ELSE url END, '{upper}', '{lower}') AS rest
        FROM cut
    ), counted AS (
        SELECT *, {hits(strict)} AS n_strict, {hits(soft)} AS n_soft FROM split
    )
    SELECT page_id, host, path, CASE {rule} END AS rule,
           CASE {verdict} WHEN n_strict > 0 OR n_soft >= {soft_hits} THEN 'block' ELSE 'allow' END AS verdict,
           n_strict, n_soft
    FROM counted
    """
