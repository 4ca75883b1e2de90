"""Near-duplicates by ProbMinHash, banding and verification.

Documents are weighted sets of word shingles (weight: how often). Every shingle sends a
Poisson process of arrivals at a rate of its weight, each arrival falling on a random
register; a register keeps the shingle that came first. Two documents agree in a register
with the probability that is their probability Jaccard similarity. Arrivals later than all
registers' current firsts cannot count, which ends most processes after one arrival.

Documents with equal words are one node. Nodes that agree in a band of registers meet in a
bucket. There each is compared with the bucket's hub only, not with all others. Where a
bucket still holds several components, an exact join finds every missing link between them:
two texts of similarity s share at least the mass s of both, so the rarest shingle that they
share is among the rarest of each up to a mass of 1 - s; only nodes that share such a one,
and are not connected yet, are compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import require
from ..functions.storage import cut_lineage
from .common import fitting, map_batches, narrow, once_per_worker, parts_of, quoted
from .graph import components, mapped

SHINGLE, SIMILARITY = 5, 0.8
# 20 bands of 5 registers: a pair of similarity 0.8 meets with a probability of 0.9996.
BANDS, ROWS = 20, 5
REMEMBERED = 100_000
# Earlier shingles of a prefix that each of its rows carries.
PRIOR = 16
# Longs of a set's parity bits.
PARITY = 16
_U = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters them (the finaliser of splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        import xxhash

        value = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


def split_words(text: str) -> list[str]:
    """Runs of characters other than space and \\x09 to \\x0D."""
    for c in "\n\t\r\x0b\x0c":
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def shingles(texts: list[list[str]], known: dict, size: int = SHINGLE):
    """``document, shingle, weight`` as flat arrays, by document and shingle.

    A text of fewer words than a shingle is one shingle; one without words has none.
    """
    lengths = np.array([len(w) for w in texts], np.int64)
    flat = np.fromiter((known[w] for ws in texts for w in ws), np.uint64, int(lengths.sum()))
    ends = np.cumsum(lengths)
    doc = np.repeat(np.arange(len(texts)), lengths)
    place = np.arange(len(flat)) - np.repeat(ends - lengths, lengths)
    left = np.repeat(lengths, lengths) - place
    value = np.zeros(len(flat), np.uint64)
    padded = np.concatenate([flat, np.zeros(size, np.uint64)])
    for k in range(size):
        part = _mixed(padded[k : k + len(flat)] + _U((2 * k + 1) * 0x9E3779B97F4A7C15 % 2**64))
        value += np.where(left > k, part, _U(0))
    starts = (left >= size) | (place == 0)
    doc, value = doc[starts], _mixed(value[starts])
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(new)
    return doc[at], value[at], np.diff(np.append(at, len(doc)))


def prob_min_hash(doc, value, weight, documents: int, registers: int) -> np.ndarray:
    """First shingle per register of every document; 0 for documents without shingles."""
    first = np.full(documents * registers, np.inf)
    winner = np.zeros(documents * registers, np.uint64)
    time = np.zeros(len(doc))
    turn = 0
    while len(doc):
        turn += 1
        seed = _mixed(value + _U(turn * 0xD1342543DE82EF95 % 2**64))
        u = ((seed >> _U(11)).astype(np.float64) + 0.5) / 2.0**53
        time = time - np.log(u) / weight
        slot = doc * registers + (_mixed(seed) % _U(registers)).astype(np.int64)
        np.minimum.at(first, slot, time)
        won = first[slot] == time
        winner[slot[won]] = value[won]
        latest = first.reshape(documents, registers).max(axis=1)
        alive = time < latest[doc]
        doc, value, weight, time = doc[alive], value[alive], weight[alive], time[alive]
    return winner.reshape(documents, registers)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per document and band; keys of different bands differ."""
    parts = signature.reshape(len(signature), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for k in range(rows):
        key = _mixed(key * _U(0x9E3779B97F4A7C15) + parts[:, :, k])
    return key


def probability_jaccard(ka, wa, kb, wb, least: float = 0.0) -> float:
    """Similarity of two weighted sets with sorted keys; below ``least`` just a bound."""
    if not len(ka) or not len(kb):
        return 0.0
    at = np.minimum(np.searchsorted(kb, ka), len(kb) - 1)
    hit = kb[at] == ka
    x, y, all_x, all_y = wa[hit], wb[at[hit]], wa.sum(), wb.sum()
    bound = min(x.sum() / all_x, y.sum() / all_y)
    if bound < least or not len(x):
        return float(bound)
    ratio = y / x
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    low = np.cumsum(x)[np.searchsorted(ratio, ratio, side="right") - 1]
    high = y.sum() - np.cumsum(y)[np.searchsorted(ratio, ratio, side="right") - 1]
    total = (all_x - x.sum() + low) / x + (all_y - y.sum() + high) / y
    return float((1 / total).sum())


def _node(words: list[str]) -> bytes:
    return hashlib.blake2b(" ".join(words).encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _slices(batches: Iterator[pa.RecordBatch], size: int = 300):
    """Slices of few rows, with the worker's memory of word hashes kept in bounds."""
    known = once_per_worker(("word hashes",), _WordHashes)
    for whole in batches:
        for batch in parts_of(whole, size):
            if len(known) > REMEMBERED:
                known.clear()
            yield batch, [split_words(t) for t in batch.column("text").to_pylist()], known


def sketches(rows: DataFrame, bands: int = BANDS, band_rows: int = ROWS) -> DataFrame:
    """``doc_id, digest, text`` to ``doc_id, digest, node, bands``."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts, known in _slices(batches):
            doc, value, weight = shingles(texts, known)
            signature = prob_min_hash(doc, value, weight, len(texts), bands * band_rows)
            keys = band_keys(signature, bands, band_rows).astype(np.int64).tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("digest"), pa.array([_node(t) for t in texts], pa.binary()),
                    pa.array([k if t else [] for k, t in zip(keys, texts)], pa.list_(pa.int64())),
                ],
                ["doc_id", "digest", "node", "bands"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(rows, sketch, f"doc_id {kind}, digest binary, node binary, bands array<bigint>")


def _weighted_sets(rows: DataFrame) -> DataFrame:
    """``text`` to ``node, keys, weights, parity``: sorted shingles and how often each occurs.

    Each shingle flips one of the parity bits, so two sets differ in at least as many
    shingles as their parities do in bits.
    """

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts, known in _slices(batches):
            doc, value, weight = shingles(texts, known)
            bits = 64 * PARITY
            odd = np.bincount(doc * bits + (value % _U(bits)).astype(np.int64), minlength=bits * len(texts)) & 1
            parity = np.packbits(odd.astype(np.uint8).reshape(-1, 64), axis=1).view(np.int64).ravel()
            value = value.astype(np.int64)
            ends = np.searchsorted(doc, np.arange(len(texts) + 1)).astype(np.int32)
            for a, b in zip(ends, ends[1:]):
                order = np.argsort(value[a:b], kind="stable")
                value[a:b], weight[a:b] = value[a:b][order], weight[a:b][order]
            lists = [pa.ListArray.from_arrays(ends, pa.array(v)) for v in (value, weight.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_node(t) for t in texts], pa.binary()), *lists, pa.FixedSizeListArray.from_arrays(pa.array(parity), PARITY).cast(pa.list_(pa.int64()))],
                ["node", "keys", "weights", "parity"],
            )

    return map_batches(rows, collect, "node binary, keys array<bigint>, weights array<int>, parity array<bigint>")


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``a, b`` whose weighted sets are similar enough."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in parts_of(whole, 1000):
                flat = [c.values.to_numpy() for c in batch.columns[2:]]
                cuts = [c.offsets.to_numpy() for c in batch.columns[2:]]
                good = []
                for i in range(batch.num_rows):
                    ka, wa, kb, wb = [f[c[i] : c[i + 1]] for f, c in zip(flat, cuts)]
                    good.append(probability_jaccard(ka, wa.astype(float), kb, wb.astype(float), similarity) >= similarity - 1e-9)
                yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    for side in ("a", "b"):
        pairs = pairs.join(
            sets.select(F.col("node").alias(side), F.col("keys").alias(f"k{side}"), F.col("weights").alias(f"w{side}")), side
        )
    return map_batches(pairs.select("a", "b", "ka", "wa", "kb", "wb"), verify, "a binary, b binary")


def _open_pairs(mixed: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Every pair of differently labelled nodes that can reach the similarity, or more pairs.

    ``mixed`` has ``node, label``. Shingles are ordered by how many of these nodes have them.
    If two sets share the shares cx and cy of their mass, their similarity is at most
    1 / (1/cx + 1/cy - 1). What lies before the first shingle that they share is not shared,
    so that shingle must stand early enough in both. And if they differ in d shingles, the
    larger mass being m, it is at most 1 / (1 + d / (m - d/2)); parities bound d from below.

    (With A = 1/cx - 1 and B = 1/cy - 1, and u, v the shared parts scaled to mass 1, a term
    of the similarity is 1 / (A/u + B/v + S), by Cauchy-Schwarz at most (A u + B v + 1/S) /
    (1 + A + B)^2; all 1/S sum up to a similarity, at most 1, which gives the first bound.
    What is not shared weighs 1 a shingle at least, which gives the second.)
    """
    reach = 1 + 1 / similarity + 1e-6
    differ = (1 / similarity - 1) / (1 + (1 / similarity - 1) / 2) + 1e-6
    own = sets.join(mixed, "node").select("node", "label", F.explode(F.arrays_zip("keys", "weights")).alias("s"))
    own = own.select("node", "label", F.col("s.keys").alias("key"), F.col("s.weights").alias("weight"))
    common = own.groupBy("key").agg(F.count("*").alias("n"))
    parts = [f"p{i}" for i in range(PARITY)]
    mass = sets.join(mixed, "node").select(
        "node", F.aggregate("weights", F.lit(0), lambda a, w: a + w).alias("mass"),
        *[F.get("parity", F.lit(i)).alias(p) for i, p in enumerate(parts)],
    )
    order = Window.partitionBy("node").orderBy("n", "key")
    ranked = own.join(common, "key").withColumn(
        "before", F.coalesce(F.sum("weight").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    # 1/cx, if the shingle is the first one shared.
    prefix = ranked.join(mass, "node").withColumn("need", F.col("mass") / (F.col("mass") - F.col("before")))
    prefix = prefix.filter((F.col("need") + 1 <= reach) & (F.col("n") > 1))
    # A few shingles before each, by which most pairs are met at their first one only.
    prefix = cut_lineage(
        prefix.select("node", "label", "key", "need", "mass", *parts, F.collect_list("key").over(order.rowsBetween(-PRIOR, -1)).alias("prior"))
    )
    # Only shingles whose nodes have different labels can join two components.
    several = prefix.groupBy("key").agg(F.min("label").alias("l"), F.max("label").alias("h")).filter("l <> h").select("key")
    prefix = prefix.join(several, "key", "left_semi")
    sides = [
        prefix.select("key", F.col("node").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("label", "need", "mass", "prior", *parts)])
        for s in ("a", "b")
    ]
    apart = reduce(Column.__add__, [F.bit_count(F.col(f"{p}_a").bitwiseXOR(F.col(f"{p}_b"))) for p in parts])
    met = (
        (F.col("a") < F.col("b")) & (F.col("label_a") != F.col("label_b"))
        & (F.col("need_a") + F.col("need_b") <= reach)
        & (apart <= differ * F.greatest("mass_a", "mass_b")) & ~F.arrays_overlap("prior_a", "prior_b")
    )
    same = F.col("x.key") == F.col("y.key")
    return sides[0].alias("x").join(sides[1].alias("y"), same & met).select("a", "b").distinct()


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY,
    bands: int = BANDS, band_rows: int = ROWS,
) -> DataFrame:
    """``doc_id, group_id, group_size, kept`` (and ``digest`` of the text), one row per row.

    Documents joined by a chain of links of at least ``similarity`` are one group, named by
    its smallest id, which stays; of rows that repeat one id exactly one stays. Texts with
    the same words are alike, also two without any word; those are similar to nothing else.
    A NULL text is an empty one; NULL ids come last; an empty table gives an empty one; other
    columns are left out.
    """
    rows = narrow(docs, id_col, text_col).withColumn("digest", F.unhex(F.md5("text")))
    known = cut_lineage(
        sketches(rows, bands, band_rows).withColumn("row", F.monotonically_increasing_id())
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row"))
    nodes = cut_lineage(
        known.groupBy("node").agg(first.alias("first"), F.count("*").alias("n"), F.any_value("bands").alias("bands"))
    )
    members = nodes.select("node", F.explode("bands").alias("bucket"))
    # One order of hubs for all buckets, by the digest: a group has few, a node is linked to each once.
    hubs = members.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("hub")).filter("n > 1")
    meeting = cut_lineage(members.join(hubs.select("bucket", "hub"), "bucket"))
    wanted = meeting.select("node").distinct().join(nodes, "node").select(F.col("first.doc_id").alias("wanted_id"))
    texts = rows.join(wanted.distinct(), F.col("doc_id").eqNullSafe(F.col("wanted_id")), "left_semi")
    sets = cut_lineage(_weighted_sets(texts.select("text")).dropDuplicates(["node"]))

    starred = meeting.filter(F.col("node") != F.col("hub")).select(
        F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")
    ).distinct()
    links = cut_lineage(_verified(starred, sets, similarity))
    labels = components(links)
    # Buckets that hold several components still.
    labelled = meeting.select("bucket", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    labelled = cut_lineage(labelled)
    torn = labelled.groupBy("bucket").agg(F.min("label").alias("l"), F.max("label").alias("h")).filter("l <> h")
    mixed = cut_lineage(labelled.join(torn.select("bucket"), "bucket", "left_semi").select("node", "label").distinct())
    more = _verified(_open_pairs(mixed, sets, similarity), sets, similarity)
    more = cut_lineage(more)
    if not more.isEmpty():
        # Between components already found, not over all links again.
        joined = components(mapped(mapped(more, "a", labels), "b", labels))
        alone = joined.join(labels.select("node"), "node", "left_anti")
        labels = cut_lineage(mapped(labels, "label", joined).unionByName(alone))

    grouped = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    groups = grouped.groupBy("label").agg(F.min("first").alias("first"), F.sum("n").alias("group_size"))
    of_node = grouped.select("node", "label").join(groups, "label").select("node", "first", "group_size")
    return known.select("doc_id", "digest", "node", "row").join(of_node, "node").select(
        "doc_id", F.col("first.doc_id").alias("group_id"), "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"), "digest",
    )


def near_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """The rows of ``docs`` that stay, one of each group, all columns as they were."""
    require(docs, id_col, text_col)
    groups = cut_lineage(near_groups(docs, id_col, text_col, similarity).select("doc_id", "digest", "kept"))
    fates = groups.groupBy("doc_id", "digest").agg(F.count("*").alias("n"), F.max("kept").alias("kept"))
    gone = fitting(fates.filter("NOT kept").select("doc_id", "digest"))
    digest = F.unhex(F.md5(F.coalesce(quoted(text_col).cast("string"), F.lit(""))))

    def renamed(keys: DataFrame) -> DataFrame:
        return keys.select(F.col("doc_id").alias("_gone_id"), F.col("digest").alias("_gone_digest"))

    match = quoted(id_col).eqNullSafe(F.col("_gone_id")) & digest.eqNullSafe(F.col("_gone_digest"))
    left = docs.join(renamed(gone), match, "left_anti")
    repeated = cut_lineage(fates.filter("kept AND n > 1").select("doc_id", "digest"))
    if repeated.isEmpty():
        return left
    # The same id and text more than once: one row of each stays.
    again = left.join(renamed(repeated), match, "left_semi").select(F.struct("*").alias("_row"), digest.alias("_digest"))
    # The row with the least hash, found where the rows are before any meet.
    again = again.withColumn("_order", F.xxhash64(F.to_json("_row")))
    one = again.groupBy(F.col(f"_row.`{id_col}`").alias("_id"), "_digest").agg(F.min_by("_row", "_order").alias("_row"))
    again = one.select("_row.*")
    return left.join(renamed(repeated), match, "left_anti").unionByName(again)
