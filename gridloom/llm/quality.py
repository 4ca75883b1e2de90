"""Quality classifier: a generalised additive model with pairwise interactions.

Shallow trees over the bins of one feature at a time are boosted in turn, each adding to
that feature's lookup table; then small trees over the strongest pairs of features do the
same to pair tables. A score is a sum of table entries, looked up for whole batches.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import require
from .common import map_batches, narrow, parts_of, quoted
from .rules import STOP_WORDS

# Labelled rows that a fit takes at most, by order of a hash of their ids.
SAMPLE_ROWS = 20_000
THRESHOLD = 0.7
BINS, PAIR_BINS, PAIRS = 32, 8, 8
ROUNDS, PAIR_ROUNDS, RATE = 60, 30, 0.15
_STOPS = frozenset(STOP_WORDS)
NAMES = (
    "log_words", "word_length", "distinct_words", "repeats_next", "top_word", "distinct_threes", "stop_words",
    "upper", "digits", "sentence_marks", "other_marks", "exclamations", "bars", "non_ascii", "white",
    "log_lines", "line_length", "repeated_lines", "short_lines", "bare_words",
)
_UPPER, _DIGIT, _WHITE, _HIGH = (np.zeros(256) for _ in range(4))
_UPPER[65:91] = _DIGIT[48:58] = _HIGH[128:] = 1
_WHITE[[9, 10, 11, 12, 13, 32]] = 1
_SENTENCE, _MARKS, _BANG, _BAR = (np.zeros(256) for _ in range(4))
_SENTENCE[[ord(c) for c in ".,;:?"]] = _MARKS[[ord(c) for c in "#*$%&<>@=+_~^\\/{}[]\"'()-"]] = 1
_BANG[ord("!")] = _BAR[ord("|")] = 1
_CLASSES = np.stack([_UPPER, _DIGIT, _SENTENCE, _MARKS, _BANG, _BAR, _HIGH, _WHITE], axis=1)


def features(text: str) -> list[float]:
    """The numbers of one text, none of which knows its label, language, source or id."""
    words = text.split()
    n, data = len(words), text.encode()
    if not n:
        return [0.0] * len(NAMES)
    share = np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ _CLASSES / len(data)
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    after, third = words[1:], words[2:]
    return [
        float(np.log1p(n)), sum(map(len, words)) / n, len(counts) / n,
        sum(map(eq, words, after)) / n, max(counts.values()) / n,
        len(set(zip(words, after, third))) / max(1, n - 2) if third else 1.0,
        sum(counts[w] for w in counts.keys() & _STOPS) / n, *share.tolist(),
        float(np.log1p(len(lines))), float(np.log1p(n / len(lines))), 1 - len(set(lines)) / len(lines),
        sum(len(x) < 40 for x in lines) / len(lines), sum(k for w, k in counts.items() if w.isalpha()) / n,
    ]


@dataclass
class AdditiveModel:
    """``edges`` and ``tables`` per feature; ``pairs`` of features with their own tables."""

    start: float
    edges: list = field(default_factory=list)
    tables: list = field(default_factory=list)
    coarse: list = field(default_factory=list)
    pairs: list = field(default_factory=list)
    pair_tables: list = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        for j, (edges, entries) in enumerate(zip(self.edges, self.tables)):
            total += entries[np.searchsorted(edges, x[:, j], side="right")]
        for (a, b), entries in zip(self.pairs, self.pair_tables):
            total += entries[
                np.searchsorted(self.coarse[a], x[:, a], side="right"),
                np.searchsorted(self.coarse[b], x[:, b], side="right"),
            ]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1], method="inverted_cdf"))


def _leaf(g: float, h: float) -> float:
    return g / (h + 1.0)


def _cut(g: np.ndarray, h: np.ndarray, low: int, high: int) -> tuple[float, int]:
    """Gain and place of the best cut of the bins ``low`` to ``high``."""
    if high - low < 2:
        return 0.0, low
    cg, ch = np.cumsum(g[low:high]), np.cumsum(h[low:high])
    lg, lh, rg, rh = cg[:-1], ch[:-1], cg[-1] - cg[:-1], ch[-1] - ch[:-1]
    gain = lg**2 / (lh + 1) + rg**2 / (rh + 1) - cg[-1] ** 2 / (ch[-1] + 1)
    best = int(np.argmax(gain))
    return float(gain[best]), low + best + 1


def _shallow(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Value per bin of a tree of up to four leaves over one feature's bins."""
    spans = [(0, len(g))]
    for _ in range(2):
        spans = [
            part for low, high in spans
            for gain, at in [_cut(g, h, low, high)]
            for part in ([(low, at), (at, high)] if gain > 1e-9 else [(low, high)])
        ]
    out = np.zeros(len(g))
    for low, high in spans:
        out[low:high] = _leaf(g[low:high].sum(), h[low:high].sum())
    return out


def _shallow_pair(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Value per cell, and gain, of a tree that cuts one feature and then the other."""
    best = (np.zeros(g.shape), 0.0)
    for turn in (False, True):
        a, b = (g.T, h.T) if turn else (g, h)
        for at in range(1, len(a)):
            out, gain = np.zeros(a.shape), -a.sum() ** 2 / (b.sum() + 1)
            for rows in (slice(0, at), slice(at, len(a))):
                sg, sh = a[rows].sum(axis=0), b[rows].sum(axis=0)
                _, k = _cut(sg, sh, 0, len(sg))
                for cols in (slice(0, k), slice(k, len(sg))):
                    x, y = sg[cols].sum(), sh[cols].sum()
                    out[rows, cols] = _leaf(x, y)
                    gain += x * x / (y + 1)
            if gain > best[1]:
                best = (out.T if turn else out, gain)
    return best


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Fit on a feature matrix and labels 0 and 1. With one class only, that class is certain."""
    if len(y) == 0 or y.min() == y.max():
        return AdditiveModel(start=30.0 if len(y) == 0 or y[0] == 1 else -30.0)
    model = AdditiveModel(start=float(np.log(y.mean() / (1 - y.mean()))))
    model.edges = [_edges(x[:, j], BINS) for j in range(x.shape[1])]
    model.coarse = [_edges(x[:, j], PAIR_BINS) for j in range(x.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    bins = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.edges)]
    rough = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.coarse)]
    total = np.full(len(y), model.start)

    def gradients():
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j, b in enumerate(bins):
            g, h = gradients()
            size = len(model.tables[j])
            step = RATE * _shallow(np.bincount(b, g, size), np.bincount(b, h, size))
            model.tables[j] += step
            total += step[b]

    def cells(a: int, b: int):
        shape = (len(model.coarse[a]) + 1, len(model.coarse[b]) + 1)
        return rough[a] * shape[1] + rough[b], shape

    def sums(a: int, b: int):
        g, h = gradients()
        at, (n, m) = cells(a, b)
        return [np.bincount(at, v, n * m).reshape(n, m) for v in (g, h)]

    ranked = sorted(
        ((-_shallow_pair(*sums(a, b))[1], a, b) for a in range(x.shape[1]) for b in range(a))
    )[:PAIRS]
    model.pairs = [(a, b) for _, a, b in ranked]
    model.pair_tables = [np.zeros(cells(a, b)[1]) for a, b in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (a, b) in enumerate(model.pairs):
            step = RATE * _shallow_pair(*sums(a, b))[0]
            model.pair_tables[k] += step
            total += step.ravel()[cells(a, b)[0]]
    return model


def _with_features(rows: DataFrame) -> DataFrame:
    """``doc_id, text, ...`` to ``doc_id, ..., x``: the text is replaced by its features."""
    rest = [f for f in rows.schema.fields if f.name != "text"]
    heads = [f.name for f in rest] + ["x"]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in parts_of(whole, 500):
                x = [features(t) for t in batch.column("text").to_pylist()]
                kept = [batch.column(f.name) for f in rest]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(x, pa.list_(pa.float64()))], heads)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest) + ", x array<double>"
    return map_batches(rows, measure, schema)


def held_out(id_column: Column) -> Column:
    """Rows that no fit may see: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(id_column.cast("string")) % 4 == 2, F.lit(False))


def fit_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", sample_rows: int = SAMPLE_ROWS,
) -> AdditiveModel:
    """Fit on at most ``sample_rows`` labelled documents that are not held out.

    Rows without id, label or document are left out; of several labels of one id the larger
    counts, of several texts the one with the least hash, wherever the rows lie. So there is
    one row an id before any reaches the driver.
    """
    require(labels, id_col, label_col)
    known = labels.select(quoted(id_col).alias("doc_id"), quoted(label_col).cast("int").alias("label"))
    known = known.filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)  # so many narrow rows at most
    rows = narrow(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id")
    measured = _with_features(rows.select("doc_id", "label", F.xxhash64("text").alias("h"), "text"))
    once = measured.groupBy("doc_id", "label").agg(F.min(F.struct("h", "x")).alias("m"))
    table = once.select("doc_id", "label", "m.x").toPandas().sort_values("doc_id")
    x = np.array(table["x"].tolist(), float).reshape(len(table), len(NAMES))
    return fit(x, table["label"].to_numpy(float))


def score_quality(
    docs: DataFrame, model: AdditiveModel, id_col: str = "doc_id", text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every whole text, in one pass without a shuffle.

    A NULL text is an empty one and has a score too; a NULL id is not held out; repeated
    rows give repeated rows; an empty table gives an empty one; other columns are left out.
    """

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in parts_of(whole, 500):
                x = np.array([features(t) for t in batch.column(1).to_pylist()]).reshape(-1, len(NAMES))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(model.score(x), pa.float64())], ["doc_id", "score"]
                )

    rows = narrow(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = map_batches(rows, look_up, f"doc_id {kind}, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(
    docs: DataFrame, model: AdditiveModel, text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The rows of ``docs`` whose text is not rejected, all columns as they were."""
    require(docs, text_col)
    names = docs.columns
    at = names.index(text_col)

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in parts_of(whole, 500):
                x = np.array([features(t or "") for t in batch.column(at).to_pylist()]).reshape(-1, len(NAMES))
                yield batch.filter(pa.array(model.score(x) >= threshold))

    # Plain names on the way: the Arrow call looks columns up by name, dots and all.
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    return map_batches(plain, sift, plain.schema).toDF(*names)
