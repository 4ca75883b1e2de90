"""Best-fit packing of token sequences by large-item matching.

Documents become lists of token ids; those above the capacity are cut. Lengths are whole
numbers up to the capacity, so the packing is decided on the table of counts per length,
which is as small for 100 TB as for a megabyte: pieces above a third of the capacity are
matched in pairs, at most two in a sequence, the largest with the largest partner that fits
(which gives the most pairs); smaller ones go, largest first, into the smallest gap that
takes them. Equal sequences are handled as one interval of numbers, so the plan is a list of
runs: the pieces of one length from one rank on fill such an interval. Ranks come from counts
per slice of the written table, and each piece looks its run up where it lies.
"""

from __future__ import annotations

import gc
import json
import os
import re
import zlib
from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.storage import cut_lineage
from .common import fitting, map_batches, narrow, once_per_worker, tokenizer_path

VOCABULARY = "word_bpe_49k.json"
CAPACITY, END_ID = 4096, 1
# Words, and parts of words, that a worker remembers, and the longest of them.
REMEMBERED, SHORT = 500_000, 64

# The vocabulary files whose words never reach over white space have this
# normaliser and these patterns.
SAFE_NORMALIZERS = ["NFC", "NFD", "NFKC", "NFKD", "Lowercase"]
SAFE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"

# The same pattern for words in Latin characters, which Unicode has settled long ago and whose
# normal form is themselves: its matches are encoded apart, so "Sea," and "sea" share one.
_LATIN = [c for c in map(chr, [*range(0x21, 0x7F), *range(0xA1, 0x250)]) if c not in "\u0130\xad"]
_LETTERS = re.escape("".join(c for c in _LATIN if c.isalpha()))
_NUMBERS = re.escape("".join(c for c in _LATIN if c.isnumeric()))
_PLAIN = re.compile(f"[{re.escape(''.join(_LATIN))}]+")
_PARTS = re.compile(
    f"'[sStTmMdD]|'[rR][eE]|'[vV][eE]|'[lL][lL]|[{_LETTERS}]+|[{_NUMBERS}]|[^{_LETTERS}{_NUMBERS}]+"
)


def _cuts_at_spaces(parts: dict) -> bool:
    """Whether no token and no rule of the vocabulary looks over ASCII white space."""
    normal = (parts["normalizer"] or {}).get("normalizers", [])
    for n in normal:
        spaces = n["type"] == "Replace" and n["pattern"] == {"Regex": "\\s+"} and n["content"] == " "
        if n["type"] not in SAFE_NORMALIZERS and not spaces:
            return False
    split = ((parts["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0]
    words = split.get("type") == "Split" and split["pattern"] == {"Regex": SAFE_PATTERN} and split["invert"]
    plain = not any(t["lstrip"] or t["rstrip"] or len(t["content"].split()) != 1 for t in parts["added_tokens"])
    return bool(words and split["behavior"] == "Removed" and plain)


class Encoder:
    """Token ids of UTF-8 texts, as little-endian 32-bit numbers, exactly as the library gives them.

    Where the vocabulary allows it, texts are cut at ASCII white space; words met before are
    looked up, and new Latin ones are put together from their parts. The library encodes what
    is new, many parts at a time: a part ends with the one token that has the word end.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        parts = json.loads(self.library.to_str())
        self.safe = _cuts_at_spaces(parts)
        lower = any(n["type"] == "Lowercase" for n in (parts["normalizer"] or {}).get("normalizers", []))
        self.by_parts = self.safe and lower and parts["model"].get("end_of_word_suffix") == WORD_END
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(WORD_END)]] = True
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _whole(self, words: list[str]) -> list[bytes]:
        codes = self.library.encode_batch_fast(words, add_special_tokens=False)
        return [_ids(code.ids) for code in codes]

    def _encode_parts(self, new: list[str]) -> None:
        for start in range(0, len(new), 5000):
            some = new[start : start + 5000]
            code = self.library.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0]
            ids = np.array(code.ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(some):  # not as expected of the vocabulary: one by one
                self.parts.update(zip(some, self._whole(some)))
                continue
            all_ids, at = ids.tobytes(), 0
            for part, end in zip(some, (4 * cuts).tolist()):
                self.parts[part] = all_ids[at:end]
                at = end

    def _learn(self, new: list[str]) -> None:
        """The ids of new words."""
        odd = [w for w in new if not (self.by_parts and _PLAIN.fullmatch(w)) or "<|" in w]
        for start in range(0, len(odd), 1000):
            some = odd[start : start + 1000]
            self.words.update(zip(some, self._whole(some)))
        plain = list({*new}.difference(odd))
        found = [_PARTS.findall(w.lower() if w.isascii() else w) for w in plain]
        missing = {p for ps in found for p in ps if p not in self.parts}
        if len(self.parts) + len(missing) > REMEMBERED:
            self.parts.clear()
            missing = {p for ps in found for p in ps}
        self._encode_parts(list(missing))
        get = self.parts.__getitem__
        self.words.update(zip(plain, [get(ps[0]) if len(ps) == 1 else b"".join(map(get, ps)) for ps in found]))
        for part in missing:
            if len(part) > SHORT:
                del self.parts[part]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other, and where each text's ids end.

        Each word is looked up once a batch; the ids are then gathered by number.
        """
        if self.safe:
            lists = pc.ascii_split_whitespace(texts)
            coded, ends = lists.flatten().dictionary_encode(), lists.offsets.to_numpy()[1:] - lists.offsets[0].as_py()
        else:
            coded, ends = texts.dictionary_encode(), np.arange(1, len(texts) + 1)
        words, of = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        was_on = gc.isenabled()
        gc.disable()  # only strings and bytes are made, in large numbers
        try:
            if self.safe:
                missing = [w for w in words if w not in self.words]
                if len(self.words) + len(missing) > REMEMBERED:
                    self.words.clear()
                    missing = words
                self._learn(missing)
                codes = list(map(self.words.__getitem__, words))
                for w in missing:
                    if len(w) > SHORT:
                        del self.words[w]
            else:
                codes = self._whole(words)
        finally:
            if was_on:
                gc.enable()
        sizes = np.fromiter(map(len, codes), np.int64, len(codes)) // 4
        held = np.frombuffer(b"".join(codes), "<u4")
        starts, counts = (np.cumsum(sizes) - sizes)[of], sizes[of]
        upto = np.concatenate([[0], np.cumsum(counts)])
        return held[np.repeat(starts - upto[:-1], counts) + np.arange(upto[-1])], upto[ends]


def _ids(codes: list[int]) -> bytes:
    return np.array(codes, "<u4").tobytes()


def pieces(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY,
    capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, slice, place`` (and ``ids``) of every piece.

    A document is its ids and the end id; only one above ``capacity`` is cut, into pieces of
    that length, the last one may be shorter. ``place`` counts pieces of one length in a slice
    (a task of this pass).
    """
    rows, width = narrow(docs, id_col, text_col), 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer_path(vocabulary)
        encoder = once_per_worker(("packing", path), lambda: Encoder(path))
        own, seen = TaskContext.get().partitionId(), defaultdict(int)
        for batch in batches:
            ids, ends = encoder.encode(batch.column(1))
            all_ids = np.insert(ids, ends, end_id).astype("<u4").tobytes()
            starts = [0, *(4 * (ends + np.arange(1, len(ends) + 1))).tolist()]
            of, number, start, length, crc, place, kept = [], [], [], [], [], [], []
            for i, (first, last) in enumerate(zip(starts, starts[1:])):
                for k, at in enumerate(range(first, last, width)):
                    part = all_ids[at : min(at + width, last)]
                    n = len(part) // 4
                    of.append(i)
                    number.append(k)
                    start.append(k * capacity)
                    length.append(n)
                    crc.append(zlib.crc32(part))
                    place.append(seen[n])
                    seen[n] += 1
                    if keep_ids:
                        kept.append(part)
            columns = {
                "doc_id": batch.column(0).take(pa.array(of, pa.int64())), "piece": pa.array(number, pa.int32()),
                "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()),
                "ids_crc32": pa.array(crc, pa.int64()), "slice": pa.array([own] * len(of), pa.int32()),
                "place": pa.array(place, pa.int64()),
            }
            if keep_ids:
                columns["ids"] = pa.array(kept, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, slice int, place bigint"
    return map_batches(rows, cut, schema + (", ids binary" if keep_ids else ""))


def plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Runs ``length, first, per, sequence, offset`` that place ``counts`` pieces per length.

    Piece ``first + j`` of a length lies in ``sequence + j // per`` at ``offset + (j % per) *
    length``. There are at most two intervals of equal sequences a length, and one that takes
    a piece at least halves its gap, so the number of runs has a bound that depends on the
    capacity alone, not on the counts.
    """
    left, used = dict(counts), dict.fromkeys(counts, 0)
    runs, gaps, open_gaps, total = [], defaultdict(list), [], 0

    def take(length: int, n: int, per: int, sequence: int, offset: int) -> None:
        runs.append((length, used[length], per, sequence, offset))
        used[length] += n
        left[length] -= n

    def add_gap(gap: int, first: int, n: int) -> None:
        if gap and n:
            if not gaps[gap]:
                insort(open_gaps, gap)
            gaps[gap].append((first, n))

    large = sorted(n for n in counts if 3 * n > capacity)
    for a in reversed(large[:]):
        while left[a]:
            most = bisect_right(large, min(a, capacity - a)) - 1
            if most >= 0 and large[most] == a and left[a] == 1:
                most -= 1
            if most < 0:
                n, gap = left[a], capacity - a
                take(a, n, 1, total, 0)
            elif large[most] == a:
                n, gap = left[a] // 2, capacity - 2 * a
                take(a, 2 * n, 2, total, 0)
            else:
                b = large[most]
                n, gap = min(left[a], left[b]), capacity - a - b
                take(a, n, 1, total, 0)
                take(b, n, 1, total, a)
                if not left[b]:
                    large.remove(b)
            add_gap(gap, total, n)
            total += n
        if a in large:
            large.remove(a)
    for length in sorted((n for n in counts if 3 * n <= capacity), reverse=True):
        while left[length]:
            at = bisect_left(open_gaps, length)
            if at == len(open_gaps):
                gap, first, n = capacity, total, -(-left[length] // (capacity // length))
                total += n
            else:
                gap = open_gaps[at]
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    del open_gaps[at]
            per = min(gap // length, left[length])
            full = min(n, left[length] // per)
            take(length, full * per, per, first, capacity - gap)
            add_gap(gap - per * length, first, full)
            add_gap(gap, first + full, n - full)
    return np.array(sorted(runs), np.int64).reshape(-1, 5)


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY,
    capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``) of every piece.

    No sequence is longer than ``capacity``, pieces lie in it without gaps from 0, and every
    document is there whole. A NULL or empty text is the end id alone; repeated rows and NULL
    ids are packed like others; an empty table gives an empty one; other columns are left out.

    The pieces are written once, so every later step sees the same. To the driver comes one
    number per length, to the tasks the runs of the plan.
    """
    cut = cut_lineage(pieces(docs, id_col, text_col, vocabulary, capacity, end_id, keep_ids))
    sliced = cut_lineage(cut.groupBy("slice", "length").agg(F.count("*").alias("n")))
    counts = {r.length: r.n for r in sliced.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = plan(counts, capacity)
    earlier = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sliced.select("slice", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = cut.join(fitting(offsets), ["slice", "length"]).withColumn("rank", F.col("before") + F.col("place"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = (runs[:, 0] << 44) + runs[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            run = runs[np.searchsorted(starts, (length << 44) + rank, side="right") - 1]
            turn, along = np.divmod(rank - run[:, 1], run[:, 2])
            columns = {n: batch.column(n) for n in names}
            columns["sequence_id"] = pa.array(run[:, 3] + turn, pa.int64())
            columns["offset"] = pa.array(run[:, 4] + along * length, pa.int64())
            yield pa.RecordBatch.from_pydict(columns)

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema if f.name in names)
    placed = map_batches(ranked.select(*names, "rank"), place, f"{types}, sequence_id bigint, offset bigint")
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *["ids"] * keep_ids)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, n_tokens, ids, doc_ids, starts``: what a trainer reads, one row a sequence.

    ``packed`` comes from ``pack(..., keep_ids=True)``. ``ids`` are the bytes of little-endian
    32-bit numbers of all pieces in order; ``starts`` says where each piece begins. A group
    never holds more than one sequence's tokens.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
    grouped = packed.groupBy("sequence_id").agg(parts.alias("p"))
    return grouped.select(
        "sequence_id", F.aggregate("p.length", F.lit(0).cast("bigint"), lambda a, n: a + n).alias("n_tokens"),
        F.aggregate("p.ids", F.lit(b""), lambda a, x: F.concat(a, x)).alias("ids"),
        F.col("p.doc_id").alias("doc_ids"), F.col("p.offset").alias("starts"),
    )
