"""Token counts: batch encoding in Arrow functions, of which only lengths come back."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_batches, narrow, once_per_worker, parts_of, tokenizer_path

VOCABULARY = "byte_bpe_50k.json"
# White space as Unicode has it; Python's \s also takes the separators \x1c to \x1f.
_GAP, _INK = r"[^\S\x1c-\x1f]", r"[\S\x1c-\x1f]"
# A text may be cut wherever ink is followed by a gap: every token of the byte-level
# pre-tokenizer takes white space only in front of ink, and it never looks back.
_SAFE = re.compile(f"{_GAP}*{_INK}+|{_GAP}+")
# Pieces of up to this many characters are remembered, and at most so many of them.
SHORT = 48
REMEMBERED = 200_000


def balanced(texts: Iterable[str], most_bytes: int) -> Iterator[list[str]]:
    """Lists of texts of about equal bytes; a text above the limit is a list of its own."""
    batch, size = [], 0
    for text in texts:
        n = len(text) if text.isascii() else len(text.encode("utf-8", "surrogatepass"))
        if batch and size + n > most_bytes:
            yield batch
            batch, size = [], 0
        batch.append(text)
        size += n
    if batch:
        yield batch


def _load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(path)
    encoder.no_truncation()
    encoder.no_padding()
    parts = json.loads(encoder.to_str())
    before = parts["pre_tokenizer"] or {}
    byte_level = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
    # Added tokens are found before all else; they must not reach over a cut.
    plain = not any(
        t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"]) for t in parts["added_tokens"]
    )
    return encoder, bool(byte_level and plain and parts["normalizer"] is None), {}


def token_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
    limit: int = 512,
    batch_bytes: int = 256_000,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every whole text.

    ``vocabulary`` is a file of the tokenizers library, by path or installed name.

    Texts are cut at safe boundaries, so even the longest is encoded in bounded batches,
    and a piece that a worker has met before is not encoded again (bounded memory). Where
    the vocabulary gives no such boundaries, texts are encoded whole. One pass, no shuffle.

    Empty and NULL texts have 0 bytes and 0 tokens; repeated rows give repeated rows; an
    empty table gives an empty one; a NULL id stays NULL; other columns are left out.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer_path(vocabulary)
        encoder, safe, seen = once_per_worker(("tokens", path), lambda: _load(path))
        cut = _SAFE.findall if safe else (lambda text: [text] if text else [])
        for whole in batches:
            for batch in parts_of(whole, 500):
                texts = batch.column(1).to_pylist()
                pieces = [cut(t) for t in texts]
                new = {p for ps in pieces for p in ps if p not in seen}
                if len(seen) + len(new) > REMEMBERED:
                    seen.clear()
                    new = {p for ps in pieces for p in ps}
                for some in balanced(new, batch_bytes):
                    for piece, code in zip(some, encoder.encode_batch_fast(some, add_special_tokens=False)):
                        seen[piece] = len(code)
                tokens = [sum(map(seen.__getitem__, ps)) for ps in pieces]
                for p in new:
                    if len(p) > SHORT:
                        del seen[p]
                sizes = pa.compute.binary_length(batch.column(1)).cast(pa.int64())
                tokens = pa.array(tokens, pa.int64())
                over = pa.compute.greater(tokens, limit)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), sizes, tokens, over], ["doc_id", "n_bytes", "n_tokens", "over_limit"]
                )

    rows = narrow(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(rows, count, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
