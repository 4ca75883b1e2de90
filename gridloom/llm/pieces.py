"""SentencePiece BPE encoding by a prefix table, and decoding.

A BPE encoding has the property that every two neighbours in it are themselves the encoding
of the text they span, and that its beginnings are encodings of their own texts. So each
prefix of a text has one last token: the match that ends there and agrees with the last
token of the prefix before it. The table of last tokens is filled from left to right with
the matches of an automaton over the vocabulary; ids are then read off backwards.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_batches, narrow, once_per_worker, parts_of, tokenizer_path

MODEL = "piece_bpe_32k.model"
SPACE_MARK = "▁"
_WORDS = re.compile(f"{SPACE_MARK}+[^{SPACE_MARK}]*|[^{SPACE_MARK}]+").findall
# Words of up to this many characters are remembered: this many recent ones and as many older.
SHORT, REMEMBERED = 48, 100_000
# So many answers of the pair test.
PAIRS = 250_000


class PieceCoder:
    """Encoder and decoder of one BPE model with byte fallback."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        self.normalize = lib.normalize
        self.eos = lib.eos_id()
        n = lib.get_piece_size()
        plain = [
            i for i in range(n)
            if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i))
        ]
        self.piece = {i: lib.id_to_piece(i) for i in plain}
        self.score = {lib.id_to_piece(i): lib.get_score(i) for i in plain}
        self.ids = {piece: i for i, piece in self.piece.items()}
        self.byte_ids = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        # What each id is in the decoded text, as bytes; control pieces are nothing.
        self.raw = [b""] * n
        for piece, i in self.ids.items():
            self.raw[i] = piece.replace(SPACE_MARK, " ").encode()
        for b, i in enumerate(self.byte_ids):
            self.raw[i] = bytes([b])
        # Two characters that stand side by side in no piece are never in one token.
        self.together = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        # Pieces that have the mark behind another character would forbid to work by words.
        self.by_words = all(SPACE_MARK not in p.lstrip(SPACE_MARK) for p in self.ids)
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            if self.merged(piece) == [piece]:  # a piece that merging never makes is never a token
                self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        self.bits = n.bit_length()
        self.names = [str(i) for i in range(n)]
        self.pairs: dict = {}
        self.recent: dict = {}
        self.older: dict = {}

    def merged(self, text: str) -> list[str]:
        """Merging by score, leftmost first: the definition, used on two pieces at a time."""
        symbols, score = list(text), self.score
        while len(symbols) > 1:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                s = score.get(symbols[i] + symbols[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def _agree(self, key: int, left: int, right: int) -> bool:
        """Whether two tokens are the encoding of their joint text."""
        a, b = self.piece[left], self.piece[right]
        if a[-1] + b[0] not in self.together:
            agree = True
        else:
            agree = a + b not in self.score and self.merged(a + b) == [a, b]
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        self.pairs[key] = agree
        return agree

    def prefix_ids(self, text: str) -> tuple[int, ...]:
        """Ids of a normalised text by the table of last tokens of its prefixes.

        0 in the table is a character without a piece, which becomes its bytes.
        """
        bits, known, agree = self.bits, self.pairs.get, self._agree
        last, width = [0] * (len(text) + 1), [1] * (len(text) + 1)
        for end, (token, size) in self.automaton.iter(text):
            end += 1
            if last[end]:
                continue
            before = last[end - size]
            if before:
                key = before << bits | token
                fits = known(key)
                if fits is None:
                    fits = agree(key, before, token)
                if not fits:
                    continue
            last[end], width[end] = token, size
        out, at = [], len(text)
        while at:
            if last[at]:
                out.append(last[at])
            else:
                out.extend(self.byte_ids[b] for b in reversed(text[at - 1].encode()))
            at -= width[at]
        return tuple(out[::-1])

    def word_ids(self, word: str) -> tuple[int, ...]:
        """Ids of a text without inner word boundary, remembered if it is short."""
        found = self.older.get(word)
        if found is None:
            # Joined from parts that no token can span, so that few texts are new.
            cuts = [i for i in range(1, len(word)) if word[i - 1 : i + 1] not in self.together]
            if cuts:
                found = ()
                for a, b in zip([0, *cuts], [*cuts, len(word)]):
                    found += self.recent.get(word[a:b]) or self.word_ids(word[a:b])
            else:
                found = self.prefix_ids(word)
        if len(word) <= SHORT:
            if len(self.recent) >= REMEMBERED:
                self.older, self.recent = self.recent, {}
            self.recent[word] = found
        return found

    def encode(self, text: str) -> list[int]:
        """Ids of a text, the end id last."""
        text = self.normalize(text)
        if not self.by_words:
            return [*self.prefix_ids(text), self.eos]
        out: list[int] = []
        if SPACE_MARK * 2 in text:
            chunks = _WORDS(text)
        else:
            chunks = [SPACE_MARK + w for w in text.split(SPACE_MARK)]
            chunks[0] = chunks[0][1:]
        for chunk in chunks:
            if chunk:
                out += self.recent.get(chunk) or self.word_ids(chunk)
        out.append(self.eos)
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of the ids: byte pieces joined, the first space that encoding adds removed."""
        data = b"".join(map(self.raw.__getitem__, ids))
        return (data[1:] if data[:1] == b" " else data).decode("utf-8", "replace")


def encode_decode(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL, texts: bool = False
) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``, and with ``texts`` also ``ids, decoded``.

    ``model`` is a BPE model with byte fallback, by path or installed name.

    Every whole text is encoded with an end id and decoded again, in one pass without a
    shuffle; memory is bounded by the longest text and the fixed number of remembered words.

    Empty and NULL texts are the end id alone and decode to the empty text; repeated rows
    give repeated rows; an empty table gives an empty one; other columns are left out.
    """

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer_path(model)
        coder = once_per_worker(("pieces", path), lambda: PieceCoder(path))
        for whole in batches:
            for batch in parts_of(whole, 200):
                counts, ids_hash, text_hash, all_ids, decoded = [], [], [], [], []
                for text in batch.column(1).to_pylist():
                    ids = coder.encode(text)
                    back = coder.decode(ids)
                    counts.append(len(ids))
                    ids_hash.append(hashlib.sha256(" ".join(map(coder.names.__getitem__, ids)).encode()).hexdigest())
                    text_hash.append(hashlib.sha256(back.encode()).hexdigest())
                    if texts:
                        all_ids.append(ids)
                        decoded.append(back)
                columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())]
                if texts:
                    columns += [pa.array(all_ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, heads)

    rows = narrow(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    heads = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids", "decoded"] * texts
    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_batches(rows, code, schema + ", ids array<int>, decoded string" * texts)
