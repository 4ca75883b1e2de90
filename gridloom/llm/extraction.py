"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

Features of a block are what its ancestors say (tags, words of their class and id) and its
text (length, links, punctuation). Weights are trained on labelled pages, and each page's
best labelling is read off by Viterbi. The table of pages has no labels, so the training
pages are composed by rule from layouts whose parts are known to be main text or not.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.columns import require
from .common import map_batches, once_per_worker, parts_of, quoted
from .html_blocks import SIGNS, Block, leaf_blocks

TRAINING_PAGES, SEED = 400, 11
_END = tuple('.!?:;"”»…')
_NOTE = ("copyright", "all rights reserved", "cookie", "subscribe", "newsletter", "advert", "sponsored", "log in", "sign up")
_TEXT = (
    "short", "medium", "long", "ends", "commas", "some_links", "all_links", "note", "mark", "dots", "first", "near_first", "last",
)
N = 2 * len(SIGNS) + len(_TEXT) + 1


def _bits(value: int) -> list[int]:
    out, i = [], 0
    while value:
        if value & 1:
            out.append(i)
        value >>= 1
        i += 1
    return out


def active(blocks: list[Block]) -> list[list[int]]:
    """Indexes of the features that hold for each block."""
    out, last, base = [], len(blocks) - 1, 2 * len(SIGNS)
    for i, block in enumerate(blocks):
        text, words = block.text, block.text.count(" ") + 1
        lower = text.lower() if words < 40 else ""
        share = block.linked / len(text)
        flags = (
            words < 4, 4 <= words < 12, words >= 12, text.endswith(_END), text.count(",") >= 2,
            0.2 < share < 0.8, share >= 0.8, any(n in lower for n in _NOTE), "©" in text, words < 40 and "·" in text,
            i == 0, 0 < i < 3, i == last,
        )
        out.append(
            _bits(block.signs) + [len(SIGNS) + b for b in _bits(block.parent)]
            + [base + k for k, f in enumerate(flags) if f] + [N - 1]
        )
    return out


def _dense(rows: list[list[int]]) -> np.ndarray:
    x = np.zeros((len(rows), N))
    for i, on in enumerate(rows):
        x[i, on] = 1
    return x


class BlockField:
    """Two labels: 1 is main text. ``weights`` favour it; ``steps`` score neighbouring labels."""

    def __init__(self, weights: np.ndarray, steps: np.ndarray):
        self.weights, self.steps = weights, steps

    def label(self, blocks: list[Block]) -> list[int]:
        """Viterbi: the labelling with the highest total score."""
        if not blocks:
            return []
        w, ((s00, s01), (s10, s11)) = self.weights, self.steps
        back: list[tuple[int, int]] = []
        a0 = a1 = 0.0
        for i, on in enumerate(active(blocks)):
            gain = sum(w[k] for k in on)
            if i == 0:
                a0, a1 = 0.0, gain
                continue
            from0, from1 = (int(a1 + s10 > a0 + s00), int(a1 + s11 > a0 + s01))
            back.append((from0, from1))
            a0, a1 = max(a0 + s00, a1 + s10), max(a0 + s01, a1 + s11) + gain
        labels = [int(a1 > a0)]
        for step in reversed(back):
            labels.append(step[labels[-1]])
        return labels[::-1]


def fit_field(pages: list[tuple[list[Block], list[int]]], rounds: int = 150, rate: float = 0.3, penalty: float = 1e-3) -> BlockField:
    """Maximum likelihood by AdaGrad; all pages go forward and backward together, padded."""
    length = max(len(b) for b, _ in pages)
    x, y, on = np.zeros((len(pages), length, N)), np.zeros((len(pages), length), int), np.zeros((len(pages), length), bool)
    for p, (blocks, labels) in enumerate(pages):
        x[p, : len(blocks)], y[p, : len(blocks)], on[p, : len(blocks)] = _dense(active(blocks)), labels, True
    pair = on[:, 1:]
    w, steps = np.zeros(N), np.zeros((2, 2))
    seen_w, seen_s = np.full(N, 1e-8), np.full((2, 2), 1e-8)
    rows = np.arange(len(pages))
    ends = on.sum(axis=1) - 1
    for _ in range(rounds):
        unary = np.zeros((len(pages), length, 2))
        unary[:, :, 1] = x @ w
        ahead, behind = unary.copy(), np.zeros_like(unary)
        for t in range(1, length):
            ahead[:, t] += np.logaddexp.reduce(ahead[:, t - 1, :, None] + steps, axis=1)
        total = np.logaddexp.reduce(ahead[rows, ends], axis=1)
        for t in range(length - 2, -1, -1):
            nxt = np.logaddexp.reduce(steps + (unary[:, t + 1] + behind[:, t + 1])[:, None, :], axis=2)
            behind[:, t] = np.where(pair[:, t, None], nxt, 0.0)
        likely = np.exp(ahead[:, :, 1] + behind[:, :, 1] - total[:, None]) * on
        grad = np.einsum("pt,ptn->n", (y - likely) * on, x) / len(pages) - penalty * w
        both = np.exp(
            ahead[:, :-1, :, None] + steps + (unary[:, 1:] + behind[:, 1:])[:, :, None, :] - total[:, None, None, None]
        ) * pair[:, :, None, None]
        real = np.zeros((2, 2))
        np.add.at(real, (y[:, :-1][pair], y[:, 1:][pair]), 1)
        grad_s = (real - both.sum(axis=(0, 1))) / len(pages) - penalty * steps
        seen_w += grad**2
        seen_s += grad_s**2
        w += rate * grad / np.sqrt(seen_w)
        steps = steps + rate * grad_s / np.sqrt(seen_s)
    return BlockField(w, steps)


# Labelled pages ----------------------------------------------------------------------

_SYLLABLES = "the an or ti en re la von de ou sch ier que ment os ar in ta lo be".split()
_BAD = {
    "menu": ('<nav{c}><ul>{items}</ul></nav>', '<div class="{n}"><ul>{items}</ul></div>', '<ul class="{n}">{items}</ul>'),
    "header": ('<header><div class="logo">{s}</div><p>{m}</p></header>', '<div id="header"><a href="/">{s}</a><p>{m}</p></div>', '<div class="masthead">{s}</div>'),
    "footer": ('<footer>&copy; {s} &middot; {m}</footer>', '<div class="footer"><p>&copy; 2024 {s}. All rights reserved.</p></div>', '<footer><p>{p}</p><ul>{items}</ul></footer>'),
    "side": ('<aside><h3>{s}</h3><ul>{items}</ul></aside>', '<div class="sidebar"><h4>{s}</h4><p>{p}</p></div>', '<div id="related"><h3>{s}</h3>{items_p}</div>', '<aside class="widget"><p>{p}</p></aside>'),
    "notice": ('<div class="cookie-notice"><p>{p}</p><button>{s}</button></div>', '<div id="consent" role="dialog">{m}</div>', '<div class="alert notice">{p}</div>', '<div class="newsletter"><h3>{s}</h3><p>{m}</p></div>'),
    "ad": ('<div class="ad">{m}</div>', '<div class="advertisement"><a href="#">{m}</a></div>', '<div id="sponsored"><p>{p}</p></div>', '<section class="promo"><h3>{s}</h3><p>{p}</p></section>'),
    "form": ('<form><label>{s}</label><input type="text"><button>{s}</button></form>', '<form class="search"><p>{m}</p><button>{s}</button></form>', '<div class="login"><p>{m}</p></div>'),
    "comments": ('<section class="comments"><h3>{s}</h3><div class="comment"><p>{p}</p></div><div class="comment"><p>{p}</p></div></section>', '<div id="comments"><ul><li>{p}</li><li>{p}</li></ul></div>', '<div class="reply"><p>{p}</p></div>'),
    "share": ('<div class="share">{items_p}</div>', '<ul class="social">{items}</ul>'),
}
_FRAMES = (
    "<article>{}</article>", "<main>{}</main>", "<main><article>{}</article></main>", '<div class="content">{}</div>',
    '<div id="main"><div class="post">{}</div></div>', "<section>{}</section>", "<div>{}</div>", "{}",
    '<div class="entry-content">{}</div>', '<article class="story"><section>{}</section></article>',
)


def labelled_pages(n: int = TRAINING_PAGES, seed: int = SEED) -> list[tuple[list[Block], list[int]]]:
    """Pages composed of known parts, as blocks with labels, the same for the same seed.

    Words of main text carry a mark while a page is put together, which gives the labels.
    """
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choices(_SYLLABLES, k=rnd.randint(1, 3)))

    def sentence(low: int, high: int) -> str:
        words = [word() + ("," if rnd.random() < 0.08 else "") for _ in range(rnd.randint(low, high))]
        return " ".join(words).capitalize() + rnd.choice(".....!?")

    def prose(count: int) -> str:
        text = " ".join(sentence(3, 18) for _ in range(count))
        style = rnd.random()
        if style < 0.06:  # rows of a table, shouting, noise, lists of words: odd text is text
            text = text.replace(" ", " | ") + rnd.choice(("", " |"))
        elif style < 0.09:
            text = text.upper().replace(" ", "!! ")
        elif style < 0.12:
            text = " ".join(w + rnd.choice(("###", "%%%", "***")) for w in text.split())
        elif style < 0.16:
            text = " ".join(w.strip(".,!?").lower() for w in text.split())
        return text

    def bad(kind: str) -> str:
        link = lambda: f'<a href="/{word()}">{word().capitalize()}</a>'
        return rnd.choice(_BAD[kind]).format(
            c=rnd.choice(("", ' class="menu"', ' id="nav"')), n=rnd.choice(("menu", "nav", "breadcrumbs", "links")),
            items="".join(f"<li>{link()}</li>" for _ in range(rnd.randint(2, 7))),
            items_p="".join(f"<p>{link()}</p>" for _ in range(rnd.randint(1, 4))),
            s=" ".join(word() for _ in range(rnd.randint(1, 3))).capitalize(), m=sentence(3, 12), p=prose(rnd.randint(1, 4)),
        )

    mark = "\u0002"

    def good() -> str:
        parts = [f"<h1>{mark}{sentence(2, 12)}</h1>"] if rnd.random() < 0.85 else []
        for _ in range(rnd.randint(1, 14)):
            kind = rnd.random()
            if kind < 0.72:
                parts.append(f"<p>{mark}{prose(rnd.choice((1, 1, 2, 4, 8)))}" + rnd.choice(("</p>", "</p>", "")))
            elif kind < 0.78:
                parts.append(f"<p>{mark}{word().capitalize()}.</p>")
            elif kind < 0.84:
                parts.append(f"<h{(k := rnd.randint(2, 4))}>{mark}{sentence(1, 6)}</h{k}>")
            elif kind < 0.88:
                parts.append("<ul>" + "".join(f"<li>{mark}{sentence(2, 14)}</li>" for _ in range(rnd.randint(2, 5))) + "</ul>")
            elif kind < 0.91:
                parts.append(f"<blockquote>{mark}{prose(2)}</blockquote>")
            elif kind < 0.94:
                parts.append("<table>" + "".join(f"<tr><td>{mark}{word()}</td><td>{mark}{word()}</td></tr>" for _ in range(3)) + "</table>")
            elif kind < 0.97:
                parts.append(f'<p><b>{mark}{prose(2)} <a href="#">{word()}</a> {word()}.</b><br>')
            else:
                parts.append(f"<pre>{mark}{prose(1)}</pre>")
            if rnd.random() < 0.05:
                parts.append(bad(rnd.choice(("ad", "share", "form", "notice", "side"))))
        return "".join(parts)

    pages = []
    while len(pages) < n:
        before = [bad(k) for k in ("notice", "header", "menu", "ad", "form") if rnd.random() < 0.5]
        after = [bad(k) for k in ("share", "comments", "side", "ad", "form", "menu") if rnd.random() < 0.35]
        rnd.shuffle(before)
        end = [bad("footer")] if rnd.random() < 0.8 else []
        frame = rnd.choice(_FRAMES)
        inner = bad("comments") if rnd.random() < 0.12 else ""
        text = rnd.choice(("", "", "\n  ")).join(
            ["<html><head><title>x</title></head><body>", *before, frame.format(good() + inner), *after, *end, "</body></html>"]
        )
        blocks = leaf_blocks(text)
        labels = [int(mark in b.text) for b in blocks]
        for b in blocks:
            b.text = b.text.replace(mark, "")
        if blocks:
            pages.append((blocks, labels))
    return pages


def trained_field(n: int = TRAINING_PAGES, seed: int = SEED) -> BlockField:
    return fit_field(labelled_pages(n, seed))


def main_text(page: str, field: BlockField) -> str:
    blocks = leaf_blocks(page)
    return "\n".join(b.text for b, keep in zip(blocks, field.label(blocks)) if keep)


def extract_main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", field: BlockField | None = None
) -> DataFrame:
    """``page_id, url, text, n_chars``: the main text of every whole page.

    The field is trained on the driver (a few hundred short pages) and travels with the
    tasks; pages are read in one pass without a shuffle. A NULL or empty page, and a page
    without main text, gives the empty text. Repeated rows give repeated rows, an empty
    table an empty one; other columns are left out.
    """
    require(pages, id_col, url_col, html_col)
    field = field or once_per_worker(("field", TRAINING_PAGES, SEED), trained_field)
    w, steps = [float(v) for v in field.weights], [[float(v) for v in row] for row in field.steps]

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        local = BlockField(w, steps)
        for whole in batches:
            for batch in parts_of(whole, 200):
                texts = [main_text(p or "", local) for p in batch.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"]
                )

    rows = pages.select(
        quoted(id_col).alias("page_id"), quoted(url_col).cast("string").alias("url"), quoted(html_col).cast("string").alias("html")
    )
    kind = rows.schema["page_id"].dataType.simpleString()
    found = map_batches(rows, extract, f"page_id {kind}, url string, text string")
    return found.withColumn("n_chars", F.length("text").cast("bigint"))
