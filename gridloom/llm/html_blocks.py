"""Leaf blocks of a page: runs of text between block tags, with what encloses them."""

from __future__ import annotations

import html
import re
from collections import defaultdict
from dataclasses import dataclass

_TAG = re.compile(r"</?([A-Za-z][^\s/>]*+)")
# On to what follows the next equals sign, a quote or a value without quotes, or to the end of the tag.
_ATTRIBUTE = re.compile(r"""[^=>]*+(?:=\s*+(?:(["'])|[^\s>]*+)|>)""")
_NAMES = re.compile(r"""(?:class|id|role|itemprop|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_HIDDEN = re.compile(r"""display\s*:\s*none|(?:^|\s)hidden(?:[\s=]|$)|aria-hidden\s*=\s*["']?true""", re.I)
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_SPACE = re.compile(r"\s+")

SKIPPED = frozenset("script style noscript template svg math iframe object textarea select title head".split())
_RAW = frozenset("script style textarea title noscript iframe".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
# Tags that an opening tag of the same kind closes if they are still open.
_CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",),
}
# What an ancestor can say, by its tag ...
TAG_SIGNS = (
    "nav header footer aside article main section form ul ol li table blockquote figure figcaption button p pre dl "
    "address dialog h1 h2 h3 h4 h5 h6 div td details body menu a"
).split()
# ... or by the words of its class, id and role.
WORD_SIGNS = {
    "w_nav": "nav navbar navigation menu breadcrumb breadcrumbs tabs pagination pager toc links",
    "w_ad": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner",
    "w_comment": "comment comments reply replies discussion disqus respond thread reader",
    "w_side": "sidebar side aside related recommended recommend widget rail trending popular more also",
    "w_foot": "footer foot bottom copyright colophon legal contentinfo",
    "w_head": "header masthead topbar logo branding top",
    "w_notice": "cookie cookies consent notice gdpr alert popup modal overlay newsletter subscribe signup subscription banner privacy paywall",
    "w_share": "share sharing social follow likes",
    "w_form": "form search login register input contact",
    "w_body": "content article post entry story body main text page prose",
    "w_meta": "meta byline author date tags tag category",
}
_BIT = {name: 1 << i for i, name in enumerate([*TAG_SIGNS, *WORD_SIGNS, "hidden"])}
_BY_WORD: dict[str, int] = {}
for _sign, _terms in WORD_SIGNS.items():
    for _term in _terms.split():
        _BY_WORD[_term] = _BY_WORD.get(_term, 0) | _BIT[_sign]
SIGNS = list(_BIT)


@dataclass
class Block:
    text: str
    signs: int  # bits of SIGNS over all ancestors
    parent: int  # bits of the nearest block element alone
    linked: int  # characters inside links


def signs_of(tag: str, attributes: str) -> int:
    bits = _BIT.get(tag, 0)
    if attributes and "=" in attributes or "hidden" in attributes:
        for value in _NAMES.findall(attributes):
            for word in _WORD.findall(_CAMEL.sub(" ", value).lower()):
                bits |= _BY_WORD.get(word, 0)
        if _HIDDEN.search(attributes):
            bits |= _BIT["hidden"]
    return bits


def tag_end(page: str, at: int, endless: set[int]) -> int:
    """Where the tag ends whose attributes begin at ``at``, just behind its bracket; -1 if the page breaks off in it.

    A quote behind an equals sign holds all up to the next one like it, however far, brackets
    included. If the page ends before such a tag does, the tag ends at its first bracket.
    ``endless`` remembers quotes from which no end was found, so a page is read a bounded
    number of times whatever it holds.
    """
    i, passed = at, []
    while (step := _ATTRIBUTE.match(page, i)) is not None:
        i = step.end()
        if step[1]:
            passed.append(i)
            i = 0 if i in endless else page.find(step[1], i) + 1
            if not i:
                break
        elif page[i - 1] == ">":
            return i
    endless.update(passed)
    return page.find(">", at) + 1 or -1


def leaf_blocks(page: str) -> list[Block]:
    """Blocks with text in page order. Scripts, styles, comments and markup are left out."""
    blocks: list[Block] = []
    # Open elements: tag, signs of all up to it, signs of itself, whether its text is skipped.
    stack: list[tuple[str, int, int, bool]] = [("", 0, 0, False)]
    # Where the open elements of each tag, and those that are blocks, stand in the stack.
    places: defaultdict[str, list[int]] = defaultdict(list)
    block_at = [0]
    parts: list[str] = []
    linked = links = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
            parts.clear()
            if text:
                blocks.append(Block(text, stack[-1][1], stack[block_at[-1]][2], linked))
            linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text and not stack[-1][3]:
            parts.append(text)
            if links:
                linked += len(text.strip())

    def pop_to(depth: int) -> None:
        nonlocal links
        while len(stack) > depth:
            tag = stack.pop()[0]
            links -= tag == "a"
            places[tag].pop()
            if block_at[-1] == len(stack):
                block_at.pop()

    at, size = 0, len(page)
    endless: set[int] = set()
    while at < size:
        mark = page.find("<", at)
        if mark < 0:
            add(page[at:])
            break
        add(page[at:mark])
        if page.startswith("<!--", mark):
            end = page.find("-->", mark + 4)
            at = size if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), mark):
            end = page.find(">", mark)
            at = size if end < 0 else end + 1
            continue
        tag = _TAG.match(page, mark)
        end = tag_end(page, tag.end(), endless) if tag else -1
        if tag is None or end < 0:
            if mark + 1 < size and (page[mark + 1].isalpha() or page[mark + 1] == "/"):
                at = size  # a tag that the page breaks off in
            else:
                add("<")
                at = mark + 1
            continue
        at = end
        name = tag[1].lower()
        if page[mark + 1] == "/":
            depth = places[name][-1] if places[name] else 0
            if name not in INLINE:
                flush()
            if depth and (name not in INLINE or block_at[-1] < depth):
                pop_to(depth)
            continue
        attributes = page[tag.end() : end - 1]
        if name == "br":
            add(" ")
            continue
        if name in _VOID:
            if name not in INLINE:
                flush()
            continue
        if name in _RAW:
            end = re.compile(f"</{re.escape(name)}\\s*>", re.I).search(page, at)
            at = size if end is None else end.end()
            continue
        if name not in INLINE:
            flush()
            # An open paragraph, with what is open inside it, ends where a block begins.
            depth = block_at[-1]
            if depth and (stack[depth][0] == "p" or stack[depth][0] in _CLOSES.get(name, ())):
                pop_to(depth)
            block_at.append(len(stack))
        own = signs_of(name, attributes)
        places[name].append(len(stack))
        stack.append((name, stack[-1][1] | own, own, stack[-1][3] or name in SKIPPED))
        links += name == "a"
    flush()
    return blocks
