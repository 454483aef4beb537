"""A small tolerant HTML reader: block elements with their texts, in linear time.

Block elements become nodes; inline elements add their text to the block around
them.  Scripts, styles, templates, form controls, the head's contents and
comments never give text.  Missing end tags are closed the usual way (a block
closes an open paragraph, an item closes the one before); a link that is left open
ends with the block it is in; a tag that the page's end cuts off is dropped.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

BLOCKS = frozenset(
    "html body article section main nav aside header footer div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th "
    "caption blockquote pre figure figcaption form fieldset address details summary dialog center hgroup search menu".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math object select button option".split())
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
#: An element that ends what may be closed by SAME.
LIST = frozenset("ul ol menu dl table".split())

#: An attribute: its name, then ``=`` and a quoted value, or one that ends at white space (a quote in it is like any character).
NAMED = r"[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+))?+"
MARKUP = r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)({attributes})(>|\Z)"
TOKEN = re.compile(MARKUP.format(attributes=rf"(?:[\s/]++|{NAMED})*+"), re.S)
#: For the rest of a page in which a quoted value takes a tag up to the page's end.
LOOSE = re.compile(MARKUP.format(attributes="[^>]*+"), re.S)
ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]*+)))?+")
TELLING = frozenset("class id role itemprop hidden aria-hidden".split())
SPACE = re.compile(r"\s+")


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    tokens: tuple[str, ...]
    texts: list[int] = field(default_factory=list)


@dataclass
class Page:
    """``nodes`` in document order; ``texts``: (node, block text, characters inside links) in page order."""

    nodes: list[Node]
    texts: list[tuple[int, str, int]]


def attribute_tokens(raw: str) -> tuple[str, ...]:
    out = []
    for m in ATTRIBUTE.finditer(raw):
        value = m[2] or m[3] or m[4] or ""
        name = m[1].lower()
        if name not in TELLING:
            continue
        out += [f"{name}={t}" for t in re.split(r"[^a-z0-9]+", value.lower()) if t] or [name]
    return tuple(out)


def parse(source: str) -> Page:
    nodes = [Node("root", -1, 0, ())]
    texts: list[tuple[int, str, int]] = []
    stack, open_count = [0], {"root": 1}
    link, parts, linked = -1, [], 0  # link: the block in which a link is open
    token = TOKEN

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = SPACE.sub(" ", html.unescape("".join(parts))).strip()
            if text:
                nodes[stack[-1]].texts.append(len(texts))
                texts.append((stack[-1], text, linked))
            parts, linked = [], 0

    def close(tag: str) -> None:
        nonlocal link
        flush()
        while True:
            at = stack.pop()
            n = nodes[at]
            if at == link:
                link = -1
            open_count[n.tag] -= 1
            if n.tag == tag:
                return

    at, end = 0, len(source)
    while at < end:
        m = token.search(source, at)
        if m and m[2] and not m[4] and token is TOKEN and ">" in m[0]:
            token = LOOSE
            continue
        stop = m.start() if m else end
        if stop > at:
            piece = source[at:stop]
            parts.append(piece)
            if link >= 0:
                linked += len(piece.strip())
        if not m:
            break
        at = m.end()
        tag = m[2]
        if not tag or not m[4]:
            continue
        tag = tag.lower()
        closing = bool(m[1])
        if tag in RAW:
            if not closing and not m[3].endswith("/"):
                e = _END[tag].search(source, at)
                at = e.end() if e else (at if tag in ("svg", "math", "object", "button", "select", "option", "noscript") else end)
            parts.append(" ")
        elif tag in BLOCKS:
            if closing:
                if open_count.get(tag):
                    close(tag)
                else:
                    flush()
                continue
            flush()
            if open_count.get("p"):
                close("p")
            for same in SAME.get(tag, ()):
                for k in range(len(stack) - 1, 0, -1):
                    if nodes[stack[k]].tag in LIST:
                        break
                    if nodes[stack[k]].tag == same:
                        close(same)
                        break
            nodes.append(Node(tag, stack[-1], nodes[stack[-1]].depth + 1, attribute_tokens(m[3])))
            stack.append(len(nodes) - 1)
            open_count[tag] = open_count.get(tag, 0) + 1
        elif tag == "a":
            link = -1 if closing else stack[-1]
        elif tag in VOID:
            parts.append(" ")
            if tag == "hr":
                flush()
    flush()
    return Page(nodes, texts)


_END = {t: re.compile(rf"</{t}\b[^>]*(?:>|\Z)", re.I) for t in RAW}
