"""Main text of web pages: boosted trees over DOM nodes, decoded top-down without contradictions.

Each block element of a page is described by its subtree (text, link and item
density, share of the page), its place (depth, siblings, position) and hashed
tokens of its tag and attributes and those of its ancestors.  The trees learn
which elements belong to the article from pages whose markup says so (article or
main elements against menus, footers, adverts and the like), a bounded sample of
``TRAIN_PAGES`` pages taken in hash order.  Every sample page is also shown with
that markup hidden, so the other features have to carry pages that lack it, and
its texts are set again among boilerplate of every named kind.

Decoding chooses for each element to keep or drop it, an element under a dropped
one being dropped, such that the sum of the log-odds, weighted by text, is
largest; one pass up and one down the tree, in linear time.

Rows: null html is empty; a page without kept text gives an empty string; equal
pages give equal texts; without any page to learn from, all block text is kept; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import html
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pumpline.llm import gbt
from pumpline.llm.common import chunks, hash_sample, ready
from pumpline.llm.dom import Page, parse

TRAIN_PAGES = 400
#: Pages longer than this are extracted like any other but not learned from.
TRAIN_CHARS = 200_000
#: Characters of pages that are scored together.
CHARS = 1 << 20

MAIN = frozenset("article main".split())
MAIN_TOKENS = frozenset("role=main role=article itemprop=articlebody".split())
BOILERPLATE = frozenset("nav footer aside form menu dialog search fieldset".split())
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement banner sponsor sponsored promo menu nav navbar navigation breadcrumb breadcrumbs sidebar "
    "footer header masthead cookie cookies consent notice newsletter subscribe popup modal share social related recommended "
    "comment comments reply replies widget login signup search pagination pager toolbar copyright hidden".split())

#: Starts the article texts of composed training pages (a private-use character).
MARKED = "\ue000"

BUCKETS = 48
NUMERIC = 20


@lru_cache(1 << 16)
def _bucket(token: str) -> int:
    return zlib.crc32(token.encode("utf-8", "surrogatepass")) % BUCKETS


@lru_cache(1 << 16)
def _word(token: str) -> str:
    return token.partition("=")[2] or token


class Nodes:
    """The nodes of several pages laid end to end, with sums over subtrees; work goes level by level."""

    def __init__(self, pages: list[Page]):
        self.pages = pages
        sizes = np.array([len(p.nodes) for p in pages], np.int64)
        self.first = np.concatenate(([0], np.cumsum(sizes)))
        n = int(self.first[-1])
        self.page = np.repeat(np.arange(len(pages)), sizes)
        self.parent = np.fromiter((x.parent for p in pages for x in p.nodes), np.int64, n)
        self.parent += self.first[:-1][self.page]
        self.root = np.zeros(n, bool)
        self.root[self.first[:-1]] = True
        self.parent[self.root] = np.flatnonzero(self.root)
        self.depth = np.fromiter((x.depth for p in pages for x in p.nodes), np.int64, n)
        order = np.argsort(self.depth, kind="stable")
        cuts = np.flatnonzero(np.diff(self.depth[order])) + 1
        self.levels = np.split(order, cuts)[1:]  # without the roots
        at = np.fromiter((self.first[k] + t[0] for k, p in enumerate(pages) for t in p.texts), np.int64)
        self.text_node = at
        self.chars = np.fromiter((len(t[1]) for p in pages for t in p.texts), float, len(at))
        self.own = np.bincount(at, self.chars, n)

    def up(self, values: np.ndarray) -> np.ndarray:
        """Sums over subtrees (the node included) of the columns of ``values``."""
        for level in reversed(self.levels):
            np.add.at(values, self.parent[level], values[level])
        return values

    def down(self, values: np.ndarray) -> np.ndarray:
        """The largest value among each node's ancestors (itself left out), by column."""
        out = np.zeros_like(values)
        for level in self.levels:
            p = self.parent[level]
            out[level] = np.maximum(out[p], values[p])
        return out


def features(nodes: Nodes, hide: bool = False) -> np.ndarray:
    """One row for each node.  ``hide``: leave out tag and attribute tokens of article-like and boilerplate markup."""
    n, parent = len(nodes.parent), nodes.parent
    inside = np.fromiter((min(t[2], len(t[1])) for p in nodes.pages for t in p.texts), float, len(nodes.chars))
    stops = np.fromiter((t[1][-1] in ".!?…:;\"'»”。" for p in nodes.pages for t in p.texts), float, len(nodes.chars))
    spaces = np.fromiter((t[1].count(" ") + 1 for p in nodes.pages for t in p.texts), float, len(nodes.chars))
    at = nodes.text_node
    token_row, token_bucket = [], []
    tags = np.zeros((n, 5))  # paragraph, item, boilerplate word, boilerplate tag, article markup
    i = 0
    for page in nodes.pages:
        for node in page.nodes:
            tag, tokens = node.tag, node.tokens
            if tag == "p":
                tags[i, 0] = 1
            elif tag == "li":
                tags[i, 1] = 1
            if hide and (tag in MAIN or tag in BOILERPLATE or tag == "header" or tokens):
                tag, tokens = "div", ()
            token_row.append(i)
            token_bucket.append(_bucket("tag=" + tag))
            if tag in BOILERPLATE or tag == "header":
                tags[i, 3] = 1
            elif tag in MAIN:
                tags[i, 4] = 1
            for t in tokens:
                token_row.append(i)
                token_bucket.append(_bucket(t))
                if _word(t) in BOILERPLATE_WORDS:
                    tags[i, 2] = 1
                elif t in MAIN_TOKENS:
                    tags[i, 4] = 1
            i += 1
    sums = nodes.up(np.column_stack([
        nodes.own, np.bincount(at, inside, n), np.bincount(at, minlength=n), np.bincount(at, stops, n), np.bincount(at, spaces, n),
        tags[:, 0], tags[:, 1], np.ones(n)]))
    chars, linked, blocks, ends, words, paragraphs, items, inner = sums.T
    child = ~nodes.root
    children = np.bincount(parent[child], minlength=n)
    order = np.lexsort((np.arange(n), parent))
    begin = np.concatenate(([True], np.diff(parent[order]) > 0)) if n else np.zeros(0, bool)
    place = np.zeros(n)
    place[order] = np.arange(n) - np.maximum.accumulate(np.where(begin, np.arange(n), 0))
    place[child & nodes.root[parent]] -= 1  # a root counts itself as its first child
    running = np.cumsum(nodes.own) - nodes.own
    before = running - running[nodes.first[:-1]][nodes.page] if n else running
    total = np.maximum(chars[nodes.first[:-1]][nodes.page], 1) if n else chars
    size, many = np.maximum(chars, 1), np.maximum(blocks, 1)
    x = np.zeros((n, NUMERIC + 2 * BUCKETS), np.float32)
    own = x[:, NUMERIC:NUMERIC + BUCKETS]
    own[token_row, token_bucket] = 1
    x[:, NUMERIC + BUCKETS:] = nodes.down(own)
    marks = np.maximum(tags[:, 2:], nodes.down(tags[:, 2:]))
    x[:, :NUMERIC] = np.column_stack([
        np.log1p(chars), np.log1p(nodes.own), linked / size, np.log1p(chars / inner), np.log1p(words / many),
        ends / many, chars / total, np.log1p(paragraphs), np.log1p(items), nodes.depth,
        np.log1p(children), np.log1p(place), place / np.maximum(children[parent] - 1, 1), np.log1p(children[parent]), before / total,
        chars / np.maximum(chars[parent], 1), np.log1p(words), marks])
    return x


def silver(page: Page) -> np.ndarray | None:
    """1 for elements that hold article text by their markup, else 0; None for pages that do not say."""
    n = len(page.nodes)
    state = np.zeros(n)
    for i, node in enumerate(page.nodes):
        state[i] = state[node.parent] if i else 0
        if node.tag in BOILERPLATE or any(_word(t) in BOILERPLATE_WORDS for t in node.tokens) or (node.tag == "header" and state[i] == 0):
            state[i] = -1
        elif state[i] == 0 and (node.tag in MAIN or MAIN_TOKENS & set(node.tokens)):
            state[i] = 1
    if not (state == 1).any():
        return None
    good, every = np.zeros(n), np.zeros(n)
    for node, text, _ in page.texts:
        every[node] += len(text)
        good[node] += len(text) * (state[node] == 1)
    for i in range(n - 1, 0, -1):
        good[page.nodes[i].parent] += good[i]
        every[page.nodes[i].parent] += every[i]
    # an element that holds the article, however little of it is article, has to stay open
    return np.where(every > 0, (good > 0) & (state >= 0), state == 1).astype(float)


def article_texts(page: Page, labels: np.ndarray) -> list[str]:
    return [text for node, text, _ in page.texts if labels[node]]


def compose(r: np.random.Generator, good: list[str], other: list[str]) -> str:
    """A training page of known parts: article blocks (marked) in varied markup among and around boilerplate.

    Boilerplate carries texts as long as the article's, so only markup and place tell them apart.
    """
    words = sorted(BOILERPLATE_WORDS)
    pick = lambda seq: seq[int(r.integers(len(seq)))]

    def filler() -> str:
        name = pick(words)
        tag = pick(["div", "div", "div", "section", "ul", "aside", "nav", "form", "footer", "header"])
        mark = f' {pick(["class", "id"])}="{name}"' if tag in ("div", "section", "ul") or r.random() < 0.3 else ""
        rows = []
        for _ in range(int(r.integers(1, 5))):
            text = html.escape(pick(other)[: int(r.integers(5, 300))])
            rows.append(pick([f"<p>{text}</p>", f'<li><a href="/x">{text[:30]}</a></li>', f"<p>{text}", f"<div>{text}</div>", f"<h3>{text[:40]}</h3>"]))
        return f"<{tag}{mark}>{''.join(rows)}</{tag}>"

    blocks = []
    for text in good:
        text = MARKED + html.escape(text)
        kind = r.random()
        if kind < 0.7:
            blocks.append(f"<p>{text}</p>" if r.random() < 0.7 else f"<p>{text}")
        elif kind < 0.8:
            blocks.append(f"<ul><li>{text}<li>{MARKED}{html.escape(pick(good)[:60])}</ul>")
        elif kind < 0.9:
            blocks.append(f"<h2>{text[:60]}</h2>")
        else:
            blocks.append(pick([f"<blockquote>{text}</blockquote>", f"<div>{text}</div>", f"<table><tr><td>{text}</table>", f"<section><p>{text}</p></section>"]))
    for _ in range(int(r.integers(0, 3))):
        blocks.insert(int(r.integers(len(blocks) + 1)), filler())
    shell = pick(["<article>{}</article>", "<main>{}</main>", '<div class="content">{}</div>', '<div id="post">{}</div>', '<div class="entry">{}</div>',
                  "<main><article>{}</article></main>", "<div>{}</div>", '<div role="main">{}</div>', "{}"])
    around = [filler() for _ in range(int(r.integers(2, 7)))]
    cut = int(r.integers(len(around) + 1))
    head = f"<h1>{MARKED}{html.escape(good[0][:60])}</h1>"
    return "<html><body>" + "".join(around[:cut]) + shell.format(head + "".join(blocks)).replace("{}", "") + "".join(around[cut:]) + "</body></html>"


def marked(page: Page) -> np.ndarray:
    """Labels of a composed page: 1 for elements that hold a marked text."""
    good = np.zeros(len(page.nodes))
    for node, text, _ in page.texts:
        good[node] += text.startswith(MARKED)
    for i in range(len(page.nodes) - 1, 0, -1):
        good[page.nodes[i].parent] += good[i]
    return (good > 0).astype(float)


def train(sources: list[str], seed: int = 5) -> gbt.Trees:
    """Learn from pages whose markup names the article, as they are and with that markup hidden, and
    from pages composed of their texts, one for each."""
    pages, labels, goods = [], [], []
    for source in sources:
        page = parse(source)
        y = silver(page)
        if y is not None:
            pages.append(page)
            labels.append(y)
            good = article_texts(page, y)
            if good:
                goods.append(good)
    if not goods:
        model = gbt.fit(np.zeros((0, NUMERIC + 2 * BUCKETS)), np.zeros(0), np.zeros(0))
        return gbt.Trees(model.edges, model.feature[:0], model.cut[:0], model.value[:0], 1.0)
    r = np.random.default_rng(seed)
    own = [parse(compose(r, good, goods[int(r.integers(len(goods)))])) for good in goods]
    nodes = Nodes(pages)
    x = np.concatenate([features(nodes), features(nodes, hide=True), features(Nodes(own))])
    y = np.concatenate([*labels, *labels, *map(marked, own)])
    return gbt.fit(x, y, 1.0 + 0.25 * x[:, 0])  # long texts matter more


def decode(nodes: Nodes, odds: np.ndarray) -> np.ndarray:
    """Which nodes are kept: the best choice in which everything under a dropped node is dropped."""
    worth = odds * (1.0 + nodes.own)
    both = np.column_stack([worth, -worth])  # best sums of the subtree if the node is kept, if it is dropped
    for level in reversed(nodes.levels):
        gain = np.column_stack([both[level].max(axis=1), both[level, 1]])
        np.add.at(both, nodes.parent[level], gain)
    out = nodes.root.copy()
    for level in nodes.levels:
        out[level] = out[nodes.parent[level]] & (both[level, 0] >= both[level, 1])
    return out


def extract(model: gbt.Trees, sources: list[str]) -> list[str]:
    out = []
    for part in chunks(sources, len, CHARS):
        pages = [parse(source) for source in part]
        nodes = Nodes(pages)
        kept = decode(nodes, np.clip(model.score(features(nodes)), -8, 8))
        for k, page in enumerate(pages):
            out.append(" ".join(text for node, text, _ in page.texts if kept[nodes.first[k] + node]))
    return out


def fit(spark: SparkSession, pages: DataFrame) -> gbt.Trees:
    ready(spark)
    src = pages.select(F.col("html").cast("string").alias("html")).where(F.length("html") <= TRAIN_CHARS)
    return train([r["html"] for r in hash_sample(src, "html", TRAIN_PAGES).collect()])


def digest(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Contract columns: page_id, url, text, n_chars."""
    model = spark.sparkContext.broadcast(fit(spark, pages))

    @F.pandas_udf("string")
    def main_text(pages: pd.Series) -> pd.Series:
        return pd.Series(extract(model.value, [t if isinstance(t, str) else "" for t in pages]))

    return (pages.select("page_id", "url", main_text(F.col("html").cast("string")).alias("text"))
            .select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars")))
