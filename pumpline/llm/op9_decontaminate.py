"""Benchmark decontamination by latent semantic retrieval.

1. The terms are the benchmark's words.  Their document frequencies over all
   short passages (tiles) of all documents give the inverse document frequencies;
   words outside the benchmark weigh as much as the rarest term and count in the
   passages' lengths only.  Terms in more than ``MAX_SHARE`` of the tiles are stop
   words, except in items that consist of little else.
2. One distributed pass multiplies the Gram matrix of the TF-IDF matrix of all
   tiles of all documents with a random test matrix (each task sums its own
   product, Spark adds them up).  The benchmark's items are rows of that matrix
   too, weighted up.  The Nystroem form of the randomised SVD gives the leading
   right singular vectors, the latent space.
3. Every window of two tiles of every document is projected; windows with a cosine
   of ``min_cosine`` to an item are candidates.  A window whose benchmark words
   carry too little of its length cannot reach that and is not projected.  Other
   words in a window lower its cosine, the more the larger the corpus; so windows
   that hold ``MIN_COVER`` of the weight of an item's piece (at most a tile of
   words, which some window holds whole) are candidates as well, whatever else is
   in them.  These sums are exact, over postings of the pieces' terms.  The
   benchmark is the query set: it is handled in blocks of ``BLOCK`` items, each a
   pass over the documents with a bounded broadcast.
4. A candidate counts if the longest common subsequence of the item's words and
   the words around the window covers ``min_lcs`` of the item, and if half the
   item's answer (what follows the last question mark, else the last words) is
   found there in order too.  Items that are found almost whole need no answer.

Rows: null or wordless texts match nothing, as do items without words; equal
items are reported each; an empty benchmark or empty table gives no hits; extra
columns are ignored (or carried, where documents are returned).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pumpline.llm.common import chunks, names, ready
from pumpline.llm.tokens import word_hashes

#: Words of a tile; a window is two neighbouring tiles.
TILE = 16

#: Items compared in one pass, latent dimensions, energy of the items' rows against all tiles.
BLOCK = 256
DIMS = 256
OWN_ENERGY = 16.0

#: Share of the tiles above which a term is a stop word; items with fewer other terms keep all of theirs.
MAX_SHARE = 0.01
FEW_TERMS = 4

#: Words, tiles and bytes handled at once, which bounds a task's arrays.
WORDS = 1 << 12
TILES = 1 << 14
BYTES = 1 << 20

#: Terms up to which a task keeps the terms' whole matrix (4 bytes an entry).
DENSE_TERMS = 8192

MIN_COSINE = 0.35
MIN_COVER = 0.5
MIN_LCS = 0.7
SURE_LCS = 0.9
ANSWER_WORDS = 5


@dataclass(frozen=True)
class Terms:
    """The benchmark's word hashes in order, and a first test by their upper 16 bits."""

    hashes: np.ndarray
    maybe: np.ndarray

    @staticmethod
    def of(hashes: np.ndarray) -> Terms:
        own = np.unique(hashes)
        maybe = np.zeros(1 << 16, bool)
        maybe[(own >> np.uint64(48)).astype(np.int64)] = True
        return Terms(own, maybe)

    def columns(self, h: np.ndarray) -> np.ndarray:
        """Term number of each word, -1 for words outside the benchmark."""
        out = np.full(len(h), -1, np.int64)
        at = np.flatnonzero(self.maybe[(h >> np.uint64(48)).astype(np.int64)])
        k = np.searchsorted(self.hashes, h[at])
        k[k == len(self.hashes)] = 0
        same = self.hashes[k] == h[at]
        out[at[same]] = k[same]
        return out


def tile_starts(n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word of every tile of every text, laid end to end, and each tile's text."""
    n_tiles = -(-n_words // TILE)
    text = np.repeat(np.arange(len(n_words)), n_tiles)
    first = np.concatenate(([0], np.cumsum(n_words)[:-1])) if len(n_words) else n_words
    within = np.arange(len(text)) - np.repeat(np.concatenate(([0], np.cumsum(n_tiles)[:-1])) if len(n_tiles) else n_tiles, n_tiles)
    return first[text] + within * TILE, text


def _texts(b: pa.RecordBatch) -> Iterator[list[bytes]]:
    yield from chunks((t for t in b.column(0).to_pylist() if t), len, BYTES)


def tile_frequencies(docs: DataFrame, terms: Terms) -> tuple[np.ndarray, int]:
    """Tiles that hold each term, over all documents, and the number of tiles."""
    m = len(terms.hashes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(m, np.int64), 0
        for b in batches:
            for texts in _texts(b):
                h, n_words = word_hashes(texts)
                starts, _ = tile_starts(n_words)
                n += len(starts)
                col = terms.columns(h)
                inside = np.flatnonzero(col >= 0)
                tile = np.searchsorted(starts, inside, side="right") - 1
                df += np.bincount(np.unique(tile * m + col[inside]) % m, minlength=m)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(df[at], n))], ["term", "n"])

    rows = docs.mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()  # m + 1 rows at most
    out, n = np.zeros(m), 0
    for t, c in zip(rows["term"], rows["n"]):
        if t < 0:
            n = int(c)
        else:
            out[t] = c
    return out, n


@dataclass(frozen=True)
class Pieces:
    """Postings of the items' pieces by term: piece and share of its weight; ``first`` is where a term's postings start."""

    first: np.ndarray
    piece: np.ndarray
    share: np.ndarray
    item: np.ndarray  # of each piece

    @staticmethod
    def of(terms: Terms, weight: np.ndarray, bench: list[bytes]) -> Pieces:
        term, piece, share, item = [], [], [], []
        for j, text in enumerate(bench):
            col = terms.columns(word_hashes([text])[0])
            for part in np.array_split(col, -(-len(col) // TILE)):
                c, n = np.unique(part[weight[part] > 0], return_counts=True)
                energy = n.astype(float) ** 2 * weight[c].astype(float) ** 2
                if len(c):
                    term.append(c)
                    piece.append(np.full(len(c), len(item)))
                    share.append(energy / energy.sum() / n)  # a word counts as often as it stands in the window
                    item.append(j)
        t = np.concatenate(term) if term else np.zeros(0, np.int64)
        by = np.argsort(t, kind="stable")
        joined = [np.concatenate(x)[by] if x else np.zeros(0, kind) for x, kind in ((piece, np.int64), (share, float))]
        return Pieces(np.searchsorted(t[by], np.arange(len(weight) + 1)), *joined, np.array(item, np.int64))

    def covered(self, col: np.ndarray, starts: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first tile, item) of the windows that hold ``MIN_COVER`` of a piece."""
        out, n = [], max(len(self.item), 1)
        ends = np.append(starts[1:], len(col))
        for lo in range(0, len(starts), TILES):
            hi = min(lo + TILES, len(starts))
            own = slice(lo, min(hi + 1, len(starts)))  # the last window's second tile
            words = np.arange(starts[lo], ends[own.stop - 1])
            words = words[col[words] >= 0]
            count = self.first[col[words] + 1] - self.first[col[words]]
            words, count = words[count > 0], count[count > 0]
            tile = np.repeat(np.searchsorted(starts, words, side="right") - 1, count)
            at = np.repeat(self.first[col[words]] - np.cumsum(count) + count, count) + np.arange(count.sum())
            before = np.flatnonzero((tile > lo) & pair[tile - 1])
            window = np.concatenate((tile, tile[before] - 1))
            at = np.concatenate((at, at[before]))
            inside = window < hi
            key, at = window[inside] * n + self.piece[at[inside]], at[inside]
            order = np.argsort(key, kind="stable")
            key = key[order]
            first = np.flatnonzero(np.diff(key, prepend=-1))
            if len(first):
                key = key[first][np.add.reduceat(self.share[at[order]], first) >= MIN_COVER]
                out.append(np.unique(np.stack((key // n, self.item[key % n])), axis=1))
        both = np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.int64)
        return both[0], both[1]


@dataclass(frozen=True)
class Space:
    """Terms, their weights (0: stop words), the weight of all other words, and the basis (terms x dimensions)."""

    terms: Terms
    weight: np.ndarray
    other: float
    basis: np.ndarray

    def lengths(self, col: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared length of each tile, and the part of it that the terms carry."""
        w = np.where(col >= 0, self.weight[col], self.other)
        full = np.add.reduceat(w * w, starts)
        return full, np.add.reduceat(np.where(col >= 0, w * w, 0), starts)

    def project(self, col: np.ndarray, starts: np.ndarray, want: np.ndarray | None = None) -> np.ndarray:
        """Latent vectors of the tiles, or of those in ``want`` only, ``WORDS`` words at a time."""
        inside = (col >= 0) & (self.weight[col] > 0)
        if want is not None:
            inside &= np.repeat(want, np.diff(np.append(starts, len(col))))
        inside = np.flatnonzero(inside)
        tile = np.searchsorted(starts, inside, side="right") - 1
        if want is not None:
            tile = (np.cumsum(want) - 1)[tile]
        out = np.zeros((len(starts) if want is None else int(want.sum()), self.basis.shape[1]), np.float32)
        for lo in range(0, len(inside), WORDS):
            c, t = col[inside[lo:lo + WORDS]], tile[lo:lo + WORDS]
            first = np.flatnonzero(np.diff(t, prepend=-1))
            out[t[first]] += np.add.reduceat(self.basis[c] * self.weight[c, None], first, axis=0)
        return out

    def windows(self, texts: list[bytes], least: float, pieces: Pieces):
        """Windows whose cosine to some item may reach ``least`` or that hold much of a piece.

        Unit-scaled vectors, first word, text; hashes, words per text; (window, item) of the held pieces.
        """
        h, n_words = word_hashes(texts)
        starts, text = tile_starts(n_words)
        none = np.zeros(0, np.int64)
        if not len(starts):
            return np.zeros((0, self.basis.shape[1]), np.float32), none, none, h, n_words, (none, none)
        col = self.terms.columns(h)
        full, own = self.lengths(col, starts)
        pair = np.append(text[1:] == text[:-1], False)  # the last tile of a text is a window of its own
        nxt = np.append(np.arange(1, len(starts)), 0)
        full, own = full + np.where(pair, full[nxt], 0), own + np.where(pair, own[nxt], 0)
        held, item = pieces.covered(col, starts, pair)
        use = (own > 0) & (own >= least * least * full * 0.999)
        use[held] = True
        at = np.flatnonzero(use)
        want = np.zeros(len(starts), bool)
        want[at] = True
        want[nxt[at[pair[at]]]] = True
        v, row = self.project(col, starts, want), np.cumsum(want) - 1
        out = v[row[at]] + np.where(pair[at, None], v[row[nxt[at]]], 0)
        return out / np.sqrt(np.maximum(full[at], 1e-12))[:, None], starts[at], text[at], h, n_words, (np.searchsorted(at, held), item)


def together(space: Space, h: np.ndarray, starts: np.ndarray, into: np.ndarray) -> None:
    """Adds to one half of the terms' matrix (flat) what the terms of each tile have in common: 1 / squared length for each pair of places."""
    col = space.terms.columns(h)
    full, _ = space.lengths(col, starts)
    share = (1.0 / np.maximum(full, 1e-12)).astype(np.float32)
    inside = np.flatnonzero((col >= 0) & (space.weight[col] > 0))
    tile, c = np.searchsorted(starts, inside, side="right") - 1, col[inside]
    part, m = share[tile], len(space.weight)
    np.add.at(into, c * (m + 1), part / 2)  # a place with itself: the other half adds as much
    for d in range(1, TILE):
        at = np.flatnonzero(tile[d:] == tile[:-d]) if len(tile) > d else tile[:0]
        if not len(at):
            break
        np.add.at(into, c[at] * m + c[at + d], part[at])


def singular_vectors(docs: DataFrame, space: Space, bench: list[bytes], n_tiles: int, dims: int = DIMS, seed: int = 7) -> np.ndarray:
    """Leading right singular vectors (terms x dims) of all tiles and of the items' rows."""
    m = len(space.weight)
    dims = min(dims, m)
    omega = np.linalg.qr(np.random.default_rng(seed).standard_normal((m, dims)))[0].astype(np.float32)
    probe = Space(space.terms, space.weight, space.other, omega)

    def product(h: np.ndarray, starts: np.ndarray, into: np.ndarray) -> None:
        if not len(starts):
            return
        col = space.terms.columns(h)
        full, _ = space.lengths(col, starts)
        y = probe.project(col, starts) / np.maximum(full, 1e-12)[:, None]  # both factors of the Gram matrix have unit rows
        inside = np.flatnonzero((col >= 0) & (space.weight[col] > 0))
        inside = inside[np.argsort(col[inside], kind="stable")]
        tile = np.searchsorted(starts, inside, side="right") - 1
        for lo in range(0, len(inside), WORDS):
            c, t = col[inside[lo:lo + WORDS]], tile[lo:lo + WORDS]
            first = np.flatnonzero(np.diff(c, prepend=-1))
            into[c[first]] += np.add.reduceat(y[t] * space.weight[c, None], first, axis=0)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for b in batches:
            for texts in _texts(b):
                h, n_words = word_hashes(texts)
                starts = tile_starts(n_words)[0]
                for lo in range(0, len(starts), TILES):  # a very long text is many steps
                    s = starts[lo:lo + TILES]
                    end = starts[lo + TILES] if lo + TILES < len(starts) else len(h)
                    yield h[s[0]:end], s - s[0]

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if m <= DENSE_TERMS:
            # the task's own Gram matrix takes a few additions a word; it meets the test matrix once
            gram = np.zeros(m * m, np.float32)
            for h, starts in pieces(batches):
                together(space, h, starts, gram)
            gram = gram.reshape(m, m)
            gram += gram.T.copy()
            gram *= space.weight[:, None]
            gram *= space.weight
            z = gram @ omega
        else:
            z = np.zeros((m, dims), np.float32)
            for h, starts in pieces(batches):
                product(h, starts, z)
        used = np.flatnonzero(np.abs(z).sum(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used), *[pa.array(z[used, j]) for j in range(dims)]],
                                         ["term", *[f"z{j}" for j in range(dims)]])

    schema = "term long, " + ", ".join(f"z{j} float" for j in range(dims))
    rows = docs.mapInArrow(sketch, schema).groupBy("term").agg(*[F.sum(f"z{j}").alias(f"z{j}") for j in range(dims)]).toPandas()
    z = np.zeros((m, dims))
    z[rows["term"].to_numpy(np.int64)] = rows.drop(columns="term").to_numpy(np.float64)
    own = np.zeros((m, dims))
    for text in bench:  # an item is one row, whatever its length
        h, _ = word_hashes([text])
        product(h, np.zeros(1, np.int64), own)
    z += own * (OWN_ENERGY * max(n_tiles, 1) / max(len(bench), 1))
    # Nystroem form: Gram matrix ~ z (omega' z)^-1 z', shifted to be safely positive
    small = omega.T.astype(float) @ z
    shift = 1e-7 * max(float(np.trace(small)), 1e-12) / dims
    z, small = z + shift * omega, small + shift * np.eye(dims)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    good = values > values.max() * 1e-9
    half = z @ (vectors[:, good] / np.sqrt(values[good]))
    u, _, _ = np.linalg.svd(half, full_matrices=False)
    return u.astype(np.float32)


def lcs(masks: dict[int, int], n: int, words) -> int:
    """Length of the longest common subsequence (bit-parallel) of an item of ``n`` words and ``words``."""
    full = (1 << n) - 1
    v = full
    for w in words:
        u = v & masks.get(w, 0)
        v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def _masks(words: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << i
    return out


@dataclass(frozen=True)
class Item:
    item_id: object
    masks: dict[int, int]
    n: int
    answer: dict[int, int]
    n_answer: int


def _item(item_id: object, text: bytes) -> Item:
    words = word_hashes([text])[0].tolist()
    tail = text.rpartition(b"?")[2] if b"?" in text else b""
    answer = word_hashes([tail])[0].tolist() or words[-ANSWER_WORDS:]
    return Item(item_id, _masks(words), len(words), _masks(answer), len(answer))


@dataclass(frozen=True)
class Index:
    """One block of the benchmark: its items and their latent window vectors."""

    space: Space
    items: list[Item]
    vectors: np.ndarray
    pieces: Pieces
    min_cosine: float
    min_lcs: float

    def hits(self, texts: list[bytes | None]) -> list[list[tuple[object, float, float]]]:
        """For each text the items it holds: (item_id, share of the item in order, cosine)."""
        out: list[list] = [[] for _ in texts]
        use = [i for i, t in enumerate(texts) if t]
        for part in chunks(use, lambda i: len(texts[i]), BYTES):
            v, starts, text, h, n_words, (held, held_item) = self.space.windows([texts[i] for i in part], self.min_cosine, self.pieces)
            first = np.concatenate(([0], np.cumsum(n_words)))
            step = 4096
            found: dict[tuple[int, int], list[tuple[int, float]]] = {}
            for lo in range(0, len(v), step):
                cos = v[lo:lo + step] @ self.vectors.T
                near = cos >= self.min_cosine
                own = (held >= lo) & (held < lo + step)
                near[held[own] - lo, held_item[own]] = True
                for k, j in zip(*np.nonzero(near)):
                    found.setdefault((int(text[lo + k]), int(j)), []).append((int(starts[lo + k]), float(cos[k, j])))
            for (i, j), places in found.items():
                item, best = self.items[j], (0.0, 0.0)
                done = -1
                for start, cosine in sorted(places):
                    lo = max(int(first[i]), start - item.n)
                    hi = min(int(first[i + 1]), start + 2 * TILE + item.n)
                    if hi <= done:
                        continue
                    done = hi
                    region = h[lo:hi].tolist()
                    share = self._share(item, region)
                    best = max(best, (share, cosine))
                if best[0] >= self.min_lcs:
                    out[part[i]].append((item.item_id, best[0], best[1]))
        return out

    def _share(self, item: Item, region: list[int]) -> float:
        """Share of the item found in order in ``region``; 0 if the words or the answer fail."""
        need = math.ceil(self.min_lcs * item.n)
        if sum(item.masks.get(w) is not None for w in region) < need:
            return 0.0
        # a stretch of the region half as long again as the item: chance words of a long region do not add up
        span, best = item.n + item.n // 2, 0.0
        for lo in range(0, max(1, len(region) - span // 2), max(1, item.n // 4)):
            words = region[lo:lo + span]
            n = lcs(item.masks, item.n, words)
            if n >= need and (n >= SURE_LCS * item.n or 2 * lcs(item.answer, item.n_answer, words) >= item.n_answer):
                best = max(best, n / item.n)
                if best == 1.0:
                    break
        return best


def _binary(df: DataFrame) -> DataFrame:
    return df.select(F.col("text").cast("string").cast("binary").alias("text"))


def indexes(spark: SparkSession, docs: DataFrame, bench: DataFrame, min_cosine: float = MIN_COSINE,
            min_lcs: float = MIN_LCS) -> list[Index]:
    """One index for each block of benchmark items; term statistics and vectors come from all documents."""
    items = bench.select("item_id", F.col("text").cast("string").cast("binary").alias("text")).where("text is not null")
    n = items.count()
    if not n:
        return []
    blocks = -(-n // BLOCK)
    texts = _binary(docs).where("text is not null")
    out = []
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect() if blocks > 1 else items.collect()
        rows = [(r["item_id"], bytes(r["text"])) for r in part if len(word_hashes([bytes(r["text"])])[0])]
        if not rows:
            continue
        raw = [t for _, t in rows]
        terms = Terms.of(word_hashes(raw)[0])
        df, n_tiles = tile_frequencies(texts, terms)
        space = weighted(terms, df, n_tiles, raw)
        space = Space(terms, space.weight, space.other, singular_vectors(texts, space, raw, n_tiles))
        vectors = np.concatenate([space.project(terms.columns(word_hashes([t])[0]), np.zeros(1, np.int64)) for t in raw])
        lengths = np.array([space.lengths(terms.columns(word_hashes([t])[0]), np.zeros(1, np.int64))[0][0] for t in raw])
        vectors = (vectors / np.sqrt(np.maximum(lengths, 1e-12))[:, None]).astype(np.float32)
        out.append(Index(space, [_item(i, t) for i, t in rows], vectors, Pieces.of(terms, space.weight, raw), min_cosine, min_lcs))
    return out


def weighted(terms: Terms, df: np.ndarray, n_tiles: int, bench: list[bytes]) -> Space:
    """Term weights without a basis yet."""
    weight = np.log((n_tiles + 2.0) / (df + 1.0))
    common = df > MAX_SHARE * n_tiles
    for text in bench:
        own = np.unique(terms.columns(word_hashes([text])[0]))
        if (~common[own]).sum() < min(FEW_TERMS, len(own)):
            common[own] = False
    weight[common] = 0.0
    return Space(terms, weight.astype(np.float32), float(np.log(n_tiles + 2.0)), np.zeros((len(df), 0), np.float32))


def matcher(spark: SparkSession, index: Index, item_type: str):
    """Column function: array<struct<item_id, lcs, cosine>> of a whole text."""
    shared = spark.sparkContext.broadcast(index)

    @F.pandas_udf(f"array<struct<item_id:{item_type},lcs:double,cosine:double>>")
    def hits(text: pd.Series) -> pd.Series:
        found = shared.value.hits([bytes(t) if t is not None else None for t in text])
        return pd.Series([[{"item_id": a, "lcs": b, "cosine": c} for a, b, c in x] for x in found])

    return hits


def contamination(spark: SparkSession, docs: DataFrame, bench: DataFrame, **options) -> list:
    """Column functions, one for each block of the benchmark."""
    ready(spark)
    kind = bench.schema["item_id"].dataType.simpleString()
    return [matcher(spark, i, kind) for i in indexes(spark, docs, bench, **options)]


def digest(spark: SparkSession, docs: DataFrame, bench: DataFrame) -> DataFrame:
    """(doc_id, item_id, lcs, cosine): the benchmark items that a document holds; clean documents give no rows."""
    found = None
    kind = bench.schema["item_id"].dataType.simpleString()
    for hits in contamination(spark, docs, bench):
        own = docs.select("doc_id", F.explode(hits(F.col("text").cast("string").cast("binary"))).alias("m")).select("doc_id", "m.*")
        found = own if found is None else found.unionByName(own)
    if found is None:
        return docs.select("doc_id", F.lit(None).cast(kind).alias("item_id"), F.lit(0.0).alias("lcs"), F.lit(0.0).alias("cosine")).where("false")
    return found


def drop_contaminated(spark: SparkSession, docs: DataFrame, bench: DataFrame) -> DataFrame:
    """Documents that hold no benchmark item; the columns of ``docs``."""
    out = docs
    for hits in contamination(spark, docs, bench):
        out = out.where(F.size(hits(F.col("text").cast("string").cast("binary"))) == 0)
    return out.select(*names(docs))
