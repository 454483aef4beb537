"""Language-model scores from a subword lattice: all segmentations of every word.

The pieces and their order come from an existing public vocabulary (a
sentencepiece model; its path is a parameter).  Its stored scores are merge
ranks, so the start weights fall with the rank (Zipf); one expectation step over
all training words, weighted by their counts, turns them into unigram
probabilities of this corpus.  A word's probability is the sum over all ways to
cut it into pieces, by forward recursion in log space; characters outside the
vocabulary go through its byte pieces, so every word has a probability.  A text's
score is the sum over its words plus the end piece, in log10.

Words are counted in Spark and each distinct word is scored once.  The ``HOT``
most frequent words (a fixed number) are broadcast and summed where the text is
read; all other words of a text are joined to the scored word table, so the
table itself is never held by one task.

Rows: null text counts as empty (one end token); null ids are hashed as the empty
text; equal rows give equal scores; without training rows the counts are zero
and the start weights score; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, LongType, StructField, StructType

from pumpline.llm.common import crc_mod, ready, save

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
START = "▁"  # marks the begin of a word in the vocabulary

HOT = 50_000
FLUSH = 200_000  # distinct words a counting task holds before it hands them on
BATCH = 20_000  # words scored at once
LONG = 64  # longer words are scored one by one
SMOOTH = 0.5

MULT = np.uint64(0x9E3779B97F4A7C15)
LN10 = float(np.log(10.0))


@dataclass(frozen=True)
class Pieces:
    """Pieces by id (text, or None for byte pieces), log weights, ids of the 256 byte pieces and of the end."""

    text: tuple[str | None, ...]
    logp: np.ndarray
    byte_ids: np.ndarray
    end: int

    def with_logp(self, logp: np.ndarray) -> Pieces:
        return Pieces(self.text, logp, self.byte_ids, self.end)


def load_pieces(path: str = VOCABULARY) -> Pieces:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    text, rank, byte_ids, end = [], [], np.zeros(256, np.int64), 0
    for i in range(sp.get_piece_size()):
        if sp.is_control(i) or sp.is_unknown(i):
            if i == sp.eos_id():
                end = len(text)
                text.append(None)
                rank.append(0.0)
        elif sp.is_byte(i):
            byte_ids[int(sp.id_to_piece(i)[3:5], 16)] = len(text)
            text.append(None)
            rank.append(float(sp.get_piece_size()))
        elif not sp.is_unused(i):
            text.append(sp.id_to_piece(i))
            rank.append(min(-sp.get_score(i), float(sp.get_piece_size())))
    p = 1.0 / (10.0 + np.array(rank))
    return Pieces(tuple(text), np.log(p / p.sum()), byte_ids, end)


def _hash(codes: np.ndarray) -> int:
    h = np.zeros(1, np.uint64)
    for c in codes:
        h = (h + np.uint64(int(c) + 1)) * MULT
        h ^= h >> np.uint64(29)
    return int(h[0])


class Lattice:
    """Scores words under a set of pieces."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        ids = [i for i, t in enumerate(pieces.text) if t]
        keys = np.array([_hash(np.frombuffer(pieces.text[i].encode("utf-32-le"), np.uint32)) for i in ids], np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(ids, np.int64)[order]
        assert len(np.unique(self.keys)) == len(self.keys), "two pieces share a hash"
        self.by_text = {pieces.text[i]: i for i in ids}
        self.longest = max(len(pieces.text[i]) for i in ids)
        self.byte_logp = pieces.logp[pieces.byte_ids]

    def _spans(self, codes: np.ndarray) -> list[np.ndarray]:
        """Per length l: piece id of each span of l characters of (n, T) words, -1 if it is no piece."""
        out, h = [], np.zeros(codes.shape, np.uint64)
        for n in range(1, min(self.longest, codes.shape[1]) + 1):
            h = (h[:, :codes.shape[1] - n + 1] + codes[:, n - 1:].astype(np.uint64) + np.uint64(1)) * MULT
            h ^= h >> np.uint64(29)
            at = np.searchsorted(self.keys, h.ravel())
            at[at == len(self.keys)] = 0
            out.append(np.where(self.keys[at] == h.ravel(), self.ids[at], -1).reshape(h.shape))
        return out

    def _weights(self, codes: np.ndarray, spans: list[np.ndarray]) -> list[np.ndarray]:
        out = [np.where(s >= 0, self.pieces.logp[s], -np.inf) for s in spans]
        row, col = np.nonzero(spans[0] < 0)  # characters outside the vocabulary: their bytes
        for r, c in zip(row.tolist(), col.tolist()):
            out[0][r, c] = self._bytes(chr(int(codes[r, c])))
        return out

    def _bytes(self, char: str) -> float:
        return float(sum(self.byte_logp[b] for b in char.encode("utf-8", "surrogatepass")))

    @staticmethod
    def _forward(w: list[np.ndarray], n: int, steps: int) -> np.ndarray:
        a = np.zeros((n, steps + 1))
        for e in range(1, steps + 1):
            ways = np.stack([a[:, e - k] + w[k - 1][:, e - k] for k in range(1, min(len(w), e) + 1)])
            top = ways.max(axis=0)
            a[:, e] = top + np.log(np.exp(ways - top).sum(axis=0))
        return a

    @staticmethod
    def _backward(w: list[np.ndarray], n: int, steps: int) -> np.ndarray:
        b = np.zeros((n, steps + 1))
        for s in range(steps - 1, -1, -1):
            ways = np.stack([b[:, s + k] + w[k - 1][:, s] for k in range(1, min(len(w), steps - s) + 1)])
            top = ways.max(axis=0)
            b[:, s] = top + np.log(np.exp(ways - top).sum(axis=0))
        return b

    def _by_length(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(positions, codes) of words with the same number of characters, the start mark included.

        Long words come one at a time.
        """
        text = [START + w.decode("utf-8", "surrogatepass") for w in words]
        lens = np.fromiter(map(len, text), np.int64, len(text))
        for n in np.unique(lens).tolist():
            at = np.flatnonzero(lens == n)
            parts = [at] if n <= LONG else [at[i:i + 1] for i in range(len(at))]
            for p in parts:
                codes = np.frombuffer("".join([text[i] for i in p]).encode("utf-32-le", "surrogatepass"), np.uint32)
                yield p, codes.reshape(len(p), n)

    def score(self, words: list[bytes]) -> np.ndarray:
        """Natural log of each word's marginal probability."""
        out = np.zeros(len(words))
        for at, codes in self._by_length(words):
            w = self._weights(codes, self._spans(codes))
            out[at] = self._forward(w, *codes.shape)[:, -1]
        return out

    def expected(self, words: list[bytes], counts: np.ndarray, into: np.ndarray) -> None:
        """Add every piece's expected number of uses over all segmentations, times the words' counts."""
        for at, codes in self._by_length(words):
            spans = self._spans(codes)
            w = self._weights(codes, spans)
            n, steps = codes.shape
            a, b = self._forward(w, n, steps), self._backward(w, n, steps)
            z = a[:, -1:]
            for k, (s, v) in enumerate(zip(spans, w), 1):
                p = np.exp(a[:, :steps - k + 1] + v + b[:, k:] - z) * counts[at][:, None]
                known = s >= 0
                into += np.bincount(s[known], p[known], minlength=len(into))
                if k == 1:
                    for r, c in zip(*np.nonzero(~known)):
                        for byte in chr(int(codes[r, c])).encode("utf-8", "surrogatepass"):
                            into[self.pieces.byte_ids[byte]] += p[r, c]


@lru_cache(2)
def _lattice(key: int, shared) -> Lattice:
    return Lattice(shared.value)


def _words(text: bytes) -> list[bytes]:
    return text.lower().split()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c, n): count of every word in training rows and in all rows; the empty word counts rows (ends).

    ``docs``: text (binary) and train (boolean).  Tasks add up words before they hand them on.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        train, held = Counter(), Counter()

        def flush() -> pa.RecordBatch:
            words = list(train.keys() | held.keys())
            c = [train[w] for w in words]
            out = pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(c, pa.int64()),
                                              pa.array([x + held[w] for x, w in zip(c, words)], pa.int64())], ["word", "c", "n"])
            train.clear()
            held.clear()
            return out

        for b in batches:
            for text, is_train in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                into = train if is_train else held
                into.update(_words(text) if text else ())
                into[b""] += 1
                if len(train) + len(held) >= FLUSH:
                    yield flush()
        yield flush()

    schema = StructType([StructField("word", BinaryType()), StructField("c", LongType()), StructField("n", LongType())])
    return docs.select("text", "train").mapInArrow(count, schema).groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))


def _in_batches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= size:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def fit_pieces(spark: SparkSession, vocab: DataFrame, pieces: Pieces, ends: int) -> Pieces:
    """Piece probabilities of the training words: one expectation step from the start weights."""
    shared = spark.sparkContext.broadcast(pieces)
    size = len(pieces.text)

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, total = _lattice(id(shared), shared), np.zeros(size)
        for t in _in_batches(batches, BATCH):
            lattice.expected(t.column(0).to_pylist(), t.column(1).to_numpy().astype(float), total)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["piece", "uses"])

    known = vocab.where("c > 0 and octet_length(word) > 0").select("word", "c")
    rows = known.mapInArrow(expect, "piece long, uses double").groupBy("piece").agg(F.sum("uses").alias("uses")).toPandas()
    if not len(rows):
        return pieces
    uses = np.full(size, SMOOTH)
    uses[rows["piece"].to_numpy(np.int64)] += rows["uses"].to_numpy(float)
    uses[pieces.end] += ends
    return pieces.with_logp(np.log(uses / uses.sum()))


def frequent_words(words: DataFrame, most: int) -> DataFrame:
    """The most frequent words, at most ``most``: all whose frequency class (eighths of a power of two) fits whole.

    Only the class sizes (a few hundred rows) are looked at to find the cut.
    """
    words = words.withColumn("class", F.floor(F.log2(F.col("n")) * 8))
    cut, total = None, 0
    for r in words.groupBy("class").agg(F.count(F.lit(1)).alias("size")).orderBy(F.desc("class")).collect():
        total += r["size"]
        if total > most:
            break
        cut = r["class"]
    return words.where(F.col("class") >= cut) if cut is not None else words.where("false")


def score_documents(spark: SparkSession, docs: DataFrame, train: str = "__train", path: str = VOCABULARY,
                    hot: int = HOT) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs``.

    ``train`` names the boolean column of the rows to learn from.
    """
    ready(spark)
    raw = docs.select("doc_id", F.col("text").cast("string").cast("binary").alias("text"), F.col(train).alias("train"))
    vocab = save(spark, word_counts(raw), "words")
    stats = vocab.agg(F.sum("c").alias("n"), F.count_if(F.col("c") > 0).alias("v"),
                      F.sum(F.when(F.octet_length("word") == 0, F.col("c"))).alias("ends")).collect()[0]
    n, v, ends = int(stats["n"] or 0), int(stats["v"] or 0), int(stats["ends"] or 0)
    below = n + 0.5 * (v + 1)
    pieces = fit_pieces(spark, vocab, load_pieces(path), ends)
    shared = spark.sparkContext.broadcast(pieces)

    def lattice_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = _lattice(id(shared), shared)
        for t in _in_batches(batches, BATCH):
            words = t.column(0).to_pylist()
            c = t.column(1).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()), pa.array(c), pa.array(t.column(2).to_numpy()),
                 pa.array(np.log10((c + 0.5) / below)), pa.array(lattice.score(words) / LN10)], ["word", "c", "n", "base", "lp"])

    schema = StructType([StructField("word", BinaryType()), StructField("c", LongType()), StructField("n", LongType()),
                         StructField("base", DoubleType()), StructField("lp", DoubleType())])
    scored = save(spark, vocab.where("octet_length(word) > 0").mapInArrow(lattice_scores, schema), "scored-words")
    top = frequent_words(scored, hot).select("word", "c", "base", "lp").collect()
    frequent = spark.sparkContext.broadcast({bytes(r["word"]): (r["base"], r["lp"], int(r["c"] > 0)) for r in top})
    end = (float(np.log10((ends + 0.5) / below)), float(pieces.logp[pieces.end]) / LN10, int(ends > 0))
    id_type = docs.schema["doc_id"].dataType

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_words = frequent.value
        for b in batches:
            rid, who, word, times, sums = [], [], [], [], []
            for r, d, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                base, lp, known = end
                words = _words(text) if text else []
                for w, k in Counter(words).items():
                    s = known_words.get(w)
                    if s is None:
                        rid.append(r)
                        who.append(None)
                        word.append(w)
                        times.append(k)
                        sums.append((0.0, 0.0, 0, 0))
                    else:
                        base += k * s[0]
                        lp += k * s[1]
                        known += k * s[2]
                rid.append(r)
                who.append(d)
                word.append(b" %d" % r)  # holds a space: no word, and spread over the join's partitions
                times.append(0)
                sums.append((base, lp, known, len(words) + 1))
            cols = list(zip(*sums)) if sums else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rid, pa.int64()), pa.array(who, b.schema.field(1).type), pa.array(word, pa.binary()), pa.array(times, pa.int64()),
                 pa.array(cols[0], pa.float64()), pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64())],
                ["rid", "doc_id", "word", "k", "base", "lp", "known", "tokens"])

    schema = StructType([StructField("rid", LongType()), StructField("doc_id", id_type), StructField("word", BinaryType()),
                         StructField("k", LongType()), StructField("base", DoubleType()), StructField("lp", DoubleType()),
                         StructField("known", LongType()), StructField("tokens", LongType())])
    rows = raw.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text").mapInArrow(split, schema)
    rare = scored.select("word", F.col("c").alias("w_c"), F.col("base").alias("w_base"), F.col("lp").alias("w_lp"))
    j = rows.join(rare, "word", "left")
    add = lambda a, b: F.sum(F.col(a) + F.coalesce(F.col("k") * F.col(b), F.lit(0)))
    per = j.groupBy("rid").agg(
        F.max("doc_id").alias("doc_id"), F.sum("tokens").alias("n_tokens"),
        F.sum(F.col("known") + F.when(F.col("w_c") > 0, F.col("k")).otherwise(0)).alias("n_known"),
        add("base", "w_base").alias("base_score"), add("lp", "w_lp").alias("score"))
    return per.select("doc_id", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")


def digest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Contract columns: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    held = crc_mod(F.col("doc_id"), 5) == 1
    out = score_documents(spark, docs.select("doc_id", "text", (~held).alias("__train")))
    return out.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
