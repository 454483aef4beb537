"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-gram buckets per language over every labelled text, each task
for its own rows, and sums them in Spark.  The model is one log-probability
matrix (languages x buckets), a size that does not follow the corpus, so it is
broadcast; ``max_langs`` is the checked bound.  Scoring hashes the n-grams of a
whole batch of texts at once and sums the matrix entries text by text.

Rows: a text that is null or holds no letter gives ``und`` with score 0, as does
every text when nothing could be learned (no labelled text).  Ties go to the
language that is first by code point.  Empty labels are labels like any other;
null labels are not learned from.  Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pumpline.llm.common import chunks, crc_mod, fresh, names, ready

UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")

#: n-gram lengths, buckets (a power of two), additive smoothing, code points handled at once.
SIZES = (1, 2, 3)
BUCKET_BITS = 14
ALPHA = 0.5
CHUNK = 1 << 19


def ngram_buckets(texts: list[str], sizes=SIZES, bits: int = BUCKET_BITS) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Per n: the hashed n-gram buckets of all texts laid end to end, and each text's first position.

    Texts are lower-cased and wrapped in one line break on either side, so that
    word starts and ends count, and no n-gram spans two texts.
    """
    parts = [f"\n{t.lower()}\n" for t in texts]
    codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
    lens = np.fromiter(map(len, parts), np.int64, len(parts))
    starts = np.concatenate(([0], np.cumsum(lens)[:-1]))
    mixed = codes * np.uint32(2654435761)
    out, at = [], []
    h = mixed.copy()
    for n in range(1, max(sizes) + 1):
        if n > 1:
            h = (h[:-1] * np.uint32(2246822519)) ^ mixed[n - 1:]
            h ^= h >> np.uint32(15)
        if n in sizes:
            full = (h * np.uint32(3266489917)) >> np.uint32(32 - bits)
            # the n - 1 last positions of each text would reach into the next one
            keep = np.ones(len(full), bool)
            for back in range(1, n):
                edge = starts[1:] - back
                keep[edge[edge >= 0]] = False
            counts = np.maximum(lens - (n - 1), 0)
            out.append(full[keep].astype(np.int64))
            at.append(np.concatenate(([0], np.cumsum(counts)[:-1])))
    return out, at


def pieces(text: str) -> list[str]:
    """A text in pieces of ``CHUNK`` code points, each counted like a text: memory does not follow the longest text."""
    return [text[i:i + CHUNK] for i in range(0, len(text), CHUNK)] or [""]


@dataclass(frozen=True)
class Model:
    """Languages in code-point order, log prior, log P(bucket | language) by n-gram length."""

    langs: tuple[str, ...]
    prior: np.ndarray
    logp: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        use = [i for i, t in enumerate(texts) if t and self.langs and LETTER.search(t)]
        for part in chunks(use, lambda i: len(texts[i]), CHUNK):
            total = np.tile(self.prior, (len(part), 1))
            for own in ([[texts[i] for i in part]] if len(part) > 1 else [[p] for p in pieces(texts[part[0]])]):
                grams, starts = ngram_buckets(own)
                for n, (g, s) in enumerate(zip(grams, starts)):
                    ends = np.append(s[1:], len(g))
                    for k in range(len(self.langs)):
                        sums = np.concatenate(([0.0], np.cumsum(self.logp[n, k][g])))
                        total[:, k] += sums[ends] - sums[s]
            best = total.argmax(axis=1)
            p = np.exp(total - total.max(axis=1, keepdims=True))
            p = 1.0 / p.sum(axis=1)
            for i, b, v in zip(part, best, p):
                lang[i], score[i] = self.langs[b], v
        return lang, score


def train(spark: SparkSession, docs: DataFrame, max_langs: int = 1000) -> Model:
    """Learn from every row of ``docs`` (text, lang) with a non-null label."""
    size = 1 << BUCKET_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            by_lang: dict[str, list[str]] = {}
            for t, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                by_lang.setdefault(lang, []).append(t)
            for lang, texts in by_lang.items():
                # the last entry counts the texts
                own = sums.setdefault(lang, np.zeros(len(SIZES) * size + 1, np.int64))
                own[-1] += len(texts)
                for part in chunks((p for t in texts for p in pieces(t)), len, CHUNK):
                    for n, g in enumerate(ngram_buckets(part)[0]):
                        own[n * size:(n + 1) * size] += np.bincount(g, minlength=size)
            if len(sums) > max_langs:
                raise ValueError(f"more than {max_langs} languages")
        for lang, own in sums.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at), pa.array(own[at])],
                                             ["lang", "bucket", "n"])

    known = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("text is not null and lang is not null")
    rows = (known.mapInArrow(count, "lang string, bucket long, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
            .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("bucket", "n"))).alias("counts"))
            .orderBy("lang").limit(max_langs + 1).select("lang", "counts.bucket", "counts.n").toPandas())
    if len(rows) > max_langs:
        raise ValueError(f"more than {max_langs} languages")
    langs = sorted(rows["lang"])
    counts = np.zeros((len(SIZES), len(langs), size))
    texts = np.zeros(len(langs))
    for lang, at, n in zip(rows["lang"], rows["bucket"], rows["n"]):
        k, flat = langs.index(lang), np.zeros(len(SIZES) * size + 1)
        flat[np.asarray(at)] = np.asarray(n)
        counts[:, k], texts[k] = flat[:-1].reshape(len(SIZES), size), flat[-1]
    logp = np.log(counts + ALPHA) - np.log(counts.sum(axis=2, keepdims=True) + ALPHA * size)
    return Model(tuple(langs), np.log((texts + 1) / (texts.sum() + max(len(langs), 1))) if langs else texts, logp)


def predictor(spark: SparkSession, model: Model):
    """A function Column -> Column of struct<lang, score>, over whole texts."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def predict(text: pd.Series) -> pd.DataFrame:
        lang, score = shared.value.predict([t if isinstance(t, str) else None for t in text])
        return pd.DataFrame({"lang": lang, "score": score})

    return lambda text: predict(text.cast("string"))


def digest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Contract columns: doc_id, held_out, lang_pred, score."""
    ready(spark)
    held: Column = crc_mod(F.col("doc_id"), 4) == 2
    model = train(spark, docs.where(~held))
    predict = predictor(spark, model)
    return (docs.select("doc_id", held.alias("held_out"), predict(F.col("text")).alias("p"))
            .select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score")))


def keep_identified(spark: SparkSession, docs: DataFrame, min_score: float = 0.0) -> DataFrame:
    """Documents whose language is identified, with at least ``min_score``; the columns of ``docs``.

    By default only texts without a language go: a short text that several
    languages share is clean, however low its best posterior.
    """
    ready(spark)
    model = train(spark, docs.where(crc_mod(F.col("doc_id"), 4) != 2))
    p = predictor(spark, model)(F.col("text"))
    (said,) = fresh(docs, "said")
    return (docs.withColumn(said, p).where(F.col(said)["lang"] != UNKNOWN)
            .where(F.col(said)["score"] >= min_score).select(*names(docs)))
