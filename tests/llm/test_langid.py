import zlib

import numpy as np

from pumpline.llm import op2_langid as L
from pumpline.llm.common import table
from tests.llm.conftest import SF


def test_buckets_are_those_of_single_texts():
    texts = ["abc", "", "äx ", "Ωmega \U0001f600", "a" * 50]
    together, at = L.ngram_buckets(texts)
    for n in range(len(L.SIZES)):
        ends = np.append(at[n][1:], len(together[n]))
        for i, t in enumerate(texts):
            assert together[n][at[n][i]:ends[i]].tolist() == L.ngram_buckets([t])[0][n].tolist()
            assert ends[i] - at[n][i] == max(0, len(t) + 2 - n)


def test_held_out_accuracy_and_brute_force(spark):
    docs = table(spark, SF, "documents")
    rows = docs.select("doc_id", "text", "lang").collect()
    train = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
    langs = sorted({r.lang for r in train})
    size = 1 << L.BUCKET_BITS
    counts = np.zeros((3, len(langs), size))
    for r in train:
        for n, g in enumerate(L.ngram_buckets([r.text])[0]):
            np.add.at(counts[n, langs.index(r.lang)], g, 1)
    logp = np.log(counts + L.ALPHA) - np.log(counts.sum(axis=2, keepdims=True) + L.ALPHA * size)
    prior = np.log([(sum(r.lang == x for r in train) + 1) / (len(train) + len(langs)) for x in langs])
    got = {r.doc_id: r for r in L.digest(spark, docs).collect()}
    assert len(got) == len(rows)
    right = 0
    for r in rows:
        total = prior + sum(logp[n][:, g].sum(axis=1) for n, g in enumerate(L.ngram_buckets([r.text])[0]))
        p = np.exp(total - total.max())
        g = got[r.doc_id]
        assert g.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert g.lang_pred == langs[int(total.argmax())] and abs(g.score - p.max() / p.sum()) < 1e-6
        right += g.lang_pred == r.lang
    assert right >= 0.98 * len(rows)


def test_long_texts_go_piece_by_piece(monkeypatch):
    model = L.Model(("a", "b"), np.log([0.5, 0.5]), np.log(np.random.default_rng(0).random((3, 2, 1 << L.BUCKET_BITS))))
    text = "some words in a row " * 30
    total = model.prior + sum(model.logp[n][:, g].sum(axis=1) for p in (text[:256], text[256:512], text[512:]) for n, g in enumerate(L.ngram_buckets([p])[0]))
    monkeypatch.setattr(L, "CHUNK", 256)
    lang, score = model.predict(["short", text, None, "other"])
    p = np.exp(total - total.max())
    assert lang[1] == model.langs[int(total.argmax())] and abs(score[1] - p.max() / p.sum()) < 1e-9 and lang[2] == "und"


def test_odd_rows(spark, odd_docs):
    got = L.digest(spark, odd_docs).collect()
    assert len(got) == 10
    for r in got:
        if r.doc_id in (1, 2, 3, 4):
            assert (r.lang_pred, r.score) == ("und", 0.0)  # null, empty or without a letter
    assert {r.lang_pred for r in got if r.doc_id in (5, 6, 7)} <= {"en", "de"}
    kept = L.keep_identified(spark, odd_docs)
    assert kept.columns == odd_docs.columns and kept.where("doc_id in (1, 2, 3, 4)").count() == 0 and kept.where("doc_id = 6").count() == 2


def test_nothing_to_learn_from(spark, odd_docs):
    assert L.digest(spark, odd_docs.limit(0)).count() == 0
    unlabelled = odd_docs.where("lang is null")
    assert {r.lang_pred for r in L.digest(spark, unlabelled).collect()} == {"und"}


def test_ties_go_to_the_first_language(spark, frame):
    rows = [(i, "same text", x, "s", 9) for i, x in enumerate(["b", "a", "b", "a"] * 4) if zlib.crc32(str(i).encode()) % 4 != 2]
    n = min(sum(r[2] == "a" for r in rows), sum(r[2] == "b" for r in rows))
    even = [r for r in rows if r[2] == "a"][:n] + [r for r in rows if r[2] == "b"][:n]
    assert {r.lang_pred for r in L.digest(spark, frame(even)).collect()} == {"a"}
