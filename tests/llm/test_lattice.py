import functools
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from pumpline.llm import op10_lattice as L
from pumpline.llm.common import table
from tests.llm.conftest import SF


@pytest.fixture(scope="module")
def lattice():
    return L.Lattice(L.load_pieces())


def brute(lattice, word):
    """Sum over all segmentations, one by one through recursion."""
    t, logp = L.START + word, lattice.pieces.logp

    @functools.lru_cache(None)
    def rest(i):
        if i == len(t):
            return 1.0
        total = 0.0
        for j in range(i + 1, min(len(t), i + lattice.longest) + 1):
            k = lattice.by_text.get(t[i:j])
            if k is not None:
                total += np.exp(logp[k]) * rest(j)
            elif j == i + 1:
                total += np.exp(sum(logp[lattice.pieces.byte_ids[b]] for b in t[i].encode())) * rest(j)
        return total
    return np.log(rest(0))


WORDS = ["the", "a", "anha,", "èné", "thinringandthe", "\U0001f600x", "x" * 70, "1.2.3", "\x00"]


def test_word_scores_sum_over_all_segmentations(lattice):
    got = lattice.score([w.encode() for w in WORDS])
    assert np.abs(got - [brute(lattice, w) for w in WORDS]).max() < 1e-9


def test_very_long_word(lattice):
    got = lattice.score([b"ab" * 5000])[0]
    assert np.isfinite(got) and got < lattice.score([b"ab" * 500])[0]


def test_expected_uses_are_the_gradient_of_the_log_probability(lattice):
    """d log P / d log p(piece) is the expected number of uses."""
    into = np.zeros(len(lattice.pieces.text))
    lattice.expected([b"thing"], np.ones(1), into)
    for k in np.flatnonzero(into)[:12]:
        up = lattice.pieces.logp.copy()
        up[k] += 1e-5
        d = (L.Lattice(lattice.pieces.with_logp(up)).score([b"thing"])[0] - lattice.score([b"thing"])[0]) / 1e-5
        assert abs(d - into[k]) < 1e-3


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute_documents(rows):
    docs = [(i, words(t), zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1) for i, t in rows]
    c = Counter()
    for _, w, held in docs:
        if not held:
            c.update(w)
            c["\0end"] += 1
    n, v = sum(c.values()), len(c)
    lattice = L.Lattice(L.load_pieces())
    uses = np.full(len(lattice.pieces.text), L.SMOOTH)
    known = [w for w in c if w != "\0end"]
    pieces = lattice.pieces
    if known:
        lattice.expected([w.encode() for w in known], np.array([c[w] for w in known], float), uses)
        uses[pieces.end] += c["\0end"]
        pieces = pieces.with_logp(np.log(uses / uses.sum()))
    final = L.Lattice(pieces)
    distinct = sorted({w for _, ws, _ in docs for w in ws})
    lp = dict(zip(distinct, final.score([w.encode() for w in distinct]) / np.log(10))) if distinct else {}
    out = []
    for i, ws, held in docs:
        tokens = [*ws, "\0end"]
        base = sum(np.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        score = sum(lp[w] for w in ws) + pieces.logp[pieces.end] / np.log(10)
        out.append((i, held, len(tokens), sum(c[w] > 0 for w in tokens), n, round(base, 5), round(score, 5)))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5), round(r.score, 5)) for r in df.collect()), key=repr)


def close(a, b):
    assert [x[:5] for x in a] == [x[:5] for x in b]
    assert all(abs(x[k] - y[k]) < 1e-3 for x, y in zip(a, b) for k in (5, 6))


def test_digest_is_brute_force(spark):
    docs = table(spark, SF, "documents")
    close(rows_of(L.digest(spark, docs)), brute_documents([(r.doc_id, r.text) for r in docs.collect()]))


def test_rare_and_frequent_words_give_the_same(spark, monkeypatch):
    """All words joined, some broadcast, all broadcast."""
    docs = table(spark, SF, "documents").limit(40)
    want = brute_documents([(r.doc_id, r.text) for r in docs.collect()])
    for hot in (0, 30, 1_000_000):
        from pyspark.sql import functions as F
        out = L.score_documents(spark, docs.select("doc_id", "text", (F.crc32(F.col("doc_id").cast("string")) % 5 != 1).alias("t")), "t", hot=hot)
        got = {r.doc_id: r for r in out.collect()}
        for i, _, n, known, _, base, score in want:
            assert (got[i].n_tokens, got[i].n_known) == (n, known) and abs(got[i].base_score - base) < 1e-3 and abs(got[i].score - score) < 1e-3


def test_odd_rows(spark, odd_docs):
    close(rows_of(L.digest(spark, odd_docs)), brute_documents([(r.doc_id, r.text) for r in odd_docs.collect()]))
    assert L.digest(spark, odd_docs.limit(0)).count() == 0
