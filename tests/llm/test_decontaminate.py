import random

import numpy as np

from pumpline.llm import op9_decontaminate as D
from pumpline.llm.common import table
from pumpline.llm.tokens import word_hashes
from tests.llm.conftest import SF

BENCH = "item_id long, text string"


def test_word_hashes_follow_the_words(monkeypatch):
    texts = [t.encode() for t in ["", "one", " A b\tC\n", "Ü x\x0by", "w" * 5000, "a b " * 300, "\x00 é"]]
    want = [t.lower().split() for t in texts]
    for piece in (1 << 20, 16):
        monkeypatch.setattr("pumpline.llm.tokens.PIECE", piece)
        h, n = word_hashes(texts)
        assert n.tolist() == [len(w) for w in want]
        flat = [w for ws in want for w in ws]
        assert len({(a, b) for a, b in zip(flat, h.tolist())}) == len(set(flat)) == len(set(h.tolist()))


def test_lcs_is_brute_force():
    r = random.Random(0)
    for _ in range(200):
        a = [r.randint(0, 5) for _ in range(r.randint(1, 12))]
        b = [r.randint(0, 5) for _ in range(r.randint(0, 15))]
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert D.lcs(D._masks(a), len(a), b) == t[-1][-1]


def test_latent_space_is_that_of_the_exact_svd(spark):
    """With as many dimensions as terms the projected cosines are the exact TF-IDF cosines."""
    docs = table(spark, SF, "documents")
    bench = [r.text.encode() for r in table(spark, SF, "benchmark").limit(3).collect()]
    terms = D.Terms.of(word_hashes(bench)[0])
    texts = docs.selectExpr("cast(text as binary) as text").where("text is not null")
    df, n = D.tile_frequencies(texts, terms)
    space = D.weighted(terms, df, n, bench)
    basis = D.singular_vectors(texts, space, bench, n, dims=len(df))
    assert np.abs(basis.T @ basis - np.eye(basis.shape[1])).max() < 1e-3
    full = D.Space(terms, space.weight, space.other, basis)
    h, n_words = word_hashes(bench)
    starts, _ = D.tile_starts(n_words)
    exact = D.Space(terms, space.weight, space.other, np.eye(len(df), dtype=np.float32))
    a, b = (s.project(terms.columns(h), starts) for s in (full, exact))
    assert np.abs(a @ a.T - b @ b.T).max() < 1e-2 * (b @ b.T).max()
    # document frequencies by hand
    words = [w for r in docs.collect() if r.text for w in [r.text.encode().lower().split()]]
    some = bench[0].lower().split()[0]
    col = int(terms.columns(word_hashes([some])[0])[0])
    assert df[col] == sum(some in w[i:i + D.TILE] for w in words for i in range(0, len(w), D.TILE))
    assert n == sum(-(-len(w) // D.TILE) for w in words)


def planted(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").limit(60).collect()]
    bench = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    clean = [(i, t) for i, t in docs if not any(b in t for _, b in bench)]
    r = random.Random(4)
    rows, truth = [], set()
    for k, (item, text) in enumerate(bench):
        host = clean[k % len(clean)][1].split()
        at = r.randint(0, len(host))
        words = text.split()
        if k % 3 == 1:  # a paraphrase: words left out, others added, case changed
            words = [w.upper() if w.isascii() else w for w in words if r.random() > 0.1]
            words.insert(len(words) // 2, "extra")
        if k % 3 == 2:
            words = (" " * 3 + "\n").join(words).split(" ")
        rows.append((1000 + k, " ".join(host[:at] + words + host[at:]), "en", "s", 0))
        truth.add((1000 + k, item))
    return rows + [(i, t, "en", "s", 0) for i, t in clean], bench, truth


def test_planted_passages_and_paraphrases(spark, frame):
    rows, bench, truth = planted(spark)
    docs, items = frame(rows), frame(bench, BENCH)
    got = {(r.doc_id, r.item_id) for r in D.digest(spark, docs, items).collect()}
    exact = {(d, i) for d, i in truth if (d - 1000) % 3 != 1}
    assert exact <= got and len(truth & got) >= 0.95 * len(truth)
    assert all(d >= 1000 for d, _ in got)  # clean documents are left alone
    kept = D.drop_contaminated(spark, docs, items)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in rows} - {d for d, _ in got}


def test_verbatim_items_are_found_at_any_corpus_size(spark, frame, monkeypatch):
    """The same documents as a tiny part of a huge corpus: short items and items of frequent words stay candidates."""
    rows, bench, truth = planted(spark)
    r = random.Random(9)
    short = [(500 + k, " ".join(r.sample(text.split(), 5))) for k, (_, text) in enumerate(bench[:20])]
    filler = [f"filler{k}" for k in range(400)]
    extra = []
    for item, text in short:
        at = r.randint(0, 60)
        words = [r.choice(filler) for _ in range(100)]
        extra.append((2000 + item, " ".join([*words[:at], text, *words[at:]]), "en", "s", 0))
    docs, items = frame(rows + extra), frame(bench + short, BENCH)
    count = D.tile_frequencies
    monkeypatch.setattr(D, "tile_frequencies", lambda texts, terms: tuple(x * 10 ** 7 for x in count(texts, terms)))
    got = {(x.doc_id, x.item_id) for x in D.digest(spark, docs, items).collect()}
    want = {(d, i) for d, i in truth if (d - 1000) % 3 != 1} | {(2000 + i, i) for i, _ in short}
    assert want <= got, len(want - got)


def test_coverage_is_brute_force():
    r = random.Random(2)
    bench = [" ".join(r.choice("abcdefgh") for _ in range(n)).encode() for n in (3, 16, 17, 40)]
    terms = D.Terms.of(word_hashes(bench)[0])
    weight = np.array([0.0, *(1.0 + k for k in range(len(terms.hashes) - 1))], np.float32)
    pieces = D.Pieces.of(terms, weight, bench)
    texts = [" ".join(r.choice("abcdefghxyzuvw") for _ in range(n)).encode() for n in (1, 70, 16, 33)]
    h, n_words = word_hashes(texts)
    starts, text = D.tile_starts(n_words)
    col = terms.columns(h)
    pair = np.append(text[1:] == text[:-1], False)
    parts = [(j, p) for j, b in enumerate(bench) for c in [terms.columns(word_hashes([b])[0])] for p in np.array_split(c, -(-len(c) // D.TILE))]
    want = set()
    ends = np.append(starts[1:], len(col))
    for t in range(len(starts)):
        own = col[starts[t]:ends[t + 1] if pair[t] else ends[t]].tolist()
        for j, p in parts:
            e = {c: p.tolist().count(c) * float(weight[c]) ** 2 for c in set(p.tolist())}
            if sum(e[c] * own.count(c) for c in e) >= D.MIN_COVER * sum(e[c] * p.tolist().count(c) for c in e) > 0:
                want.add((t, j))
    for n in (1 << 14, 2):
        was, D.TILES = D.TILES, n
        try:
            assert set(zip(*(x.tolist() for x in pieces.covered(col, starts, pair)))) == want
        finally:
            D.TILES = was


def test_small_steps_change_nothing(spark, frame, monkeypatch):
    rows, bench, _ = planted(spark)
    docs, items = frame(rows), frame(bench, BENCH)
    one = {(r.doc_id, r.item_id) for r in D.digest(spark, docs, items).collect()}
    index = D.indexes(spark, docs, items)[0]
    texts = [r[1].encode() for r in rows]
    whole = index.hits(texts)
    for name, n in (("WORDS", 7), ("TILES", 3), ("BYTES", 500)):
        monkeypatch.setattr(D, name, n)
    assert [[(a, b) for a, b, _ in x] for x in index.hits(texts)] == [[(a, b) for a, b, _ in x] for x in whole]
    assert {(r[0], a) for r, x in zip(rows, whole) for a, _, _ in x} == one


def test_blocks_of_items_change_nothing(spark, frame, monkeypatch):
    rows, bench, _ = planted(spark)
    docs, items = frame(rows), frame(bench[:20], BENCH)
    one = {(r.doc_id, r.item_id) for r in D.digest(spark, docs, items).collect()}
    monkeypatch.setattr(D, "BLOCK", 8)
    assert {(r.doc_id, r.item_id) for r in D.digest(spark, docs, items).collect()} == one


def test_table_holds_exactly_the_passages(spark):
    docs, bench = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "benchmark")
    items = bench.collect()
    want = {(r.doc_id, b.item_id) for r in docs.collect() if r.text for b in items if b.text in r.text}
    assert {(r.doc_id, r.item_id) for r in D.digest(spark, docs, bench).collect()} == want


def test_odd_rows(spark, odd_docs, frame):
    bench = frame([(1, None), (2, ""), (3, "  "), (4, "the same words stand in this row twice over"), (4, "the same words stand in this row twice over"),
                   (None, "lorem ipsum"), (5, "x"), (6, "Where is it? in this row twice over")], BENCH)
    got = D.digest(spark, odd_docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} >= {(6, 4), (None, 4)} and not any(r.doc_id in (1, 2, 3, 4) for r in got)
    kept = D.drop_contaminated(spark, odd_docs, bench)
    assert kept.columns == odd_docs.columns and kept.where("doc_id in (1, 2, 3, 4)").count() == 4 and kept.where("doc_id = 6").count() == 0
    assert D.digest(spark, odd_docs.limit(0), bench).count() == 0
    assert D.digest(spark, odd_docs, bench.limit(0)).count() == 0
    assert D.drop_contaminated(spark, odd_docs, bench.limit(0)).count() == 10


def test_terms_together_are_the_gram_matrix():
    r = np.random.default_rng(8)
    bench = [" ".join(f"t{v}" for v in r.integers(0, 40, 20)).encode() for _ in range(5)]
    texts = [" ".join(f"t{v}" for v in r.integers(0, 80, n)).encode() for n in (1, 16, 17, 200)]
    terms = D.Terms.of(D.word_hashes(bench)[0])
    space = D.weighted(terms, r.integers(1, 50, len(terms.hashes)).astype(float), 1000, bench)
    m = len(space.weight)
    half, want = np.zeros(m * m, np.float32), np.zeros((m, m))
    for t in texts:
        h, n = D.word_hashes([t])
        starts = D.tile_starts(n)[0]
        D.together(space, h, starts, half)
        col = terms.columns(h)
        full, _ = space.lengths(col, starts)
        for k, s in enumerate(starts):
            row = np.zeros(m)
            for c in col[s:s + D.TILE]:
                if c >= 0:
                    row[c] += space.weight[c]
            want += np.outer(row, row) / max(full[k], 1e-12)
    half = half.reshape(m, m)
    assert np.allclose((half + half.T) * np.outer(space.weight, space.weight), want, rtol=1e-4, atol=1e-6)
