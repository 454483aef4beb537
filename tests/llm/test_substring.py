import random
from hashlib import sha256

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from pumpline.llm import op13_substring as S
from pumpline.llm.common import table
from pumpline.llm.tokens import ASIS, word_hashes
from tests.llm.conftest import SF


def brute(rows, w=13):
    """(doc_id, text) rows -> sorted (doc_id, n_words, n_removed, kept_sha256)."""
    least, split = {}, [(i, (t or "").encode().split()) for i, t in rows]
    for i, words in split:
        for a in range(len(words) - w + 1) if i is not None else ():
            k = tuple(words[a:a + w])
            least[k] = min(least.get(k, i), i)
    out = []
    for i, words in split:
        gone = set()
        for a in range(len(words) - w + 1) if i is not None else ():
            if least[tuple(words[a:a + w])] < i:
                gone.update(range(a, a + w))
        kept = b" ".join(x for j, x in enumerate(words) if j not in gone)
        out.append((i, len(words), len(gone), sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def digest(spark, df):
    got = S.digest(spark, df)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def docs(frame, texts):
    return frame([(i, t, "en", "s", 0) for i, t in enumerate(texts)])


def test_table_is_brute_force_and_sql(spark):
    df = table(spark, SF, "documents")
    want = brute([(r.doc_id, r.text) for r in df.collect()])
    assert digest(spark, df) == want
    assert sum(r[2] for r in want) > 0
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    assert sorted(con.sql(S.ORACLE).fetchall(), key=repr) == want


@pytest.mark.parametrize("letters", [1, 2, 3, 40])
def test_random_repeats(spark, frame, letters):
    """Small alphabets: runs, periods and symbols everywhere."""
    r = random.Random(letters)
    shared = [" ".join(r.choice("abcdefgh") for _ in range(n)) for n in (12, 13, 14, 30, 80)]
    texts = []
    for _ in range(60):
        own = [f"w{r.randrange(letters)}" for _ in range(r.randrange(60))]
        at = r.randrange(len(own) + 1)
        texts.append(" ".join(own[:at] + [r.choice(shared)] + own[at:]))
    df = docs(frame, texts)
    assert digest(spark, df) == brute(list(enumerate(texts)))


def test_equal_windows_have_equal_anchors():
    """The claim the operator rests on, whatever stands around a window, and however a text is cut into pieces."""
    r = np.random.default_rng(4)
    for letters in (2, 5, 1000):
        window = [f"x{v}" for v in r.integers(0, letters, 13)]
        seen = set()
        for _ in range(40):
            left, right = ([f"x{v}" for v in r.integers(0, letters, r.integers(0, 30))] for _ in range(2))
            words, sizes = word_hashes([" ".join(left + window + right).encode()], ASIS)
            name, first, last, _ = S.anchors(words, sizes)
            k = np.flatnonzero((first <= len(left)) & (last >= len(left)))
            assert len(k) == 1
            seen.add(int(name[k[0]]))
        assert len(seen) == 1


def test_pieces_of_a_long_text(monkeypatch):
    r = np.random.default_rng(5)
    text = " ".join(f"x{v}" for v in r.integers(0, 30, 3000)).encode()
    whole = S.text_anchors([text])[0]
    monkeypatch.setattr(S, "PIECE", 100)
    cut = S.text_anchors([b"", text, b"a b"])
    assert len(cut[0][0]) == len(cut[2][0]) == 0
    spread = lambda x: {j: int(n) for n, a, b in zip(*x) for j in range(a, b + 1)}
    assert spread(cut[1]) == spread(whole) and sorted(spread(whole)) == list(range(2988))


def test_ids_decide(spark, frame):
    t = " ".join(f"w{i}" for i in range(20))
    rows = [(5, t, "en", "s", 0), (5, t, "en", "s", 0), (5, "head " + t, "en", "s", 0), (None, t, "en", "s", 0), (9, t, "en", "s", 0), (7, t[:-4], "en", "s", 0)]
    df = frame(rows)
    want = brute([(r[0], r[1]) for r in rows])
    assert digest(spark, df) == want
    assert {(r[0], r[2]) for r in want} == {(5, 0), (None, 0), (9, 20), (7, 19)}


def test_white_space_case_and_unicode(spark, frame):
    base = [f"Wört{i}" for i in range(13)]
    texts = [" ".join(base), "\t".join(base) + "\x0b", "\r\n".join(base).lower(), " ".join(base) + " ", "  " + " \x0c ".join(base) + " end"]
    df = docs(frame, texts)
    got = digest(spark, df)
    assert got == brute(list(enumerate(texts)))
    assert [r[2] for r in got] == [0, 13, 0, 0, 13]


def test_odd_rows(spark, odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert digest(spark, odd_docs) == brute(rows)
    assert S.digest(spark, odd_docs.limit(0)).count() == 0
    clash = odd_docs.select("*", *[F.lit("x").alias(c) for c in ("k", "name", "first", "last", "ranges", "own", "least", "kept", "at", "w")])
    assert digest(spark, clash) == brute(rows)


def test_hot_passage(spark):
    """A third of the texts hold one passage; others are copies."""
    passage = F.lit(" ".join(f"p{i}" for i in range(60)))
    own = F.concat_ws(" ", *[F.concat(F.lit(f"u{j}-"), (F.col("id") if j % 2 else F.floor(F.col("id") / 10)).cast("string")) for j in range(30)])
    df = spark.range(900).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.concat_ws(" ", own, passage, own)).otherwise(own).alias("text"))
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert digest(spark, df) == brute(rows)


