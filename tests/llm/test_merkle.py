import zlib
from hashlib import sha256

import duckdb
import pytest
from pyspark.sql import functions as F

from pumpline.llm import op12_merkle as M
from pumpline.llm.common import table
from tests.llm.conftest import DOCS, SF


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(r, text):
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[3], r[2], r[4], text)]
    return h(*parts)


def tree(leaves):
    """Root, and for each leaf its (left, right) siblings level by level."""
    paths, where, nodes = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(nodes) > 1:
        for i, at in enumerate(where):
            lo = at - at % 3
            paths[i].append((nodes[lo:at], nodes[at + 1:lo + 3]))
            where[i] = at // 3
        nodes = [h(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)]
    return nodes[0], paths


def brute(rows):
    """Rows (doc_id, text, lang, source, n_chars) -> sorted contract rows."""
    by = {}
    for r in rows:
        by.setdefault(r[3], []).append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in sources:
        own = sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees.append((own, *tree([leaf(r, r[1]) for r in own])))
    root, above = tree([t[1] for t in trees])
    out = []
    for (own, sub, paths), up in zip(trees, above):
        for r, path in zip(own, paths):
            path = path + up
            text = r[1]
            if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            node = leaf(r, text)
            for left, right in path:
                node = h(*left, node, *right)
            out.append((r[0], leaf(r, r[1]), sub, root, h(*[x for left, right in path for x in left + right]), node, node == root))
    return sorted(out, key=repr)


def digest(spark, df):
    got = M.digest(spark, df)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def rows_of(df):
    return [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in df.collect()]


def test_table_is_brute_force_and_sql(spark):
    df = table(spark, SF, "documents")
    want = brute(rows_of(df))
    assert digest(spark, df) == want
    assert {r[6] for r in want} == {True, False}
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    rel = con.sql(M.oracle())
    assert sorted(rel.fetchall(), key=repr) == want


@pytest.mark.parametrize("n", [1, 2, 3, 4, 729, 730, 2188])
def test_partitions_meet(spark, n):
    """One partition, a partition with a single leaf, several rounds: one hot source beside small ones."""
    df = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("a\nb "), "id").alias("text"), F.lit("en").alias("lang"),
                               F.lit("hot").alias("source"), F.lit(3).cast("long").alias("n_chars"))
    small = spark.createDataFrame([(5, "x", "en", "a", 1), (6, "y\n", None, None, None), (7, "z", "en", "\U0001f600", 1), (8, "z", "en", "￮", 1)], DOCS)
    df = df.unionByName(small)
    assert digest(spark, df) == brute(rows_of(df))


def test_exchange_gives_every_partition_the_root(spark):
    df = spark.range(5000).select(F.lit("t").alias("tree"), F.sha2(F.col("id").cast("string"), 256).alias("hash"), "id", F.lit(0).alias("tie"))
    placed = M.place(spark, df, ["id"])
    blocks = M.exchange(spark, placed).where("block < 7").collect()
    assert len(blocks) == 7 and len({b.root for b in blocks}) == 1
    for b in blocks:
        assert len(b.path) == 2
    assert blocks[0].root == tree([h(str(i)) for i in range(5000)])[0]


def test_odd_rows(spark, odd_docs):
    plain = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    assert digest(spark, odd_docs) == brute(rows_of(plain))
    assert M.digest(spark, odd_docs.limit(0)).count() == 0


def test_clashing_names(spark, frame):
    rows = [(i, f"t{i}\n", "en", f"s{i % 3}", 3) for i in range(20)]
    df = frame(rows).select("*", *[F.lit("x").alias(c) for c in ("tree", "block", "at", "n", "hash", "tie", "path", "root", "part", "changed") if c != "hash"])
    assert digest(spark, df) == brute(rows)
