import random
import re

import numpy as np
import pytest
import xxhash

from pumpline.llm import op5_simhash as S
from pumpline.llm.common import components, table
from tests.llm.conftest import SF


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum((2 * sum(h >> b & 1 for h in hs) > len(hs)) << b for b in range(64))


def brute_components(ids, fps):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    f = np.array(fps, np.uint64)
    for k in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(f[k + 1:] ^ f[k]) <= 2):
            a, b = find(ids[k]), find(ids[k + 1 + j])
            parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("text", [None, "", " \n", "one", "A b", "Ä b\x0bC d e f", "x y z w " * 40, "a\x00b c d"])
def test_fingerprint_is_the_contract(text):
    assert S.fingerprint(text) == brute_fingerprint(text)


def test_fingerprint_in_steps_is_the_same():
    text = " ".join(str(i % 37) for i in range(500))
    assert S.fingerprint(text, step=7) == S.fingerprint(text)


def test_golay_indices_of_neighbours_meet():
    rng = np.random.default_rng(0)
    v = rng.integers(0, 1 << 23, 3000)
    own = [set(x[x >= 0]) for x in S.golay_indices(v)]
    assert {len(x) for x in own} == {1, 6}
    for bit in range(23):
        assert all(a & set(x[x >= 0]) for a, x in zip(own, S.golay_indices(v ^ (1 << bit))))


def test_keys_of_fingerprints_two_bits_apart_meet():
    rng = np.random.default_rng(1)
    u = rng.integers(0, 1 << 63, 300, dtype=np.uint64)

    def keys(x):
        out = {}
        for a, k in zip(*S.golay_keys(x)):
            out.setdefault(int(a), set()).add(int(k))
        return out
    own = keys(u)
    for _ in range(60):
        i, j = rng.integers(0, 64, 2)
        w = u ^ np.uint64(1 << int(i)) ^ np.uint64(1 << int(j))
        other = keys(w)
        assert all(own[k] & other[k] for k in own)


@pytest.mark.parametrize("bucket", [2, 32])
def test_links_keep_every_connection(spark, bucket):
    """A dense ball of fingerprints, with all keys hot and with none."""
    r = random.Random(3)
    centre = [r.getrandbits(64) for _ in range(6)]
    fps = sorted({c ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 4))) for c in centre for _ in range(40)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    roots = {r_.node: r_.root for r_ in components(spark, S.links(spark, df, 2, bucket)).collect()}
    want = brute_components(list(range(len(fps))), fps)
    groups = {}
    for i, s in enumerate(signed):
        groups.setdefault(want[i], set()).add(roots.get(s, s))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_components_of_chains_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(0, 200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5), (2000, 2001), (2001, 2002), (2002, 2000)]
    got = {}
    for r in components(spark, spark.createDataFrame(edges, "a long, b long")).collect():
        got.setdefault(r.root, set()).add(r.node)
    assert sorted(map(len, got.values())) == [3, 201, 300]


def test_digest_is_brute_force(spark):
    docs = table(spark, SF, "documents")
    rows = docs.select("doc_id", "text").collect()
    ids, fps = [r.doc_id for r in rows], [brute_fingerprint(r.text) for r in rows]
    want = brute_components(ids, fps)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in S.digest(spark, docs).collect()}
    assert got == {i: (f"{f:016x}", want[i]) for i, f in zip(ids, fps)}


def test_odd_rows(spark, odd_docs):
    rows = S.digest(spark, odd_docs).collect()
    assert len(rows) == 10
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, set()).add((r.fingerprint, r.component_id))
    assert by[1] == by[2] == by[3] == {("0" * 16, 1)}  # no words: fingerprint zero, linked like any other
    assert {c for _, c in by[6]} == {6} and ("0" * 16, 1) in by[None]
    kept = S.drop_near_copies(spark, odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 5, 6, 7]


def test_empty_table(spark, odd_docs):
    none = odd_docs.limit(0)
    assert S.digest(spark, none).count() == 0 and S.drop_near_copies(spark, none).count() == 0
