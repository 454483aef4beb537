import math

import numpy as np
import pytest

from pumpline.llm import op3_nndescent as N
from pumpline.llm.common import table

VECS = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.93):
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], lab) for i, v, lab in rows]

    def usable(v, lab):
        return lab is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    n = len(rows)
    parent, links = list(range(n)), [0] * n

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    unit = [np.array(v) / np.linalg.norm(v) if usable(v, lab) else None for _, v, lab in rows]
    for a in range(n):
        for b in range(a + 1, n):
            if unit[a] is not None and unit[b] is not None and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold:
                links[a] += 1
                links[b] += 1
                parent[find(a)] = find(b)
    small = {}
    for k in range(n):
        small.setdefault(find(k), []).append(rows[k][0])
    comp = [min((i for i in small[find(k)] if i is not None), default=None) for k in range(n)]
    return sorted(((rows[k][0], links[k], comp[k], rows[k][0] is not None and rows[k][0] == comp[k]) for k in range(n)), key=repr)


def digest(spark, df):
    out = N.digest(spark, df).collect()
    assert all(r.audit_recall >= 0.99 for r in out)
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in out), key=repr)


def test_clusters_larger_than_the_lists(spark, frame):
    """A dense cluster saturates the lists; a chain is long; noise links with nothing."""
    r = np.random.default_rng(0)
    centre = r.standard_normal(16)
    rows = [(i, (centre + 0.12 * r.standard_normal(16)).tolist(), 1) for i in range(60)]
    angle = 0.15
    rows += [(100 + i, [math.cos(i * angle), math.sin(i * angle)] + [0.0] * 14, 2) for i in range(25)]
    rows += [(200 + i, r.standard_normal(16).tolist(), int(i % 2) + 1) for i in range(80)]
    rows += [(400 + i, rows[i][1], 1) for i in range(5)] + [(500, [2 * x for x in rows[0][1]], 1)]
    assert digest(spark, frame(rows, VECS)) == brute(rows)


def test_rings_keep_all_links_of_a_cluster(spark):
    r = np.random.default_rng(1)
    centre = r.standard_normal(8)
    x = [(centre + s * r.standard_normal(8)).astype("<f8") for s in np.linspace(0.05, 0.5, 90)]
    df = spark.createDataFrame([(i, 0, bytearray(v.tobytes()), 1 + i % 2) for i, v in enumerate(x)], "rid long, root long, v binary, copies long")
    was, N.BLOCK = N.BLOCK, 16
    try:
        got = {row.rid: row.links for row in N.cluster_counts(spark, df, 0.93).collect()}
    finally:
        N.BLOCK = was
    u = np.array([v / np.linalg.norm(v) for v in x])
    cos = u @ u.T >= 0.93
    np.fill_diagonal(cos, False)
    assert [got.get(i, 0) for i in range(90)] == (cos @ np.array([1 + i % 2 for i in range(90)])).tolist()


def test_full_lists_of_clumps_that_touch(spark, frame, monkeypatch):
    """Every vector's nearest ten stay in its own clump, yet the clumps link; some clumps are far away."""
    monkeypatch.setattr(N, "BLOCK", 16)
    r = np.random.default_rng(5)
    basis = np.linalg.qr(r.standard_normal((32, 32)))[0]
    rows = []
    for k, angle in enumerate((0.0, 0.33, 0.66)):
        centre = math.cos(angle) * basis[0] + math.sin(angle) * basis[1]
        rows += [(100 * k + i, (centre + 0.015 * r.standard_normal(32)).tolist(), 1) for i in range(20 + 5 * k)]
    for k in (3, 4):
        rows += [(100 * k + i, (basis[k] + 0.015 * r.standard_normal(32)).tolist(), 1) for i in range(20)]
    rows += [(900 + i, rows[i][1], 1) for i in range(3)] + [(950 + i, rows[0][1], 2) for i in range(2)]
    want = brute(rows)
    assert len({c for _, _, c, _ in want}) == 4  # the three clumps are one component
    assert digest(spark, frame(rows, VECS)) == want


def test_audit_sees_pairs_beside_a_hot_group(spark, frame, monkeypatch):
    """One narrow order misses isolated pairs; a hot group's many links must not hide that."""
    monkeypatch.setattr(N, "ORDERS", 1)
    monkeypatch.setattr(N, "ROUNDS", 1)
    monkeypatch.setattr(N, "WINDOW", 8)
    r = np.random.default_rng(3)
    centre = r.standard_normal(32)
    rows = [(i, (centre + 0.05 * r.standard_normal(32)).tolist(), 1) for i in range(300)]
    for k in range(150):
        x = r.standard_normal(32)
        rows += [(1000 + 2 * k, x.tolist(), 1), (1001 + 2 * k, (x + 0.3 * r.standard_normal(32)).tolist(), 1)]
    assert digest(spark, frame(rows, VECS)) == brute(rows)


def test_recall_out_of_reach_is_an_error(spark, frame, monkeypatch):
    monkeypatch.setattr(N, "AUDITS", 1)
    monkeypatch.setattr(N, "audit", lambda *_: 0.9)
    with pytest.raises(RuntimeError, match="recall 0.9"):
        N.digest(spark, frame([(1, [1.0, 0.0], 1), (2, [1.0, 0.1], 1)], VECS))


def test_table_is_brute_force(spark):
    df = table(spark, "/root/testdata/sf0.01", "embeddings")
    rows = df.select("vec_id", "embedding", "label").collect()
    x = np.array([r.embedding for r in rows], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T >= 0.93) & (np.array([r.label for r in rows])[:, None] == np.array([r.label for r in rows]))
    np.fill_diagonal(near, False)
    got = {r.vec_id: (r.n_links, r.component_id) for r in N.digest(spark, df).collect()}
    assert {r.vec_id: int(n) for r, n in zip(rows, near.sum(axis=1))} == {i: n for i, (n, _) in got.items()}
    for a, b in zip(*np.nonzero(near)):
        assert got[rows[a].vec_id][1] == got[rows[b].vec_id][1]


def test_odd_rows(spark, frame):
    big = 3e38
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (None, [1.0, 0.01], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [], 1), (6, [0.0, 0.0], 1),
            (7, [float("nan"), 1.0], 1), (8, [None, 1.0], 1), (9, [float("inf"), 1.0], 1), (10, [1.0, 0.0, 0.0], 1), (11, [big, big], 2), (12, [1.0, 1.0], 2),
            (None, [0.0, 0.0], 1), (13, [1e-38, 0.0], 1), (14, [-1.0, 0.0], 1)]
    df = frame(rows, VECS)
    assert digest(spark, df) == brute(rows)
    assert N.digest(spark, df.limit(0)).count() == 0


def test_negative_zero_is_zero(spark, frame):
    rows = [(1, [1.0, -0.0], 1), (2, [1.0, -0.0], 1), (3, [1.0, 0.0], 1), (4, [1.0, 0.01], 1), (5, [-0.0, -1.0], 1)]
    assert digest(spark, frame(rows, VECS)) == brute(rows)


@pytest.mark.parametrize("n", [1, 2])
def test_few_rows(spark, frame, n):
    rows = [(i, [1.0, 2.0], 1) for i in range(n)]
    assert digest(spark, frame(rows, VECS)) == brute(rows)
