import math
from fractions import Fraction

import numpy as np
import pytest

from pumpline.llm import op11_whiten as W
from pumpline.llm.common import table
from tests.llm.conftest import SF

VECS = "vec_id long, embedding array<float>, label int"


def exact_poly(m):
    """det(t - m), lowest first, by Faddeev-LeVerrier in integers."""
    d = len(m)
    c, k = [0] * d + [1], [[0] * d for _ in range(d)]
    for i in range(1, d + 1):
        k = [[sum(m[r][x] * k[x][j] for x in range(d)) + (c[d - i + 1] if r == j else 0) for j in range(d)] for r in range(d)]
        c[d - i] = -sum(m[r][x] * k[x][r] for r in range(d) for x in range(d)) // i
    return c


def usable(rows, dims):
    return [r for r in rows if r[1] and len(r[1]) == dims and all(v is not None and math.isfinite(v) for v in r[1])]


def brute(rows, dims, k):
    rows = usable(rows, dims)
    x = [[math.floor(Fraction(float(np.float32(v))) * 1024) + 100000 for v in r[1]] for r in rows]
    n, s = len(x), [sum(c) for c in zip(*x)]
    dev = [sum((n * v - t) ** 2 for v, t in zip(r, s)) for r in x]
    y = np.array([[float(Fraction(n * v - t, n)) for v, t in zip(r, s)] for r in x])
    e, u = np.linalg.eigh(y.T @ y / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return rows, n, dev, y @ u / np.sqrt(e), e / (y * y).sum() * n


def check(spark, df, rows, dims, k=8, tol=1e-9):
    got = W.digest(spark, df)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = got.collect()
    kept, n, dev, white, share = brute(rows, dims, k)
    assert len(got) == n * k and {r.n for r in got} == {n}
    assert sorted((r.vec_id is None, r.vec_id or 0, r.deviation) for r in got if r.component == 1) == sorted(
        (r[0] is None, r[0] or 0, d) for r, d in zip(kept, dev))
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    for c in range(k):
        own = sorted((r.vec_id is None, r.vec_id or 0, r.deviation, r.whitened, r.explained) for r in got if r.component == c + 1)
        want = [w for _, w in sorted(((r[0] is None, r[0] or 0, d, i), white[i, c]) for i, (r, d) in enumerate(zip(kept, dev)))]
        mine = np.array([o[3] for o in own])
        assert min(np.abs(mine - want).max(), np.abs(mine + want).max()) < tol
        assert abs(own[0][4] - share[c]) < 1e-9
    return got


def test_table_is_brute_force(spark):
    df = table(spark, SF, "embeddings")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    check(spark, df, rows, 64)


def test_charpoly_is_exact(spark):
    r = np.random.default_rng(3)
    for d in (1, 2, 3, 7):
        a = r.integers(-10 ** 9, 10 ** 9, (d, d + 2)).astype(object)
        m = (a @ a.T).tolist()
        assert W.charpoly(spark, m) == exact_poly(m)
    zero_pivots = [[5, 0, 0, 1], [0, 5, 0, 0], [0, 0, 5, 0], [1, 0, 0, 5]]
    assert W.charpoly(spark, zero_pivots) == exact_poly(zero_pivots)


def test_roots_multiple_zero_and_close(spark):
    one = 1 << 64
    roots = [7, 7, one, one + 1, 0, 3]
    poly = [1]
    for r in roots:
        poly = [-r * a + b for a, b in zip([*poly, 0], [0, *poly])]
    got = W.leading_roots(poly, 5)
    assert [(round(Fraction(n, 1 << s)), k) for n, s, k in got] == [(one + 1, 1), (one, 1), (7, 2), (3, 1)]
    for (n, s, _), want in zip(got, (one + 1, one, 7, 3)):
        assert abs(Fraction(n, 1 << s) / want - 1) < Fraction(1, 1 << 150)


def test_multiple_eigenvalue_gets_orthogonal_components(spark, frame):
    rows = [(i, [float(s) if j == k else 0.0 for j in range(5)], 1) for i, (k, s) in enumerate((k, s) for k in range(5) for s in (-1, 1))]
    w = W.fit(spark, frame(rows, VECS))
    assert np.abs(w.axes.T @ w.axes - np.eye(5)).max() < 1e-15
    assert len(set(w.eigenvalues)) == 1 and abs(sum(w.explained) - 1) < 1e-15
    assert W.digest(spark, frame(rows, VECS)).first().identity_error < 1e-12


def test_odd_rows(spark, frame):
    r = np.random.default_rng(1)
    good = [(i, r.standard_normal(3).tolist(), 1) for i in range(40)]
    odd = [(None, [0.5, -0.25, 1.0], None), (7, [0.5, -0.25, 1.0], 1), (7, [0.5, -0.25, 1.0], 1), (100, None, 1), (101, [], 1), (102, [None, 1.0, 2.0], 1),
           (103, [float("nan"), 1.0, 2.0], 1), (104, [float("inf"), 1.0, 2.0], 1), (105, [1.0, 2.0], 1), (106, [-0.0, 0.0, -1e-30], 1)]
    df = frame(good + odd, VECS).withColumnRenamed("rid", "deviation")
    check(spark, df, good + odd, 3, k=3)
    assert W.digest(spark, df.limit(0)).count() == 0
    assert W.digest(spark, frame([(1, None, 1)], VECS)).count() == 0
    assert W.digest(spark, frame([(1, [3e38, 1.0], 1)], VECS)).count() == 0  # beyond a long


@pytest.mark.parametrize("n", [1, 2, 3])
def test_few_rows_have_components_without_variance(spark, frame, n):
    rows = [(i, [float(i), 1.0, 2.0], 1) for i in range(n)]
    got = W.digest(spark, frame(rows, VECS)).collect()
    assert len(got) == 3 * n
    assert all((r.whitened is None) == (r.component > 1 or n == 1) for r in got)
    assert all(r.identity_error < 1e-12 for r in got)


def test_large_values_stay_exact(spark, frame):
    r = np.random.default_rng(2)
    rows = [(i, (r.standard_normal(4) * 10.0 ** r.integers(0, 14)).tolist(), 1) for i in range(50)]
    df = spark.createDataFrame(rows, VECS)
    rows = usable(rows, 4)
    x = [[math.floor(Fraction(float(np.float32(v))) * 1024) + 100000 for v in q[1]] for q in rows]
    n, s = len(x), [sum(c) for c in zip(*x)]
    gn, gs, gm = W.scatter(df, 4)
    assert (gn, [v + n * 100000 for v in gs]) == (n, s)
    assert gm == [[n * sum(a[i] * a[j] for a in x) - s[i] * s[j] for j in range(4)] for i in range(4)]
    dev = {q[0]: sum((n * v - t) ** 2 for v, t in zip(a, s)) for q, a in zip(rows, x)}
    for q in W.whitened(spark, df).collect():
        assert int(q.deviation) == dev[q.vec_id]
    assert all(q.deviation == (dev[q.vec_id] if dev[q.vec_id] < 1 << 63 else None) for q in W.digest(spark, df).collect())
