"""Embedding whitening through the exact characteristic polynomial of the scatter.

Vectors become integers, so their scatter ``M = n * sum(x x') - S S'`` (n squared
times the covariance) is an integer matrix, added up exactly by the tasks.  What
follows depends on the dimension alone, not on the rows:

1. Modulo many primes, M is brought to Hessenberg form and its characteristic
   polynomial read off (Spark shares the primes out); Chinese remaindering gives
   the integer polynomial, since the product of the primes exceeds twice a bound on
   its coefficients.
2. All roots are real, so Descartes' count of sign changes after a shift by t is the
   exact number of eigenvalues above t.  Bisection on these counts isolates the
   leading roots; each is then refined by the polynomial's sign, in integers.
3. Inverse iteration in wide fixed-point numbers, started from fixed vectors, finds
   the null space of M minus the root: as many components as the root is multiple.

The rows are then centred and projected; one more pass measures the covariance of
the result against the identity.

Rows: a row is left out if its vector is null, empty, holds null or non-finite
entries or entries whose integer exceeds a long, or has another length than most
of the rest (of equally frequent lengths the longest counts).  Equal rows each
count.  A component without variance has no scale: whitened is null there, and it
does not enter the error.  Deviations beyond a long are null in the digest (the
operator itself returns decimals, null above 38 digits).  An empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, IntegerType, LongType, StructField, StructType

from pumpline.llm.common import ready

COMPONENTS = 8
SCALE, SHIFT = 1024.0, 100_000
#: Bits of a limb: products of two, 2**13 of them added, stay exact in doubles.
LIMB, ROWS = 20, 1 << 13
#: Bits of a sum's piece, so that Spark's sums of longs cannot overflow.
PIECE = 30
#: Bits to which a root is known, relative to its size, and of the fixed-point numbers.
ROOT_BITS = 160
WIDE = 320


# --- rows as integers -------------------------------------------------------------------

def integers(vectors: pa.Array, dims: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(positions, y): the usable vectors as y = x - SHIFT = floor(SCALE * c), one row each.

    Without ``dims``: (positions, lengths) of the rows that are usable at any length.
    """
    null = np.asarray(vectors.is_null())
    lengths = np.asarray(vectors.value_lengths().fill_null(0))
    flat = vectors.flatten().cast(pa.float64())
    values = np.asarray(flat.fill_null(np.nan))
    floor = np.floor(values * SCALE)
    # an x must fit a long
    good = np.isfinite(floor) & (floor < 2.0 ** 63 - 2.0 ** 18) & (floor >= -2.0 ** 63)
    row = np.repeat(np.arange(len(lengths)), lengths)
    usable = ~null & (lengths > 0)
    usable[row[~good]] = False
    if dims is None:
        return np.flatnonzero(usable), lengths[usable]
    usable &= lengths == dims
    at = np.flatnonzero(usable)
    return at, floor[usable[row]].astype(np.int64).reshape(-1, dims)


def _limbs(y: np.ndarray) -> list[np.ndarray]:
    """Signed pieces of LIMB bits as doubles: y = sum(piece << LIMB * k)."""
    out, rest = [], y
    while True:
        if -(1 << LIMB) <= rest.min(initial=0) and rest.max(initial=0) < 1 << LIMB:
            return [*out, rest.astype(float)]
        out.append((rest & ((1 << LIMB) - 1)).astype(float))
        rest = rest >> LIMB


def gram(y: np.ndarray) -> np.ndarray:
    """Exact sum of the rows' outer products, with the plain sums as a last row: Python integers."""
    d = y.shape[1]
    total = np.zeros((d + 1, d), object)
    for lo in range(0, len(y), ROWS):
        parts = _limbs(y[lo:lo + ROWS])
        for i, a in enumerate(parts):
            total[d] += a.sum(axis=0).astype(np.int64).astype(object) * (1 << LIMB * i)
            for j, b in enumerate(parts):
                total[:d] += (a.T @ b).astype(np.int64).astype(object) * (1 << LIMB * (i + j))
    return total


def _kind(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("embedding").cast("array<double>").alias("embedding"))


def dimension(rows: DataFrame) -> int:
    """The most frequent length of usable vectors (0: no row is usable)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, k = np.unique(integers(b.column(0))[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64()), pa.array(k, pa.int64())], ["d", "n"])

    per = _kind(rows).mapInArrow(count, "d long, n long").groupBy("d").agg(F.sum("n").alias("n"))
    top = per.agg(F.max(F.struct("n", "d")).alias("m")).first()["m"]
    return top["d"] if top else 0


def scatter(rows: DataFrame, dims: int) -> tuple[int, list[int], list[list[int]]]:
    """(n, sums of y, M): exact integers.  Tasks send d * (d + 1) sums each, in pieces; Spark adds them up."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros((dims + 1, dims), object)
        for b in batches:
            at, y = integers(b.column(0), dims)
            n += len(at)
            total += gram(y)
        place, piece, value = [-1], [0], [n]
        for k, v in enumerate(total.ravel().tolist()):
            i = 0
            while v:
                # the last piece keeps the sign
                low = v if -(1 << PIECE) < v < 1 << PIECE else v & ((1 << PIECE) - 1)
                place.append(k)
                piece.append(i)
                value.append(low)
                v, i = (v - low) >> PIECE, i + 1
        yield pa.RecordBatch.from_arrays([pa.array(place, pa.int64()), pa.array(piece, pa.int64()), pa.array(value, pa.int64())],
                                         ["place", "piece", "value"])

    got = (_kind(rows).mapInArrow(sums, "place long, piece long, value long").groupBy("place", "piece").agg(F.sum("value").alias("value"))
           .collect())  # d * (d + 1) sums, whatever the rows
    n, total = 0, [0] * ((dims + 1) * dims)
    for r in got:
        if r["place"] < 0:
            n = r["value"]
        else:
            total[r["place"]] += r["value"] << PIECE * r["piece"]
    q = [total[i * dims:(i + 1) * dims] for i in range(dims + 1)]
    s = q.pop()
    return n, s, [[n * q[i][j] - s[i] * s[j] for j in range(dims)] for i in range(dims)]


# --- characteristic polynomial ------------------------------------------------------------

def primes_below(top: int, count: int) -> list[int]:
    """The largest ``count`` primes below ``top`` (at most 2**31), by a sieve of the stretch they lie in."""
    base = np.ones(1 << 16, bool)
    base[:2] = False
    for i in range(2, 257):
        if base[i]:
            base[i * i::i] = False
    small, out, hi = np.flatnonzero(base).tolist(), [], top
    while len(out) < count:
        lo = hi - (1 << 16)
        own = np.ones(hi - lo, bool)
        for p in small:
            own[-lo % p::p] = False
        out += (np.flatnonzero(own)[::-1] + lo).tolist()
        hi = lo
    return out[:count]


def _inverse(a: np.ndarray, p: np.ndarray) -> np.ndarray:
    """a ** (p - 2) mod p, elementwise; 0 stays 0."""
    out, e, base = np.ones_like(a), p - 2, a.copy()
    while e.any():
        out = np.where(e & 1, out * base % p, out)
        base, e = base * base % p, e >> 1
    return np.where(a == 0, 0, out)


def charpoly_mod(m: np.ndarray, p: np.ndarray) -> np.ndarray:
    """(k, d + 1) coefficients, lowest first, of det(t - m) modulo each of k primes below 2**31; m: (k, d, d) residues."""
    h, (k, d, _) = m.copy(), m.shape
    each, q = np.arange(k), p[:, None]
    for c in range(d - 2):
        # a row whose entry in column c is not zero comes to place c + 1, the columns follow
        pick = c + 1 + np.argmax(h[:, c + 1:, c] != 0, axis=1)
        here = np.full(k, c + 1)
        h[each, pick], h[each, here] = h[each, here], h[each, pick]
        h[each, :, pick], h[each, :, here] = h[each, :, here], h[each, :, pick]
        inverse = _inverse(h[:, c + 1, c], p)
        factor = h[:, c + 2:, c] * inverse[:, None] % q
        for r in range(c + 2, d):
            u = factor[:, r - c - 2, None]
            h[:, r] = (h[:, r] - u * h[:, c + 1]) % q
            h[:, :, c + 1] = (h[:, :, c + 1] + u * h[:, :, r]) % q
    polys = [np.zeros((k, d + 1), np.int64)]
    polys[0][:, 0] = 1
    for c in range(d):
        new = (np.roll(polys[c], 1, axis=1) - h[:, c, c, None] * polys[c]) % q
        below = np.ones(k, np.int64)
        for i in range(c - 1, -1, -1):
            below = below * h[:, i + 1, i] % p
            new = (new - (below * h[:, i, c] % p)[:, None] * polys[i]) % q
        polys.append(new)
    return polys[d]


def charpoly(spark: SparkSession, m: list[list[int]], per_task: int = 8) -> list[int]:
    """Integer coefficients, lowest first, of det(t - m) of a positive semidefinite integer matrix.

    The coefficients' sum of sizes is the product of 1 + eigenvalue, at most (1 + trace / d) ** d.
    """
    d = len(m)
    bound = (2 + sum(m[i][i] for i in range(d)) // d) ** d
    need = -(-(2 * bound).bit_length() // 30)
    primes = primes_below(1 << 31, need)

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ps = b.column(0).to_pylist()
            for lo in range(0, len(ps), per_task):
                p = ps[lo:lo + per_task]
                residues = np.array([[[v % x for v in row] for row in m] for x in p], np.int64)
                c = charpoly_mod(residues, np.array(p, np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(p, pa.int64()), pa.array(c.tolist(), pa.list_(pa.int64()))], ["prime", "c"])

    tasks = max(1, min(-(-need // per_task), 256))
    work = spark.createDataFrame([(x,) for x in primes], "prime long").repartition(tasks, "prime")
    got = {r["prime"]: r["c"] for r in work.mapInArrow(share, "prime long, c array<long>").collect()}  # by dimension only
    whole = 1
    for x in primes:
        whole *= x
    out = [0] * (d + 1)
    for x in primes:
        part = whole // x
        scale = part * pow(part, -1, x)
        for i, c in enumerate(got[x]):
            out[i] += c * scale
    return [v - whole if 2 * (v := c % whole) > whole else v for c in out]


# --- roots and components -------------------------------------------------------------------

def roots_above(poly: list[int], num: int, shift: int) -> int:
    """Number of roots above num / 2**shift, multiple ones counted as often: sign changes of the shifted polynomial."""
    d = len(poly) - 1
    c = [a << shift * (d - i) for i, a in enumerate(poly)]  # roots times 2**shift
    for i in range(d):
        for j in range(d - 1, i - 1, -1):
            c[j] += num * c[j + 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _sign(poly: list[int], num: int, shift: int) -> int:
    v, scale = 0, 1
    for a in reversed(poly):
        v, scale = v * num + a * scale, scale << shift
    return (v > 0) - (v < 0)


def leading_roots(poly: list[int], most: int) -> list[tuple[int, int, int]]:
    """(numerator, shift, multiplicity) of the largest positive roots, ``most`` in all with multiplicity.

    The root lies within 2**-ROOT_BITS of its size of numerator / 2**shift.
    """
    top = max(1, -poly[-2]) if len(poly) > 1 else 1  # the sum of the roots
    hi, above, out = top.bit_length(), 0, []
    bound, shift = 1 << hi, 0
    positive = roots_above(poly, 0, 0)
    while above < min(most, positive):
        # lo has more roots above it than ``bound``, and what lies between is isolated by halving
        lo, up, s, inside = 0, bound, shift, positive - above
        while inside > 1 and not (lo and (up - lo) << ROOT_BITS <= lo):
            lo, up, s = lo * 2, up * 2, s + 1
            mid = (lo + up) // 2
            n = roots_above(poly, mid, s) - above
            if n:
                lo, inside = mid, n
            else:
                up = mid
        bound, shift = lo, s
        if inside == 1 and _sign(poly, up, s):
            # a simple root in (lo, up): the polynomial changes its sign there
            right = _sign(poly, up, s)
            while not (lo and (up - lo) << ROOT_BITS <= lo):
                lo, up, s = lo * 2, up * 2, s + 1
                mid = (lo + up) // 2
                if _sign(poly, mid, s) in (right, 0):
                    up = mid
                else:
                    lo = mid
        out.append((up, s, inside))
        above += inside
    return out


def null_space(m: list[list[int]], num: int, shift: int, count: int, seed: int = 5) -> list[list[int]]:
    """``count`` orthonormal vectors (fixed point, WIDE bits) that m - num / 2**shift maps to nearly zero.

    Gaussian elimination with partial pivots once; three steps of inverse iteration
    for each start vector, kept orthogonal to the ones before.
    """
    d = len(m)
    size = max(1, max(m[i][i] for i in range(d)))
    a = [[(((m[i][j] << shift) - (num if i == j else 0)) << WIDE) // (size << shift) for j in range(d)] for i in range(d)]
    order, factors = list(range(d)), [[0] * d for _ in range(d)]
    for c in range(d):
        best = max(range(c, d), key=lambda r: abs(a[r][c]))
        a[c], a[best], order[c], order[best] = a[best], a[c], order[best], order[c]
        factors[c], factors[best] = factors[best], factors[c]
        if not a[c][c]:
            a[c][c] = 1  # exactly singular: the smallest step away
        for r in range(c + 1, d):
            if a[r][c]:
                f = (a[r][c] << WIDE) // a[c][c]
                factors[r][c] = f
                row, pivot = a[r], a[c]
                for k in range(c + 1, d):
                    row[k] -= f * pivot[k] >> WIDE

    def solved(b: list[int]) -> list[int]:
        y = [b[i] for i in order]
        for i in range(d):
            y[i] -= sum(factors[i][k] * y[k] for k in range(i)) >> WIDE
        for i in range(d - 1, -1, -1):
            y[i] = ((y[i] << WIDE) - sum(a[i][k] * y[k] for k in range(i + 1, d))) // a[i][i]
        return y

    def unit(v: list[int]) -> list[int]:
        for _ in range(2):
            for u in out:
                dot = sum(x * y for x, y in zip(u, v)) >> WIDE
                v = [x - (dot * y >> WIDE) for x, y in zip(v, u)]
            top = max(abs(x) for x in v) or 1
            v = [(x << WIDE) // top for x in v]
            length = max(1, isqrt(sum(x * x for x in v)))
            v = [(x << WIDE) // length for x in v]
        return v

    out: list[list[int]] = []
    start = np.random.default_rng(seed)
    for _ in range(count):
        v = unit([int(x * (1 << 52)) << (WIDE - 52) for x in start.standard_normal(d)])
        for _ in range(3):
            v = unit(solved(v))
        big = max(range(d), key=lambda i: (abs(v[i]) >> (WIDE - 40), -i))
        out.append([-x for x in v] if v[big] < 0 else v)
    return out


def _ratio(a: int, b: int) -> float:
    """a / b as the nearest double, whatever their size."""
    return float(Fraction(a, b))


@dataclass(frozen=True)
class Whitening:
    """Number of rows, exact sums of y, components (dims x k, each over its root's size), scales, explained shares."""

    n: int
    sums: list[int]
    dims: int
    axes: np.ndarray
    eigenvalues: list[float]
    explained: list[float]

    def whiten(self, y: np.ndarray) -> np.ndarray:
        """Rows centred and projected; NaN for components without variance."""
        mean = np.array([_ratio(s, self.n) for s in self.sums])
        e = np.array(self.eigenvalues)
        with np.errstate(divide="ignore"):
            scale = np.where(e > 0, 1 / np.sqrt(e), np.nan)
        return (y - mean) @ self.axes * scale

    def deviations(self, y: np.ndarray) -> list[int]:
        """sum((n * y - sums) ** 2) of each row, exact."""
        big = np.abs(y).max(initial=0)
        if (int(big) * self.n + max(abs(s) for s in self.sums)) ** 2 * self.dims < 1 << 62:
            c = y * self.n - np.array(self.sums, np.int64)
            return (c * c).sum(axis=1).tolist()
        c = y.astype(object) * self.n - np.array(self.sums, object)
        return (c * c).sum(axis=1).tolist()


def fit(spark: SparkSession, rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all usable rows; None if there are none."""
    dims = dimension(rows)
    if not dims:
        return None
    n, sums, m = scatter(rows, dims)
    poly = charpoly(spark, m)
    trace = sum(m[i][i] for i in range(dims))
    k = min(components, dims)
    axes, values, shares = [], [], []
    for num, shift, times in leading_roots(poly, k):
        for v in null_space(m, num, shift, min(times, k - len(axes))):
            axes.append([_ratio(x, 1 << WIDE) for x in v])
            values.append(_ratio(num, n * n << shift))
            shares.append(_ratio(num, trace << shift))
    if len(axes) < k:  # no variance is left
        axes += [[_ratio(x, 1 << WIDE) for x in v] for v in null_space(m, 0, 0, k - len(axes))]
        values += [0.0] * (k - len(values))
        shares += [0.0] * (k - len(shares))
    return Whitening(n, sums, dims, np.array(axes).T, values, shares)


def identity_error(rows: DataFrame, w: Whitening) -> float:
    """Largest entry of (covariance of the whitened rows - identity), over all rows; components without variance left out."""
    live = [i for i, e in enumerate(w.eigenvalues) if e > 0]
    if not live:
        return 0.0

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, q = np.zeros(len(live)), np.zeros((len(live), len(live)))
        for b in batches:
            _, y = integers(b.column(0), w.dims)
            z = w.whiten(y)[:, live]
            s, q = s + z.sum(axis=0), q + z.T @ z
        both = np.concatenate((s, q.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(both))), pa.array(both)], ["place", "value"])

    got = _kind(rows).mapInArrow(moments, "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()
    both = np.zeros(len(live) * (len(live) + 1))
    for r in got:
        both[r["place"]] = r["value"]
    mean = both[:len(live)] / w.n  # the rows are centred already: this is rounding
    cov = both[len(live):].reshape(len(live), -1) / w.n - np.outer(mean, mean)
    return float(np.abs(cov - np.eye(len(live))).max())


def whitened(spark: SparkSession, rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation decimal, whitened, explained, identity_error), a row for each vector and component."""
    ready(spark)
    kind = rows.schema["vec_id"].dataType
    schema = StructType([StructField("vec_id", kind), StructField("component", IntegerType()), StructField("n", LongType()),
                         StructField("deviation", DecimalType(38, 0)), StructField("whitened", DoubleType()),
                         StructField("explained", DoubleType()), StructField("identity_error", DoubleType())])
    src = rows.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    w = fit(spark, rows, components)
    if w is None:
        return spark.createDataFrame([], schema)
    error, k = identity_error(rows, w), w.axes.shape[1]
    limit = 10 ** 38

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, y = integers(b.column(1), w.dims)
            m = len(at)
            dev = pa.array([v if v < limit else None for v in w.deviations(y)], pa.decimal128(38, 0))
            each = np.repeat(np.arange(m), k)
            z = w.whiten(y).ravel()
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(at[each])), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, w.n)),
                 dev.take(pa.array(each)), pa.array(z, mask=np.isnan(z)), pa.array(np.tile(w.explained, m)), pa.array(np.full(m * k, error))],
                names=schema.names)

    return src.mapInArrow(project, schema)


def digest(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Contract columns; ``deviation`` as a long, null beyond it."""
    return whitened(spark, rows).withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))
