"""Embedding near-duplicates by NN-descent on a neighbour graph.

Equal vectors of a label become one representative with a count.  Then:

1. First lists: several random-hyperplane orders sort the representatives of each
   label (32 sign bits, so rows that agree on a long prefix are neighbours, however
   many there are); overlapping windows of the order give each row its nearest ones.
2. Descent: at every node its neighbours and reverse neighbours meet, and each
   keeps the others that beat its list's last entry.  Rounds go on until the lists
   hardly improve.  A hub's rows are split over several groups.
3. Saturated lists: where a list is full and even its last entry is a link, the
   list is enlarged to the node's whole connected cluster, compared in blocks.  All
   links lie between neighbouring rings of angles around one member, so long
   clusters are not compared with themselves as a whole; only counts leave a block.
   A full list may also hide links to other such clusters: clusters whose members
   can be that close (by the angles of their pivots and their radii) are compared
   with each other the same way and joined where a link is found.
4. Audit: bounded samples of all vectors and of those outside crowded clusters are
   compared with all rows.  Recall is the mean over the sampled vectors that have
   links, the lower one of the two samples.  The orders grow with the largest label;
   while recall is below the target their number is doubled, and it is an error if
   ``AUDITS`` sets do not reach it.

Links are the pairs with cosine >= ``threshold`` in double precision; all pairs
are verified.  Rows: a vector without label, null, empty, zero or with a null or
non-finite component links with nothing (its component is its own id); vectors of
different lengths never link; -0.0 counts as 0.0; repeated rows count as separate vectors; a null id
never becomes a component's id and is not kept; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pumpline.llm.common import components, hash_sample, ready, save

THRESHOLD = 0.93
LIST = 10
ORDERS = 6
BITS = 32
WINDOW = 256
ROUNDS = 4
STILL = 1e-3  # relative gain of the lists' cosines below which the descent stops
BLOCK = 512
AUDIT = 1024
RECALL = 0.995
AUDITS = 8

PAIR = "u long, v long, cos double"


def packed(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """(rid, label, dim, v, copies, first_id): distinct usable vectors; ``v`` holds little-endian doubles."""
    reps = save(spark, rows.where("usable").groupBy("label", "embedding")
                .agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first_id")), "vec-reps")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = [np.array(x, "<f8") + 0.0 for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([len(x) for x in raw], pa.int32()),
                 pa.array([x.tobytes() for x in raw], pa.binary()), b.column(3), b.column(4)],
                ["rid", "label", "dim", "v", "copies", "first_id"])

    kinds = dict(reps.dtypes)
    return save(spark, reps.select(F.monotonically_increasing_id().alias("rid"), "label", "embedding", "copies", "first_id")
                .mapInArrow(pack, f"rid long, label {kinds['label']}, dim int, v binary, copies long, first_id {kinds['first_id']}"), "vec-packed")


def unit(rows: list[bytes]) -> np.ndarray:
    """Unit vectors (n, dim) of packed vectors of one length."""
    x = np.frombuffer(b"".join(rows), "<f8").reshape(len(rows), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no square overflows or vanishes
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal keys in sorted batches, each as one table."""
    held: list[pa.Table] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        cols = [t.column(k).to_pylist() for k in keys]
        ks = list(zip(*cols))
        lo = 0
        for i, k in enumerate(ks):
            if k != last:
                if i > lo:
                    held.append(t.slice(lo, i - lo))
                if held:
                    yield pa.concat_tables(held)
                held, lo, last = [], i, k
        held.append(t.slice(lo))
    if held:
        yield pa.concat_tables(held)


def _best(cos: np.ndarray, rows: np.ndarray, ids: np.ndarray, most: int, floor: np.ndarray | None = None):
    """For the given rows of a cosine matrix the ``most`` best others (above their floor): (u, v, cos)."""
    c = cos[rows]
    c[np.arange(len(rows)), rows] = -2.0
    k = min(most, c.shape[1] - 1)
    if k < 1:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0),)
    top = np.argpartition(-c, k - 1, axis=1)[:, :k]
    val = np.take_along_axis(c, top, axis=1)
    ok = val > (-2.0 if floor is None else floor[rows][:, None])
    r, j = np.nonzero(ok)
    return ids[rows[r]], ids[top[r, j]], val[r, j]


def first_lists(vectors: DataFrame, orders: range, most: int) -> DataFrame:
    """(u, v, cos): neighbours inside windows of each random order."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            dims = b.column(2).to_numpy()
            vs = b.column(3).to_pylist()
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                x = unit([vs[i] for i in at])
                for t in orders:
                    if (t, dim) not in planes:
                        planes[t, dim] = np.random.default_rng((t, dim)).standard_normal((dim, BITS))
                    code = ((x @ planes[t, dim]) > 0) @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))
                    own = b.take(pa.array(at))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), t, np.int32)), pa.array(code), *own.columns], ["t", "code", *b.schema.names])

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _windows(batches):
            ids, v, rows = g
            x = unit(v)
            u, w, c = _best(x @ x.T, rows, ids, most)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(w), pa.array(c)], ["u", "v", "cos"])

    src = vectors.select("rid", "label", "dim", "v")
    kind = dict(src.dtypes)["label"]
    placed = src.mapInArrow(place, f"t int, code long, rid long, label {kind}, dim int, v binary")
    order = ["t", "label", "dim", "code", "rid"]
    return (placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(near, PAIR))


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[bytes], np.ndarray]]:
    """Overlapping windows of sorted rows of one (t, label, dim): ids, vectors and the rows a window answers for.

    Windows start every half; each row is answered by the window that has it in its middle half.
    """
    ids: list[int] = []
    vs: list[bytes] = []
    key, first = None, True
    half, quarter = WINDOW // 2, WINDOW // 4

    def tail() -> tuple[np.ndarray, list[bytes], np.ndarray]:
        return np.array(ids), vs, np.arange(0 if first else quarter, len(ids))

    for b in batches:
        cols = [b.column(k).to_pylist() for k in ("t", "label", "dim", "rid", "v")]
        for t, label, dim, rid, v in zip(*cols):
            if (t, label, dim) != key:
                if len(ids) > 1:
                    yield tail()
                key, ids, vs, first = (t, label, dim), [], [], True
            ids.append(rid)
            vs.append(v)
            if len(ids) == WINDOW:
                yield np.array(ids), vs, np.arange(0 if first else quarter, WINDOW - quarter)
                ids, vs, first = ids[half:], vs[half:], False
    if len(ids) > 1:
        yield tail()


def shortest(pairs: DataFrame, most: int) -> DataFrame:
    """The ``most`` best distinct neighbours of each node."""
    rank = Window.partitionBy("u").orderBy(F.desc("cos"), "v")
    return (pairs.groupBy("u", "v").agg(F.max("cos").alias("cos"))
            .withColumn("place", F.row_number().over(rank)).where(F.col("place") <= most).drop("place"))


def descend(spark: SparkSession, vectors: DataFrame, graph: DataFrame, most: int) -> DataFrame:
    """One round: neighbours and reverse neighbours of every node meet; improved lists come back."""
    floors = graph.groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.min("cos").alias("low"))
    floors = floors.select(F.col("u").alias("rid"), F.when(F.col("n") >= most, F.col("low")).otherwise(-2.0).alias("low"))
    known = save(spark, vectors.select("rid", "v").join(floors, "rid").select(F.col("rid").alias("x"), "v", "low"), "nn-known")
    ends = save(spark, graph.select(F.col("u").alias("mid"), F.col("v").alias("x"))
                .unionByName(graph.select(F.col("v").alias("mid"), F.col("u").alias("x"))).distinct(), "nn-ends")
    hubs = ends.groupBy("mid").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > WINDOW)
    ends = save(spark, ends.join(hubs, "mid", "left").select(
        "mid", "x", F.when(F.col("n").isNull(), 0).otherwise(F.pmod(F.xxhash64("x"), F.ceil(F.col("n") / WINDOW))).alias("part")), "nn-parts")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in groups(batches, ["mid", "part"]):
            if g.num_rows < 2:
                continue
            ids, low = g.column("x").to_numpy(), g.column("low").to_numpy()
            x = unit(g.column("v").to_pylist())
            u, w, c = _best(x @ x.T, np.arange(len(ids)), ids, most, low)
            if len(u):
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(w), pa.array(c)], ["u", "v", "cos"])

    met = ends.join(known, "x").select("mid", "part", "x", "low", "v")
    better = met.repartition("mid", "part").sortWithinPartitions("mid", "part").mapInArrow(meet, PAIR)
    return save(spark, shortest(graph.unionByName(better), most), "nn-graph")


def neighbour_graph(spark: SparkSession, vectors: DataFrame, orders: range, most: int, start: DataFrame | None = None) -> DataFrame:
    pairs = first_lists(vectors, orders, most)
    if start is not None:
        pairs = pairs.unionByName(start)
    graph = save(spark, shortest(pairs, most), "nn-first")
    total = graph.agg(F.sum("cos")).collect()[0][0]
    for _ in range(ROUNDS if total is not None else 0):
        graph = descend(spark, vectors, graph, most)
        now = graph.agg(F.sum("cos")).collect()[0][0]
        if now - total <= STILL * max(abs(total), 1e-9):
            break
        total = now
    return graph


def cluster_counts(spark: SparkSession, members: DataFrame, threshold: float) -> DataFrame:
    """(rid, links): for members (rid, root, v, copies) of clusters the copies linked in the whole cluster, itself left out."""
    width = math.acos(threshold) + 1e-6
    pivots = members.where("rid = root").select(F.col("root"), F.col("v").alias("pivot"))
    near = members.join(pivots, "root").select("rid", "root", "v", "copies", "pivot")

    def ring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v, p = b.column(2).to_pylist(), b.column(4).to_pylist()
            at = [int(math.acos(min(1.0, max(-1.0, float(unit([x])[0] @ unit([y])[0])))) / width) for x, y in zip(v, p)]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(at, pa.int32())], ["rid", "root", "v", "copies", "ring"])

    ringed = save(spark, near.mapInArrow(ring, "rid long, root long, v binary, copies long, ring int"), "nn-rings")
    sizes = save(spark, ringed.groupBy("root", "ring").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")), "nn-ring-sizes")
    placed = ringed.join(sizes, ["root", "ring"]).withColumn("block", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int")).drop("blocks")
    placed = save(spark, placed, "nn-placed")
    other = sizes.select("root", F.col("ring").alias("other"), "blocks")
    wide = (placed.withColumn("other", F.explode(F.array(F.col("ring") - 1, F.col("ring"), F.col("ring") + 1)))
            .join(other, ["root", "other"]).withColumn("against", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    left = wide.select("root", F.col("ring").alias("a"), F.col("other").alias("b"), F.col("block").alias("i"), F.col("against").alias("j"), F.lit(0).alias("side"), "rid", "copies", "v")
    right = wide.select("root", F.col("other").alias("a"), F.col("ring").alias("b"), F.col("against").alias("i"), F.col("block").alias("j"), F.lit(1).alias("side"), "rid", "copies", "v")
    key = ["root", "a", "b", "i", "j"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in groups(batches, key):
            side = g.column("side").to_numpy()
            ids, copies, v = g.column("rid").to_numpy(), g.column("copies").to_numpy(), g.column("v").to_pylist()
            x = unit(v)
            lo, hi = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            linked = (x[lo] @ x[hi].T >= threshold) & (ids[lo][:, None] != ids[hi])
            yield pa.RecordBatch.from_arrays([pa.array(ids[lo]), pa.array(linked @ copies[hi])], ["rid", "links"])

    rows = left.unionByName(right).repartition(*key).sortWithinPartitions(*key, "side")
    return rows.mapInArrow(count, "rid long, links long").groupBy("rid").agg(F.sum("links").alias("links"))


def _angles(v: list[bytes], p: list[bytes]) -> np.ndarray:
    """Angle between each vector and its pivot (of the same length)."""
    out, size = np.zeros(len(v)), np.array([len(x) for x in v], np.int64)
    for n in np.unique(size).tolist():
        at = np.flatnonzero(size == n)
        out[at] = np.arccos(np.clip((unit([v[i] for i in at]) * unit([p[i] for i in at])).sum(axis=1), -1.0, 1.0))
    return out


def cross_links(spark: SparkSession, members: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Links between different clusters of members (rid, root, label, dim, v, copies): (rid, links) and linked roots (a, b).

    Of two clusters that may touch, the smaller one's members visit the larger one:
    by their angle to its pivot they meet only its neighbouring rings.
    """
    width = math.acos(threshold) + 1e-6
    kinds = dict(members.dtypes)
    heads = members.where("rid = root").select("root", F.col("v").alias("pivot"))
    placed = members.join(heads, "root").select("rid", "root", "label", "dim", "v", "copies", "pivot")

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = _angles(b.column(4).to_pylist(), b.column(6).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns[:6], pa.array(at)], [*b.schema.names[:6], "angle"])

    native = save(spark, placed.mapInArrow(turn, f"rid long, root long, label {kinds['label']}, dim int, v binary, copies long, angle double")
                  .withColumn("ring", F.floor(F.col("angle") / width).cast("int")), "nn-native")
    reach = native.groupBy("root", "label", "dim").agg(F.max("angle").alias("radius"), F.count(F.lit(1)).alias("size"))
    pivots = reach.join(heads, "root")
    blocks = pivots.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    pivots = save(spark, pivots.join(blocks, ["label", "dim"]).withColumn("block", F.pmod(F.xxhash64("root"), F.col("blocks")).cast("int")), "nn-pivots")
    spread = pivots.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "label", "dim", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "root", "radius", "size", "pivot")

    def touch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in groups(batches, ["label", "dim", "i", "j"]):
            side, root, radius, size = (g.column(c).to_numpy() for c in ("block", "root", "radius", "size"))
            x = unit(g.column("pivot").to_pylist())
            i, j = g.column("i")[0].as_py(), g.column("j")[0].as_py()
            lo, hi = np.flatnonzero(side == i), np.flatnonzero(side == j)
            near = np.arccos(np.clip(x[lo] @ x[hi].T, -1.0, 1.0)) <= radius[lo][:, None] + radius[hi] + width
            a, b = np.nonzero(near)
            a, b = lo[a], hi[b]
            a, b = (k[root[a] < root[b]] for k in (a, b)) if i == j else (a, b)
            first = (size[a] < size[b]) | ((size[a] == size[b]) & (root[a] < root[b]))
            yield pa.RecordBatch.from_arrays([pa.array(root[np.where(first, a, b)]), pa.array(root[np.where(first, b, a)])], ["guest", "host"])

    order = ["label", "dim", "i", "j"]
    calls = save(spark, spread.repartition(*order).sortWithinPartitions(*order).mapInArrow(touch, "guest long, host long"), "nn-calls")
    hosts = pivots.select(F.col("root").alias("host"), "pivot", "radius")
    going = (native.select(F.col("root").alias("guest"), "rid", "v", "copies").join(calls, "guest").join(hosts, "host")
             .select("rid", "guest", "host", "v", "copies", "radius", "pivot"))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = _angles(b.column(3).to_pylist(), b.column(6).to_pylist())
            ok = np.flatnonzero(at <= b.column(5).to_numpy() + width)
            own = b.take(pa.array(ok))
            yield pa.RecordBatch.from_arrays([*own.columns[:5], pa.array((at[ok] / width).astype(np.int32))], [*b.schema.names[:5], "ring"])

    guests = save(spark, going.mapInArrow(visit, "rid long, guest long, host long, v binary, copies long, ring int"), "nn-guests")

    def dealt(rows: DataFrame, cluster: str, name: str) -> tuple[DataFrame, DataFrame]:
        sizes = save(spark, rows.groupBy(cluster, "ring").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")), f"nn-{name}-sizes")
        out = rows.join(sizes, [cluster, "ring"]).withColumn("block", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int")).drop("blocks")
        return save(spark, out, f"nn-{name}-dealt"), sizes

    guests, guest_sizes = dealt(guests, "host", "guest")
    called = native.join(calls.select(F.col("host").alias("root")).distinct(), "root", "left_semi")
    at_home, home_sizes = dealt(called.select("rid", F.col("root").alias("host"), "v", "copies", "ring"), "host", "home")

    def wide(rows: DataFrame, sizes: DataFrame) -> DataFrame:
        other = sizes.select("host", F.col("ring").alias("other"), "blocks")
        return (rows.withColumn("other", F.explode(F.array(F.col("ring") - 1, F.col("ring"), F.col("ring") + 1)))
                .join(other, ["host", "other"]).withColumn("against", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))

    left = wide(guests, home_sizes).select("host", F.col("ring").alias("a"), F.col("other").alias("b"), F.col("block").alias("i"), F.col("against").alias("j"),
                                           F.lit(0).alias("side"), "rid", "copies", "v", "guest")
    right = wide(at_home, guest_sizes).select("host", F.col("other").alias("a"), F.col("ring").alias("b"), F.col("against").alias("i"), F.col("block").alias("j"),
                                              F.lit(1).alias("side"), "rid", "copies", "v", F.lit(None).cast("long").alias("guest"))
    key = ["host", "a", "b", "i", "j"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in groups(batches, key):
            side = g.column("side").to_numpy()
            ids, copies, v = g.column("rid").to_numpy(), g.column("copies").to_numpy(), g.column("v").to_pylist()
            lo, hi = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            x = unit(v)
            linked = x[lo] @ x[hi].T >= threshold
            from_ = g.column("guest").to_pylist()
            met = sorted({from_[k] for k in lo[linked.any(axis=1)]})
            n, host = len(lo) + len(hi), g.column("host")[0].as_py()
            yield pa.RecordBatch.from_arrays(
                [pa.array([*ids[lo].tolist(), *ids[hi].tolist(), *[None] * len(met)], pa.int64()),
                 pa.array([*(linked @ copies[hi]).tolist(), *(copies[lo] @ linked).tolist(), *[None] * len(met)], pa.int64()),
                 pa.array([None] * n + met, pa.int64()), pa.array([None] * n + [host] * len(met), pa.int64())], ["rid", "links", "a", "b"])

    rows = left.unionByName(right).repartition(*key).sortWithinPartitions(*key, "side")
    found = save(spark, rows.mapInArrow(count, "rid long, links long, a long, b long"), "nn-cross")
    counts = found.where("rid is not null and links > 0").groupBy("rid").agg(F.sum("links").alias("links"))
    return counts, found.where("a is not null").select("a", "b").distinct()


def orders_for(n: int) -> int:
    """Orders of the first set for labels of at most ``n`` vectors: a window holds an ever smaller share of a label."""
    return math.ceil(ORDERS * max(1.0, n / 4096) ** 0.25)


def audit(spark: SparkSession, vectors: DataFrame, counts: DataFrame, inside: DataFrame, threshold: float) -> float:
    """Mean share of its true links (against all rows) that ``counts`` (rid, links) gives a sampled vector.

    The lower one of two samples: of all vectors, and of those not ``inside`` (rid) crowded clusters.
    """
    own = vectors.select("rid", "label", "dim", "v")
    apart = save(spark, own.join(inside.select("rid"), "rid", "left_anti"), "nn-apart")
    samples = [hash_sample(rows, "rid", AUDIT).collect() for rows in (own, apart)]
    asked = {r["rid"]: (r["label"], r["dim"], bytes(r["v"])) for sample in samples for r in sample}
    if not asked:
        return 1.0
    by_kind: dict[tuple, list[int]] = {}
    for rid, (label, dim, _) in asked.items():
        by_kind.setdefault((label, dim), []).append(rid)
    shared = spark.sparkContext.broadcast({k: (np.array(q), unit([asked[i][2] for i in q])) for k, q in by_kind.items()})
    sure = threshold + 1e-9  # another order of the sums may put a link at the very threshold on either side

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {k: np.zeros(len(q), np.int64) for k, (q, _) in shared.value.items()}
        for b in batches:
            rid, label, dim, v, copies = (b.column(k).to_pylist() for k in range(5))
            rows: dict[tuple, list[int]] = {}
            for i, k in enumerate(zip(label, dim)):
                if k in total:
                    rows.setdefault(k, []).append(i)
            for k, at in rows.items():
                q, x = shared.value[k]
                linked = (x @ unit([v[i] for i in at]).T >= sure) & (q[:, None] != np.array([rid[i] for i in at]))
                total[k] += linked @ np.array([copies[i] for i in at])
        for k, n in total.items():
            used = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(shared.value[k][0][used], pa.int64()), pa.array(n[used])], ["rid", "n"])

    true = vectors.select("rid", "label", "dim", "v", "copies").mapInArrow(count, "rid long, n long").groupBy("rid").agg(F.sum("n").alias("n"))
    share = {r["rid"]: r["share"] for r in true.join(counts, "rid", "left").select(
        "rid", (F.least("n", F.coalesce("links", F.lit(0))) / F.col("n")).alias("share")).collect()}  # two samples at most
    shared.destroy()
    found = [[share[r["rid"]] for r in sample if r["rid"] in share] for sample in samples]
    return min([float(np.mean(x)) for x in found if x], default=1.0)


def near_duplicates(spark: SparkSession, embeddings: DataFrame, threshold: float = THRESHOLD, most: int = LIST) -> DataFrame:
    """(vec_id, n_links, component_id, kept, recall) for every row; recall is that of the last audit."""
    ready(spark)
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    rows = embeddings.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    usable = F.coalesce(F.col("label").isNotNull() & (F.size("embedding") > 0) & finite & some, F.lit(False))
    rows = rows.withColumn("usable", usable)
    vectors = packed(spark, rows)
    graph, recall, done = None, 1.0, 0
    orders = orders_for(vectors.groupBy("label", "dim").count().agg(F.max("count")).collect()[0][0] or 0)
    for k in range(AUDITS):
        graph = neighbour_graph(spark, vectors, range(done, done + orders), most, graph)
        done, orders = done + orders, 2 * orders
        sides = graph.where(F.col("cos") >= threshold)
        edges = save(spark, sides.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct(), "nn-edges")
        roots = components(spark, edges)
        full = sides.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= most).select(F.col("u").alias("node"))
        crowded = save(spark, roots.join(full, "node", "left_semi").select("root").distinct(), "nn-crowded")
        inside = save(spark, roots.join(crowded, "root", "left_semi").select(F.col("node").alias("rid"), "root"), "nn-inside")
        members = save(spark, vectors.select("rid", "label", "dim", "v", "copies").join(inside, "rid"), "nn-members")
        outside, touching = cross_links(spark, members, threshold)
        many = (cluster_counts(spark, members, threshold).unionByName(outside)
                .groupBy("rid").agg(F.sum("links").alias("links")))
        merged = components(spark, touching).select(F.col("node").alias("root"), F.col("root").alias("whole"))
        roots = save(spark, roots.join(merged, "root", "left").select("node", F.coalesce("whole", "root").alias("root")), "nn-roots")
        both = edges.select(F.col("a").alias("rid"), F.col("b").alias("other")).unionByName(edges.select(F.col("b").alias("rid"), F.col("a").alias("other")))
        few = (both.join(inside.select("rid"), "rid", "left_anti")
               .join(vectors.select(F.col("rid").alias("other"), "copies"), "other").groupBy("rid").agg(F.sum("copies").alias("links")))
        counts = save(spark, few.unionByName(many), "nn-counts")
        recall = audit(spark, vectors, counts, inside, threshold)
        if recall >= RECALL:
            break
    else:
        raise RuntimeError(f"recall {recall:.4f} after {done} orders, below {RECALL}")
    info = (vectors.select("rid", "label", "dim", "copies", "first_id").join(roots.withColumnRenamed("node", "rid"), "rid", "left")
            .join(counts, "rid", "left")
            .select("rid", F.coalesce("root", "rid").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "first_id"))
    info = save(spark, info, "nn-info")
    firsts = save(spark, info.groupBy("root").agg(F.min("first_id").alias("component_id")), "nn-firsts")
    by_rid = save(spark, info.join(firsts, "root").select("rid", "n_links", "component_id"), "nn-by-rid")
    reps = save(spark, vectors.join(by_rid, "rid").select("label", "v", "n_links", "component_id"), "nn-by-vector")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = [(np.array(x, "<f8") + 0.0).tobytes() if ok else None for x, ok in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(v, pa.binary())], ["vec_id", "label", "v"])

    kinds = dict(rows.dtypes)
    by_row = rows.mapInArrow(pack, f"vec_id {kinds['vec_id']}, label {kinds['label']}, v binary")
    # vectors that link with nothing have no packed form and find no partner
    joined = by_row.withColumn("__one", F.when(F.col("v").isNull(), F.monotonically_increasing_id()).otherwise(-1)).join(
        reps.withColumn("__one", F.lit(-1).cast("long")), ["label", "v", "__one"], "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                         F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"), F.lit(float(recall)).alias("audit_recall"))


def digest(spark: SparkSession, embeddings: DataFrame) -> DataFrame:
    """Contract columns: vec_id, n_links, component_id, kept; also audit_recall."""
    return near_duplicates(spark, embeddings)
