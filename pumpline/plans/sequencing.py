"""Ordered per-key computations that do not put a whole key in one task.

A plain ``Window.partitionBy(device).orderBy(ts)`` sends every row of a device
to one task; if one device holds a third of the data, that task holds a third
of the data.  The helpers here split each key further by a time bucket:

1. the row-level window runs over ``(key, bucket)`` partitions;
2. a per-``(key, bucket)`` summary (count, sum, last value) is aggregated; that
   table has one row per bucket, so its size is bounded by the time span, not
   by the row count;
3. a window over the summary gives each bucket what it needs from the buckets
   before it (offset, carried value), and is joined back on ``(key, bucket)``.

The big side is hash-partitioned by ``(key, bucket)`` once; the summary
aggregate and the join reuse that partitioning, so only the small summary is
shuffled again.  Results are exact for any bucket width.

Without keys there is one order over all rows.  Time buckets would then hold the
whole fleet's hour, so the buckets are cut by the rows themselves: range
partitions of the order, written to the shared folder with their number.

Null keys form a group of their own and null times come first (the bucket key is
a struct, whose fields compare null-safe), so no row is lost.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pumpline.functions.expressions import epoch_micros, epoch_seconds, time_bucket
from pumpline.session import work_path

B = "_pl_bkt"
K = "_pl_key"  # struct of the keys and the bucket: one null-safe column to partition, group and join by
UNB = Window.unboundedPreceding


def _orders(order: Sequence) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def _order_struct(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(o) for o in order])


def with_bucket(df: DataFrame, ts: str, width_s: int, keys: Sequence[str] = (), order: Sequence[str] | None = None) -> DataFrame:
    """``df`` with the bucket and the struct of keys and bucket.

    With keys the bucket is ``width_s`` seconds of time; without, it is the row's
    range partition in ``order``.
    """
    if keys or order is None:
        d = df.withColumn(B, time_bucket(ts, width_s))
    else:
        d = range_buckets(df, order)
    return d.withColumn(K, F.struct(*keys, B))


def range_buckets(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` written in range partitions of ``order``, each row with its partition's number.

    Equal order values stay together; the partitions are even whatever the
    distribution over time, and their number follows the session's shuffle
    settings and the adaptive sizes.  The numbers are read back from the files,
    so every later pass sees the same ones.
    """
    path = work_path(df.sparkSession, "ranges")
    (df.repartitionByRange(*order).withColumn(B, F.spark_partition_id().cast("long")).write.parquet(path))
    return df.sparkSession.read.parquet(path)


def _over(keys: Sequence[str]):
    """Window over bucket summaries (one row per bucket) in bucket order, per key."""
    return Window.partitionBy(*[F.col(K)[k] for k in keys]).orderBy(F.col(K)[B])


def sequence_number(df: DataFrame, keys: Sequence[str], order: Sequence[str], ts: str,
                    width_s: int, name: str = "seq") -> DataFrame:
    """1-based position of each row within its key in ``order``."""
    d = with_bucket(df, ts, width_s, keys, order)
    wb = Window.partitionBy(K).orderBy(*_orders(order))
    d = d.withColumn("_pl_rn", F.row_number().over(wb))
    counts = d.groupBy(K).agg(F.count(F.lit(1)).alias("_pl_n"))
    wk = _over(keys).rowsBetween(UNB, -1)
    offs = counts.select(K, F.coalesce(F.sum("_pl_n").over(wk), F.lit(0)).alias("_pl_off"))
    return (d.join(offs, K)
            .withColumn(name, (F.col("_pl_off") + F.col("_pl_rn")).cast("long"))
            .drop("_pl_off", "_pl_rn", B, K))


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], ts: str,
                width_s: int, value: str | Column, name: str) -> DataFrame:
    """Cumulative sum of ``value`` per key, current row included."""
    return running_sums(df, keys, order, ts, width_s, {name: F.col(value) if isinstance(value, str) else value})


def running_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str], ts: str,
                 width_s: int, values: dict[str, Column]) -> DataFrame:
    """Cumulative sums (output name -> value) per key in one pass, current row included."""
    d = with_bucket(df, ts, width_s, keys, order)
    inside = Window.partitionBy(K).orderBy(*_orders(order)).rowsBetween(UNB, 0)
    for n, v in values.items():
        d = d.withColumn(f"_pl_v_{n}", v)
    for n in values:
        d = d.withColumn(f"_pl_in_{n}", F.sum(f"_pl_v_{n}").over(inside))
    tot = d.groupBy(K).agg(*[F.sum(f"_pl_v_{n}").alias(f"_pl_t_{n}") for n in values])
    before = _over(keys).rowsBetween(UNB, -1)
    offs = tot.select(K, *[F.coalesce(F.sum(f"_pl_t_{n}").over(before), F.lit(0)).alias(f"_pl_off_{n}") for n in values])
    out = d.join(offs, K)
    for n in values:
        out = out.withColumn(n, F.col(f"_pl_off_{n}") + F.coalesce(F.col(f"_pl_in_{n}"), F.lit(0)))
    return out.drop(B, K, *[f"_pl_{x}_{n}" for n in values for x in ("v", "in", "off")])


def running_max(df: DataFrame, keys: Sequence[str], order: Sequence[str], ts: str, width_s: int, value: Column, name: str) -> DataFrame:
    """Largest ``value`` per key up to each row in ``order``, the row included."""
    d = with_bucket(df, ts, width_s, keys, order).withColumn("_pl_v", value)
    inside = Window.partitionBy(K).orderBy(*_orders(order)).rowsBetween(UNB, 0)
    d = d.withColumn("_pl_in", F.max("_pl_v").over(inside))
    tops = d.groupBy(K).agg(F.max("_pl_v").alias("_pl_t"))
    before = tops.select(K, F.max("_pl_t").over(_over(keys).rowsBetween(UNB, -1)).alias("_pl_before"))
    return d.join(before, K).withColumn(name, F.greatest("_pl_in", "_pl_before")).drop("_pl_v", "_pl_in", "_pl_before", B, K)


def carry_last(df: DataFrame, keys: Sequence[str], order: Sequence[str], ts: str,
               width_s: int, cols: Sequence[str], include_current: bool = True,
               suffix: str = "_asof") -> DataFrame:
    """Last non-null value of each column at (or before) every row: an as-of lookup."""
    d = with_bucket(df, ts, width_s, keys, order)
    frame = Window.partitionBy(K).orderBy(*_orders(order)).rowsBetween(UNB, 0 if include_current else -1)
    for c in cols:
        d = d.withColumn(f"_pl_in_{c}", F.last(F.col(c), ignorenulls=True).over(frame))
    ordk = _order_struct(order)
    last_b = d.groupBy(K).agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), ordk)).alias(f"_pl_bl_{c}") for c in cols])
    wk = _over(keys).rowsBetween(UNB, -1)
    carry = last_b.select(K, *[F.last(f"_pl_bl_{c}", ignorenulls=True).over(wk).alias(f"_pl_ci_{c}")
                                      for c in cols])
    out = d.join(carry, K)
    for c in cols:
        out = out.withColumn(f"{c}{suffix}", F.coalesce(F.col(f"_pl_in_{c}"), F.col(f"_pl_ci_{c}")))
    return out.drop(B, K, *[f"_pl_in_{c}" for c in cols], *[f"_pl_ci_{c}" for c in cols])


def neighbor_value(df: DataFrame, keys: Sequence[str], order: Sequence[str], ts: str,
                   width_s: int, c: str, name: str, direction: str = "prev") -> DataFrame:
    """``lag(c)`` (direction='prev') or ``lead(c)`` ('next') per key, across buckets."""
    d = with_bucket(df, ts, width_s, keys, order)
    wb = Window.partitionBy(K).orderBy(*_orders(order))
    ordk = _order_struct(order)
    if direction == "prev":
        d = d.withColumn("_pl_nb", F.lag(c).over(wb)).withColumn("_pl_edge", F.row_number().over(wb) == 1)
        edge = d.groupBy(K).agg(F.max_by(F.col(c), ordk).alias("_pl_e"))
        carry = edge.select(K, F.lag("_pl_e").over(_over(keys)).alias("_pl_ci"))
    else:
        wd = Window.partitionBy(K).orderBy(*[o.desc() for o in _orders(order)])
        d = d.withColumn("_pl_nb", F.lead(c).over(wb)).withColumn("_pl_edge", F.row_number().over(wd) == 1)
        edge = d.groupBy(K).agg(F.min_by(F.col(c), ordk).alias("_pl_e"))
        carry = edge.select(K, F.lead("_pl_e").over(_over(keys)).alias("_pl_ci"))
    return (d.join(carry, K)
            .withColumn(name, F.when(F.col("_pl_edge"), F.col("_pl_ci")).otherwise(F.col("_pl_nb")))
            .drop("_pl_nb", "_pl_edge", "_pl_ci", B, K))


def ordered_context(df: DataFrame, keys: Sequence[str], order: Sequence[str], ts: str, width_s: int,
                    seq: str | None = None, prev: dict[str, str] | None = None,
                    nxt: dict[str, str] | None = None) -> DataFrame:
    """Sequence number, previous and next values per key from one pass.

    ``prev`` / ``nxt`` map a source column to the output name.  One window over
    ``(key, bucket)``, one bucket summary (count, first and last values) and one
    join replace separate ``sequence_number`` / ``neighbor_value`` passes.
    """
    prev, nxt = dict(prev or {}), dict(nxt or {})
    d = with_bucket(df, ts, width_s, keys, order)
    wb = Window.partitionBy(K).orderBy(*_orders(order))
    d = d.withColumn("_pl_rn", F.row_number().over(wb)) \
         .withColumn("_pl_cnt", F.count(F.lit(1)).over(Window.partitionBy(K)))
    for c, name in prev.items():
        d = d.withColumn(f"_pl_lag_{name}", F.lag(c).over(wb))
    for c, name in nxt.items():
        d = d.withColumn(f"_pl_lead_{name}", F.lead(c).over(wb))
    ordk = _order_struct(order)
    summ = d.groupBy(K).agg(
        F.count(F.lit(1)).alias("_pl_n"),
        *[F.max_by(F.col(c), ordk).alias(f"_pl_last_{n}") for c, n in prev.items()],
        *[F.min_by(F.col(c), ordk).alias(f"_pl_first_{n}") for c, n in nxt.items()])
    wk = _over(keys)
    carry = summ.select(
        K, F.coalesce(F.sum("_pl_n").over(wk.rowsBetween(UNB, -1)), F.lit(0)).alias("_pl_off"),
        *[F.lag(f"_pl_last_{n}").over(wk).alias(f"_pl_pc_{n}") for n in prev.values()],
        *[F.lead(f"_pl_first_{n}").over(wk).alias(f"_pl_nc_{n}") for n in nxt.values()])
    out = d.join(carry, K)
    if seq:
        out = out.withColumn(seq, (F.col("_pl_off") + F.col("_pl_rn")).cast("long"))
    for n in prev.values():
        out = out.withColumn(n, F.when(F.col("_pl_rn") == 1, F.col(f"_pl_pc_{n}")).otherwise(F.col(f"_pl_lag_{n}")))
    for n in nxt.values():
        out = out.withColumn(n, F.when(F.col("_pl_rn") == F.col("_pl_cnt"), F.col(f"_pl_nc_{n}"))
                             .otherwise(F.col(f"_pl_lead_{n}")))
    drop = ["_pl_rn", "_pl_cnt", "_pl_off", B, K, *[f"_pl_lag_{n}" for n in prev.values()],
            *[f"_pl_pc_{n}" for n in prev.values()], *[f"_pl_lead_{n}" for n in nxt.values()],
            *[f"_pl_nc_{n}" for n in nxt.values()]]
    return out.drop(*drop)


def trailing_sum(df: DataFrame, keys: Sequence[str], ts: str, value: str | Column,
                 horizon_s: int, width_s: int, name: str) -> DataFrame:
    """Sum of ``value`` over rows with ``ts - horizon <= ts' <= ts`` per key (null times among themselves).

    Buckets are at least one horizon wide, so a row only needs the tail of the
    previous bucket; those rows (non-zero values only) are copied in as context
    and dropped after the window (one pass: an ``explode`` emits the copy).  At
    most one extra copy per contributing row.  Without keys see ``trailing_sum_all``.
    """
    v = F.col(value) if isinstance(value, str) else value
    if not keys:
        return trailing_sum_all(df, ts, v, horizon_s, name)
    width = max(int(width_s), int(horizon_s))
    d = with_bucket(df, ts, width, keys).withColumn("_pl_v", v).withColumn("_pl_us", epoch_micros(ts))
    # one pass: a contributing row near the end of its bucket is emitted twice,
    # the copy lands in the next bucket as context
    near_end = (F.col("_pl_v") != 0) & (epoch_seconds(ts) >= (F.col(B) + 1) * width - int(horizon_s) - 1)
    d = (d.withColumn("_pl_copy", F.explode(F.when(near_end, F.array(F.lit(0), F.lit(1)))
                                             .otherwise(F.array(F.lit(0)))))
          .withColumn(B, F.col(B) + F.col("_pl_copy")).withColumn("_pl_ctx", F.col("_pl_copy") == 1)
          .withColumn(K, F.struct(*keys, B)))
    w = (Window.partitionBy(K).orderBy("_pl_us")
         .rangeBetween(-int(horizon_s) * 1_000_000, 0))
    return (d.drop("_pl_copy")
            .withColumn(name, F.coalesce(F.sum("_pl_v").over(w), F.lit(0)))
            .filter(~F.col("_pl_ctx"))
            .drop("_pl_v", "_pl_us", "_pl_ctx", B, K))


def trailing_sum_all(df: DataFrame, ts: str, value: Column, horizon_s: int, name: str) -> DataFrame:
    """``trailing_sum`` over all rows as one stream: a difference of two running sums.

    The values are added up per instant (one row each, combined before the
    shuffle) and every row asks for the running sum at its own instant and just
    before its horizon.  Questions and values share one order, cut into range
    buckets, so no task holds a stretch of time, however many rows it has.
    """
    d = df.withColumn("_pl_us", epoch_micros(ts))
    span = int(horizon_s) * 1_000_000
    values = d.groupBy("_pl_us").agg(F.sum(value).alias("_pl_v"))
    # at one instant: questions about what lies before it, its values, questions about what is up to it
    asked = d.select("_pl_us").distinct()
    lo = asked.select((F.col("_pl_us") - span).alias("at"), F.lit(0).alias("phase"), F.col("_pl_us").alias("of"), F.lit(0).alias("_pl_v"))
    mid = values.select(F.col("_pl_us").alias("at"), F.lit(1).alias("phase"), F.lit(None).cast("long").alias("of"), F.coalesce("_pl_v", F.lit(0)).alias("_pl_v"))
    hi = asked.select(F.col("_pl_us").alias("at"), F.lit(2).alias("phase"), F.col("_pl_us").alias("of"), F.lit(0).alias("_pl_v"))
    line = range_buckets(lo.unionByName(mid).unionByName(hi), ["at", "phase"])
    inside = Window.partitionBy(B).orderBy("at", "phase").rowsBetween(UNB, 0)
    run = line.withColumn("_pl_in", F.sum("_pl_v").over(inside))
    total = line.groupBy(B).agg(F.sum("_pl_v").alias("_pl_t"))
    offs = total.select(B, F.coalesce(F.sum("_pl_t").over(Window.orderBy(B).rowsBetween(UNB, -1)), F.lit(0)).alias("_pl_off"))
    known = (run.where("phase <> 1").join(offs, B).withColumn("_pl_c", F.col("_pl_off") + F.col("_pl_in"))
             .groupBy("of").agg(F.sum(F.when(F.col("phase") == 2, F.col("_pl_c")).otherwise(-F.col("_pl_c"))).alias("_pl_sum")))
    # rows without a time count among themselves
    known = known.select(F.struct(F.col("of").alias("us")).alias(K), F.col("_pl_sum").alias(name))
    return d.withColumn(K, F.struct(F.col("_pl_us").alias("us"))).join(known, K).drop(K, "_pl_us")


def rolling_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], ts: str,
                 width_s: int, n_rows: int, aggs: dict[str, Column],
                 chunk_rows: int = 1_000_000) -> DataFrame:
    """Aggregates over the last ``n_rows`` rows (current included) per key.

    Rows get a global sequence number, are cut into chunks of ``chunk_rows``,
    and the last ``n_rows - 1`` rows of each chunk are copied into the next one
    as context, so a hot key becomes many independent chunks.
    """
    size = max(int(chunk_rows), int(n_rows))
    s = sequence_number(df, keys, order, ts, width_s, "_pl_seq")
    tail = ((F.col("_pl_seq") - 1) % size) >= size - (n_rows - 1) if n_rows > 1 else F.lit(False)
    # one pass: the last n_rows - 1 rows of a chunk are also emitted into the next chunk
    u = (s.withColumn("_pl_copy", F.explode(F.when(tail, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
          .withColumn("_pl_chunk", F.floor((F.col("_pl_seq") - 1) / size) + F.col("_pl_copy"))
          .withColumn("_pl_ctx", F.col("_pl_copy") == 1).drop("_pl_copy"))
    w = Window.partitionBy(*keys, "_pl_chunk").orderBy("_pl_seq").rowsBetween(-(n_rows - 1), 0)
    for name, agg in aggs.items():
        u = u.withColumn(name, agg.over(w))
    return u.filter(~F.col("_pl_ctx")).drop("_pl_chunk", "_pl_ctx", "_pl_seq")
