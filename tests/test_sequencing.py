"""The bucketed per-key helpers equal plain device-wide windows, for any bucket width."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pumpline.plans import sequencing as Q


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(7)
    rows = []
    base = datetime(2024, 1, 1)
    eid = 0
    for dev in range(5):
        n = 400 if dev == 0 else rnd.randint(0, 40)   # device 0 is the hot key
        t = base
        for _ in range(n):
            t += timedelta(seconds=rnd.choice([0, 1, 30, 299, 300, 301, 4000]))
            v = rnd.choice([None, 0, 1, 2])
            rows.append((eid, dev, t, v, rnd.choice([True, False, None])))
            eid += 1
    return spark.createDataFrame(rows, "event_id long, device_id long, ts timestamp_ntz, v long, b boolean")


def _collect(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.mark.parametrize("width", [60, 3600, 10 ** 9])
def test_sequence_number(spark, data, width):
    got = Q.sequence_number(data, ["device_id"], ["ts", "event_id"], "ts", width, "seq")
    w = Window.partitionBy("device_id").orderBy("ts", "event_id")
    exp = data.withColumn("seq", F.row_number().over(w).cast("long"))
    assert _collect(got, ["event_id", "seq"]) == _collect(exp, ["event_id", "seq"])


@pytest.mark.parametrize("width", [60, 3600])
def test_running_sum(spark, data, width):
    got = Q.running_sum(data, ["device_id"], ["ts", "event_id"], "ts", width, F.coalesce("v", F.lit(0)), "s")
    w = Window.partitionBy("device_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    exp = data.withColumn("s", F.sum(F.coalesce("v", F.lit(0))).over(w))
    assert _collect(got, ["event_id", "s"]) == _collect(exp, ["event_id", "s"])


@pytest.mark.parametrize("width", [60, 3600])
def test_carry_last(spark, data, width):
    got = Q.carry_last(data, ["device_id"], ["ts", "event_id"], "ts", width, ["v", "b"])
    w = Window.partitionBy("device_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    exp = data.withColumn("v_asof", F.last("v", True).over(w)).withColumn("b_asof", F.last("b", True).over(w))
    assert _collect(got, ["event_id", "v_asof", "b_asof"]) == _collect(exp, ["event_id", "v_asof", "b_asof"])


@pytest.mark.parametrize("direction", ["prev", "next"])
@pytest.mark.parametrize("width", [60, 3600])
def test_neighbor_value(spark, data, width, direction):
    got = Q.neighbor_value(data, ["device_id"], ["ts", "event_id"], "ts", width, "v", "nb", direction)
    w = Window.partitionBy("device_id").orderBy("ts", "event_id")
    f = F.lag("v") if direction == "prev" else F.lead("v")
    exp = data.withColumn("nb", f.over(w))
    assert _collect(got, ["event_id", "nb"]) == _collect(exp, ["event_id", "nb"])


@pytest.mark.parametrize("width", [1, 300, 3600])
def test_trailing_sum_inclusive_edge(spark, data, width):
    got = Q.trailing_sum(data, ["device_id"], "ts", F.coalesce("v", F.lit(0)), 300, width, "t")
    exp = data.withColumn("_v", F.coalesce("v", F.lit(0))).withColumn(
        "t", F.expr("sum(_v) over (partition by device_id order by ts "
                    "range between interval 300 seconds preceding and current row)"))
    assert _collect(got, ["event_id", "t"]) == _collect(exp, ["event_id", "t"])


@pytest.mark.parametrize("chunk", [80, 100, 1000])
def test_rolling_rows(spark, data, chunk):
    got = Q.rolling_rows(data, ["device_id"], ["ts", "event_id"], "ts", 600, 80,
                         {"c": F.count(F.lit(1)), "s": F.sum("v")}, chunk_rows=chunk)
    w = Window.partitionBy("device_id").orderBy("ts", "event_id").rowsBetween(-79, 0)
    exp = data.withColumn("c", F.count(F.lit(1)).over(w)).withColumn("s", F.sum("v").over(w))
    assert _collect(got, ["event_id", "c", "s"]) == _collect(exp, ["event_id", "c", "s"])


def test_partition_invariance(spark, data):
    a = Q.running_sum(data.repartition(1), ["device_id"], ["ts", "event_id"], "ts", 60, F.coalesce("v", F.lit(0)), "s")
    b = Q.running_sum(data.repartition(7), ["device_id"], ["ts", "event_id"], "ts", 60, F.coalesce("v", F.lit(0)), "s")
    assert _collect(a, ["event_id", "s"]) == _collect(b, ["event_id", "s"])


@pytest.mark.parametrize("width", [60, 3600])
def test_ordered_context(spark, data, width):
    got = Q.ordered_context(data, ["device_id"], ["ts", "event_id"], "ts", width, seq="seq",
                            prev={"v": "pv", "b": "pb"}, nxt={"v": "nv"})
    w = Window.partitionBy("device_id").orderBy("ts", "event_id")
    exp = (data.withColumn("seq", F.row_number().over(w).cast("long")).withColumn("pv", F.lag("v").over(w))
               .withColumn("pb", F.lag("b").over(w)).withColumn("nv", F.lead("v").over(w)))
    cols = ["event_id", "seq", "pv", "pb", "nv"]
    assert _collect(got, cols) == _collect(exp, cols)


def test_hot_key_is_spread_over_partitions(spark):
    """A device with 40 % of the rows: the plain window keeps all of them in one
    partition, the bucketed helper spreads them."""
    from datetime import datetime, timedelta
    base = datetime(2024, 1, 1)
    rows = [(i, 0 if i % 5 < 2 else 1 + i % 97, base + timedelta(minutes=7 * i), i % 3) for i in range(20000)]
    df = spark.createDataFrame(rows, "event_id long, device_id long, ts timestamp_ntz, v long")
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        w = Window.partitionBy("device_id").orderBy("ts", "event_id")
        plain = df.withColumn("x", F.last("v").over(w)).filter("device_id = 0")
        split = Q.carry_last(df, ["device_id"], ["ts", "event_id"], "ts", 3600, ["v"]).filter("device_id = 0")
        # keep the window's output column, or column pruning removes the window
        n_plain = len(plain.groupBy(F.spark_partition_id().alias("p")).agg(F.max("x")).collect())
        parts = split.groupBy(F.spark_partition_id().alias("p")).agg(
            F.count(F.lit(1)).alias("count"), F.max("v_asof")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    hot = sum(r["count"] for r in parts)
    assert n_plain == 1
    assert len(parts) >= 6 and max(r["count"] for r in parts) < 0.3 * hot


def test_null_keys_and_times_are_kept(spark):
    from datetime import datetime, timedelta

    from pumpline.config import DEFAULT_PARAMS as D
    from pumpline.operators import monitor
    t0 = datetime(2024, 1, 1)
    rows = [(1, 1, t0, 1.0), (2, None, t0, 1.0), (3, None, t0 + timedelta(hours=5), 1.0), (4, 1, None, 1.0), (5, 1, t0 + timedelta(hours=5), 1.0)]
    df = spark.createDataFrame(rows, "event_id long, device_id long, ts timestamp_ntz, pred double")
    assert {r.event_id: r.session_alerts for r in monitor.session_alerts(df, D).collect()} == {4: 1, 1: 2, 5: 3, 2: 1, 3: 2}
    assert {r.event_id: r.recent_alerts for r in monitor.recent_alerts(df, D).collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1}
    assert {r.event_id: r.recent_alerts for r in monitor.recent_alerts(df, D, by=()).collect()} == {1: 2, 2: 2, 3: 2, 4: 1, 5: 2}
    assert {r.event_id: r.session_alerts for r in monitor.session_alerts(df, D, by=()).collect()}[4] == 1
    d = df.withColumn("poll_key", F.lit("k"))
    assert sorted(r.event_id for r in monitor.dedupe_consecutive(d, "poll_key", D).collect()) == [2, 4]


def test_a_hot_hour_is_spread_without_keys(spark):
    """90 % of the rows in one hour: no range bucket holds more than a set share."""
    from datetime import datetime, timedelta

    from pumpline.plans import sequencing as Q
    t0 = datetime(2024, 1, 1)
    rows = [(i, t0 + (timedelta(milliseconds=i) if i % 10 else timedelta(days=i // 100))) for i in range(8000)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in Q.with_bucket(df, "ts", 3600, (), ["ts", "event_id"]).groupBy(Q.B).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 8000 and max(sizes) < 0.25 * 8000


def test_trailing_sum_without_keys_matches_brute_force(spark):
    import random
    from datetime import datetime, timedelta

    from pumpline.plans import sequencing as Q
    rnd, t0 = random.Random(1), datetime(2024, 1, 1)
    rows = [(i, t0 + timedelta(seconds=rnd.randint(0, 400)), rnd.randint(0, 2)) for i in range(300)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, v long")
    got = {r.event_id: r.s for r in Q.trailing_sum(df, [], "ts", "v", 60, 60, "s").collect()}
    for i, t, _ in rows:
        assert got[i] == sum(v for _, u, v in rows if t - timedelta(seconds=60) <= u <= t)
