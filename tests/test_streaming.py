"""Streaming semantics that the catalogue's in-order replays cannot show."""

from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import functions as F

from pumpline.config import DEFAULT_PARAMS as D
from pumpline.session import work_path
from pumpline.streaming import pipelines as S
from pumpline.streaming.replay import Replay, replay, source

SCHEMA = "event_id long, device_id long, ts timestamp_ntz, pred double, s04 double, s10 double"
T0 = datetime(2024, 1, 10)


def _append(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_late_rows_behind_the_watermark_are_dropped(spark):
    src, out, ck = work_path(spark, "late_src"), work_path(spark, "late_out"), work_path(spark, "late_ck")
    rp = Replay(src, spark.createDataFrame([], SCHEMA).schema, 1, "1 hour", 3600)
    _append(spark, src, [(1, 7, T0, 0.0, 1.0, 1.0), (2, 7, T0 + timedelta(days=2), 0.0, 1.0, 1.0)])
    S.run_foreach_batch(S.daily_counts_stream(source(spark, rp), rp.delay), out, ck)
    # a row for a day long behind the watermark, and one inside the open window
    _append(spark, src, [(3, 7, T0, 0.0, 1.0, 1.0), (4, 7, T0 + timedelta(days=2, hours=1), 0.0, 1.0, 1.0)])
    S.run_foreach_batch(S.daily_counts_stream(source(spark, rp), rp.delay), out, ck)
    got = {str(r.day): r.n_rows for r in S.latest_per_key(spark, out, ["device_id", "day"]).collect()}
    assert got == {"2024-01-10": 1, "2024-01-12": 2}


def test_exact_recent_alerts_state_survives_restart(spark):
    src, out, ck = work_path(spark, "rec_src"), work_path(spark, "rec_out"), work_path(spark, "rec_ck")
    rp = Replay(src, spark.createDataFrame([], SCHEMA).schema, 1, "1 hour", 3600)
    from pumpline.config import DEFAULT_PARAMS as D
    _append(spark, src, [(1, 7, T0, 1.0, 1.0, 1.0), (2, 7, T0 + timedelta(seconds=200), 1.0, 1.0, 1.0)])
    S.run_to_files(S.recent_alerts_exact_stream(source(spark, rp), D), out, ck)
    # new query run on the same checkpoint: what waits and the alert times come back from the state store
    _append(spark, src, [(4, 7, T0 + timedelta(seconds=501), 0.0, 1.0, 1.0)])
    _append(spark, src, [(3, 7, T0 + timedelta(seconds=300), 0.0, 1.0, 1.0)])  # arrives after a younger row
    _append(spark, src, [(None, None, T0 + timedelta(hours=3), None, None, None)])  # moves the watermark
    S.run_to_files(S.recent_alerts_exact_stream(source(spark, rp), D), out, ck)
    rows = spark.read.parquet(out).collect()
    assert {r.event_id: r.recent_alerts for r in rows if r.event_id} == {1: 1, 2: 2, 3: 2, 4: 0}
    # the count falls without new rows, one microsecond after an alert is 300 s old
    assert sorted((r.ts, r.recent_alerts) for r in rows if not r.event_id) == [
        (T0 + timedelta(seconds=300, microseconds=1), 1), (T0 + timedelta(seconds=500, microseconds=1), 0)]


def test_rows_behind_the_watermark_do_not_disturb_the_state(spark):
    src, out, ck = work_path(spark, "st_src"), work_path(spark, "st_out"), work_path(spark, "st_ck")
    schema = "device_id long, ts timestamp_ntz, event_id long, _kind int, source string, online boolean, pred double, s04 double, s10 double"
    rp = Replay(src, spark.createDataFrame([], schema).schema, 1, "1 minute", 60)

    def add(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(src)

    add((1, T0 + timedelta(seconds=5), 1, 1, None, None, 0.0, 1.0, 1.0), (1, T0, 2, 0, "speed", False, None, None, None))
    add((None, T0 + timedelta(hours=1), None, None, None, None, None, None, None))
    add((None, T0 + timedelta(hours=1, seconds=1), None, None, None, None, None, None, None))
    add((1, T0 + timedelta(seconds=1), 3, 0, "speed", True, None, None, None))  # late: would have made it NORMAL
    add((1, T0 + timedelta(hours=2), 4, 1, None, None, 0.0, 1.0, 1.0))
    add((None, T0 + timedelta(hours=4), None, None, None, None, None, None, None))
    S.run_to_files(S.device_state_stream(source(spark, rp), delay=rp.delay), out, ck)
    assert {r.event_id: r.state for r in spark.read.parquet(out).collect()} == {1: "INTERRUPTED", 4: "INTERRUPTED"}


def test_periodic_trigger_runs_until_stopped(spark):
    from pumpline.operators import monitor
    src, out, ck = work_path(spark, "per_src"), work_path(spark, "per_out"), work_path(spark, "per_ck")
    rp = Replay(src, spark.createDataFrame([], SCHEMA).schema, 1, "1 hour", 3600)
    _append(spark, src, [(1, 7, T0, 0.0, 1.0, 1.0), (2, 7, T0, 1.0, 1.0, 1.0)])
    q = S.run_foreach_batch(monitor.macro_counts(source(spark, rp)), out, ck, mode="complete",
                            trigger={"processingTime": "1 second"})
    try:
        q.processAllAvailable()
        assert q.isActive
    finally:
        q.stop()
    r = S.latest_per_key(spark, out, ["device_id"]).first()
    assert (r.normal, r.anomaly) == (1, 1)


def test_conflate_batches_one_refresh_per_device_and_batch(spark):
    src, out, ck = work_path(spark, "cf_src"), work_path(spark, "cf_out"), work_path(spark, "cf_ck")
    rp = Replay(src, spark.createDataFrame([], SCHEMA).schema, 1, "1 hour", 3600)
    _append(spark, src, [(1, 7, T0, 0.0, 1.0, 1.0), (2, 7, T0 + timedelta(seconds=5), 1.0, 2.0, 2.0),
                         (3, 8, T0, 0.0, 3.0, 3.0)])
    _append(spark, src, [(4, 7, T0 + timedelta(seconds=9), 0.0, 4.0, 4.0)])
    (source(spark, rp).writeStream.foreachBatch(S.conflate_batches(out)).option("checkpointLocation", ck)
     .trigger(availableNow=True).start().awaitTermination())
    got = sorted((r.batch, r.device_id, r.event_id) for r in spark.read.parquet(out).collect())
    assert got == [(0, 7, 2), (0, 8, 3), (1, 7, 4)]


def _odd_devices(df):
    """Some rows without a device, some of a device that is called -1."""
    from pyspark.sql import functions as F

    dev = F.when(F.col("event_id") % 5 == 0, F.lit(None)).when(F.col("event_id") % 5 == 1, F.lit(-1)).otherwise(F.col("device_id") % 3)
    return df.withColumn("device_id", dev.cast("long"))


def _drained(spark, df, build, name, end_after_s, run=S.run_to_files):
    from pumpline.streaming.replay import replay

    rp = replay(spark, df, work_path(spark, f"{name}_src"), 3, key="event_id", end_after_s=end_after_s)
    out = work_path(spark, f"{name}_out")
    run(build(source(spark, rp), rp.delay), out, work_path(spark, f"{name}_ck"))
    return out


def _rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


SF = "/root/testdata/sf0.001"


def test_rows_without_a_device_are_one_more_device(spark):
    """The ordered streams agree with the batch forms for null devices and a device -1."""
    from pumpline.config import TESTDATA_PARAMS as P
    from pumpline.operators import eventlog, monitor
    from pumpline.sources import testdata as td
    from pyspark.sql import functions as F

    samples = _odd_devices(monitor.valid_samples(td.sample_readings(spark, SF)))
    status, presses = _odd_devices(td.source_status(spark, SF)), _odd_devices(td.mute_toggles(spark, SF))
    out = _drained(spark, S.mixed_feed(samples, status), lambda s, d: S.device_state_stream(s, P, d), "odd_state", 60)
    cols = ("event_id", "device_id", "online_asof", "state")
    got, want = _rows(spark.read.parquet(out), *cols), _rows(monitor.device_state(samples, status, P), *cols)
    assert {r[1] for r in got} == {None, -1, 0, 1, 2} and got == want

    out = _drained(spark, S.mixed_feed(samples, status, None), lambda s, d: S.counters_stream(s, P, d), "odd_count", 60, S.run_foreach_batch)
    last = spark.read.parquet(out).groupBy("device_id").agg(F.max_by(F.struct("session_alerts", "total_reconnects"), "batch").alias("c"))
    alerts = samples.groupBy("device_id").agg(F.count_if(F.col("pred") == 1.0).alias("n"))
    assert _rows(last, "device_id", "c.session_alerts") == _rows(alerts, "device_id", "n")
    assert {r for r in _rows(monitor.reconnect_count(status, P), "device_id", "total_reconnects") if r[1]} == {
        r for r in _rows(last, "device_id", "c.total_reconnects") if r[1]}

    out = _drained(spark, samples, lambda s, d: S.recent_alerts_exact_stream(s, P, d), "odd_recent", 2 * P.recent_horizon_s)
    cols = ("event_id", "device_id", "recent_alerts")
    assert _rows(spark.read.parquet(out).filter("event_id IS NOT NULL"), *cols) == _rows(monitor.recent_alerts(samples, P), *cols)

    out = _drained(spark, presses, lambda s, d: S.mute_windows_stream(s, P, d), "odd_mute", 2 * P.mute_s)
    cols = ("device_id", "start_ts", "end_ts")
    assert _rows(spark.read.parquet(out), *cols) == _rows(eventlog.windows_only(eventlog.mute_windows(presses, P)), *cols)

    feed = _odd_devices(td.monitor_feed(spark, SF))
    out = _drained(spark, feed, lambda s, d: S.event_log_stream(s, P, d), "odd_log", 60)
    cols = ("device_id", "ts", "seq", "event_id", "tag", "level", "message", "normal", "anomaly", "muted", "line")
    assert _rows(spark.read.parquet(out), *cols) == _rows(eventlog.event_log(feed, P), *cols)


def test_state_calls_follow_the_groups_not_the_devices(spark):
    from pyspark.sql import types as T
    rows = spark.range(4000).select((F.col("id") % 500).alias("device_id"), F.lit(T0).alias("t0"), F.col("id").alias("event_id"))
    rows = rows.select("device_id", (F.col("t0").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("event_id"))).alias("ts"), "event_id")
    rp = replay(spark, rows, work_path(spark, "groups_src"), 3, key="event_id", end_after_s=60)

    def fold(rows, folded, passed):
        for dev in S._devices(rows) if len(rows) else ():
            folded[dev] = folded.get(dev, 0) + 1
        return pd.DataFrame({"devices": [len(folded)], "n_rows": [len(rows)]}), None

    out = T.StructType([T.StructField("devices", T.LongType()), T.StructField("n_rows", T.LongType())])
    path, ck = work_path(spark, "groups_out"), work_path(spark, "groups_ck")
    S.run_to_files(S.ordered(source(spark, rp), fold, ["_us", "event_id"], out, rp.delay, groups=4), path, ck)
    calls = spark.read.parquet(path).collect()
    assert sum(c.n_rows for c in calls) == 4000
    assert len(calls) < 40 and max(c.devices for c in calls) > 60


def test_ids_keep_their_digits_next_to_nulls(spark):
    big = 2**53 + 1
    rows = [(big, T0, big, True), (big + 2, T0, None, False), (None, T0, big + 4, False)]
    status = spark.createDataFrame(rows, "device_id long, ts timestamp_ntz, event_id long, online boolean").withColumn("source", F.lit("speed"))
    samples = spark.createDataFrame([(d, t + timedelta(seconds=1), e, 0.0, 1.0, 2.0) for d, t, e, _ in rows],
                                    "device_id long, ts timestamp_ntz, event_id long, pred double, s04 double, s10 double")
    rp = replay(spark, S.mixed_feed(samples, status), work_path(spark, "big_src"), 1, key="event_id", end_after_s=60)
    path, ck = work_path(spark, "big_out"), work_path(spark, "big_ck")
    S.run_to_files(S.device_state_stream(source(spark, rp), D, rp.delay), path, ck)
    got = {(r.device_id, r.event_id, r.online_asof) for r in spark.read.parquet(path).collect()}
    assert got == {(d, e, on) for d, _, e, on in rows}


def test_replay_computes_its_input_once(spark):
    done = spark.sparkContext.accumulator(0)

    def seen(x):
        done.add(1)
        return x

    rows = spark.range(0, 100, 1, 2).select("id", F.udf(seen, "long")("id").alias("event_id"))
    rows = rows.select("event_id", (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("event_id"))).alias("ts"))
    rp = replay(spark, rows, work_path(spark, "once"), 4, key="event_id")
    assert spark.read.parquet(rp.path).count() == 100 and done.value == 100


def test_counters_and_recent_alerts_keep_a_state_per_group(spark):
    n = 700  # devices, more than there are groups
    sec = F.floor(F.col("id") / n).cast("int")
    samples = spark.range(2 * n).select((F.col("id") % n).alias("device_id"), F.col("id").alias("event_id"),
                                        (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(secs=sec)).alias("ts"),
                                        F.lit(float(D.alert_pred)).alias("pred"), F.lit(1.0).alias("s04"), F.lit(1.0).alias("s10"))
    status = spark.createDataFrame([], "device_id long, ts timestamp_ntz, event_id long, source string, online boolean")

    def drained(rows, stream, run, name, tail):
        rp = replay(spark, rows, work_path(spark, f"{name}_src"), 1, key="event_id", end_after_s=tail)
        path, ck = work_path(spark, f"{name}_out"), work_path(spark, f"{name}_ck")
        q = run(stream(source(spark, rp), D, rp.delay), path, ck)
        held = max(x["stateOperators"][0]["numRowsTotal"] for x in q.recentProgress if x["stateOperators"])
        assert 0 < held < n
        return path

    path = drained(S.mixed_feed(samples, status, None), S.counters_stream, S.run_foreach_batch, "many_counters", 60)
    got = S.latest_per_key(spark, path, ["device_id"]).collect()
    assert sorted((r.device_id, r.session_alerts, r.total_reconnects) for r in got) == [(d, 2, 0) for d in range(n)]
    path = drained(samples, S.recent_alerts_exact_stream, S.run_to_files, "many_recent", 2 * D.recent_horizon_s)
    got = spark.read.parquet(path).where("event_id is not null").collect()
    assert sorted((r.event_id, r.recent_alerts) for r in got) == [(e, 1 + e // n) for e in range(2 * n)]
