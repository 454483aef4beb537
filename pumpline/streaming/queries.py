"""Streaming entries of the query catalogue.

Each query replays a view derived from the driver tables as a time-sliced
file stream, runs the streaming operator with ``availableNow`` into a sink in
the shared folder, and returns the sink's final content.  Where the answer
does not depend on batch boundaries the oracle is the batch SQL.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pumpline.config import TESTDATA_PARAMS as P
from pumpline.functions import expressions as X
from pumpline.operators import eventlog, ml, monitor
from pumpline.plans import oracles as O
from pumpline.session import work_path
from pumpline.sources import polling, testdata as td, wide
from pumpline.streaming import pipelines as S, supervisor
from pumpline.streaming.replay import replay, source

N_SLICES = 4


def _replayed(spark: SparkSession, df: DataFrame, name: str, key: str = "device_id", **how) -> tuple[DataFrame, str]:
    rp = replay(spark, df, work_path(spark, f"replay_{name}"), N_SLICES, key=key, **how)
    return source(spark, rp), rp.delay


def _dirs(spark, name):
    return work_path(spark, f"{name}_out"), work_path(spark, f"{name}_ckpt")


def _written(spark, stream, name, run=S.run_to_files):
    """Drain ``stream`` into files and read them."""
    out, ck = _dirs(spark, name)
    run(stream, out, ck)
    return out


def q_stream_alerts(spark, sf):
    text = td.reading_text(td.sample_readings(spark, sf))
    stream, delay = _replayed(spark, text, "text")
    return spark.read.parquet(_written(spark, S.alert_stream(stream, P, delay), "stream_alerts"))


def q_stream_alerts_shared_ts(spark, sf):
    """Devices share instants: each device's alert comes out."""
    text = td.reading_text(td.at_full_hours(td.sample_readings(spark, sf)))
    stream, delay = _replayed(spark, text, "shared")
    return spark.read.parquet(_written(spark, S.alert_stream(stream, P, delay), "stream_shared"))


def q_stream_restart(spark, sf):
    """Stopped in the middle of the input and started again on the same checkpoint:
    every alert is emitted exactly once."""
    text = td.reading_text(td.sample_readings(spark, sf))
    stream, delay = _replayed(spark, text, "restart")
    out, ck = _dirs(spark, "stream_restart")
    first = S.run_to_files(S.alert_stream(stream, P, delay), out, ck, trigger={"processingTime": "0 seconds"})
    while first.isActive and not any(x["numInputRows"] for x in first.recentProgress):
        time.sleep(0.05)
    first.stop()
    S.run_to_files(S.alert_stream(stream, P, delay), out, ck)
    return spark.read.parquet(out)


def q_stream_late_drop(spark, sf):
    """Some rows of the first quarter arrive with the last one, behind the watermark: they are not counted."""
    stream, delay = _replayed(spark, td.readings(spark, sf), "late", late=F.col("event_id") % 50 == 0)
    out = _written(spark, S.daily_counts_stream(stream, delay), "stream_late", S.run_foreach_batch)
    return S.latest_per_key(spark, out, ["device_id", "day"])


def q_stream_conflate(spark, sf):
    """One refresh per device and event-time tick with its newest sample."""
    stream, delay = _replayed(spark, monitor.valid_samples(td.readings(spark, sf)), "valid")
    out = _written(spark, S.conflate_stream(stream, P, delay), "stream_conflate", S.run_foreach_batch)
    return S.latest_per_key(spark, out, ["device_id", "tick_start"])


def q_stream_device_state(spark, sf):
    mixed = S.mixed_feed(monitor.valid_samples(td.sample_readings(spark, sf)), td.source_status(spark, sf))
    stream, delay = _replayed(spark, mixed, "mixed", key="event_id", end_after_s=60)
    return spark.read.parquet(_written(spark, S.device_state_stream(stream, P, delay), "stream_state"))


def q_stream_counters(spark, sf):
    mixed = S.mixed_feed(monitor.valid_samples(td.sample_readings(spark, sf)), td.source_status(spark, sf), None)
    stream, delay = _replayed(spark, mixed, "mixed_all", key="event_id", end_after_s=60)
    out = _written(spark, S.counters_stream(stream, P, delay), "stream_counters", S.run_foreach_batch)
    return S.latest_per_key(spark, out, ["device_id"])


def q_stream_recent_alerts(spark, sf):
    stream, delay = _replayed(spark, monitor.valid_samples(td.readings(spark, sf)), "valid")
    out = _written(spark, S.sliding_alerts_stream(stream, P.recent_horizon_s, 3600, P, delay), "stream_recent", S.run_foreach_batch)
    return S.latest_per_key(spark, out, ["device_id", "window_start"])


def q_stream_route_events(spark, sf):
    """Event records arrive as a stream and are routed to one output per handler."""
    from pumpline.plans.catalog import _event_log

    log = _event_log(spark, sf).select("device_id", "ts", "seq", "event_id", "tag", "level", "message")
    out, ck = _dirs(spark, "stream_route")
    stream, _ = _replayed(spark, log, "route")
    (stream.writeStream.foreachBatch(S.route_batch(out)).option("checkpointLocation", ck)
     .trigger(availableNow=True).start().awaitTermination())
    routed = None
    for t in ("log", "macro", "status", "micro"):  # every handler has a folder, an empty one if it got nothing
        part = spark.read.schema(log.schema).parquet(f"{out}/{t}/batch=*")
        part = part.groupBy(F.lit(t).alias("handler"), "level").agg(F.count(F.lit(1)).alias("n_events"))
        routed = part if routed is None else routed.unionByName(part)
    return routed


def q_stream_recent_alerts_exact(spark, sf):
    """Counts at samples (event_id) and at the moments an alert leaves the horizon (event_id null)."""
    stream, delay = _replayed(spark, monitor.valid_samples(td.readings(spark, sf)), "valid", key="event_id",
                              end_after_s=2 * P.recent_horizon_s)
    return spark.read.parquet(_written(spark, S.recent_alerts_exact_stream(stream, P, delay), "stream_recent_exact"))


def q_stream_mute_windows(spark, sf):
    stream, delay = _replayed(spark, td.mute_toggles(spark, sf), "presses", key="event_id", end_after_s=2 * P.mute_s)
    return spark.read.parquet(_written(spark, S.mute_windows_stream(stream, P, delay), "stream_mute"))


def q_stream_event_log(spark, sf):
    stream, delay = _replayed(spark, td.monitor_feed(spark, sf), "feed", key="event_id", end_after_s=60)
    out = _written(spark, S.event_log_stream(stream, P, delay), "stream_log")
    return spark.read.parquet(out).select(
        "device_id", "ts", "seq", "event_id", "tag", "level", "message", "source", "online", "normal", "anomaly", "muted", "line")


def _hour_cells(batch: DataFrame) -> DataFrame:
    return td.inject_cell_faults(wide.unpivot_cells(batch, F.date_format("ts", "yyyy-MM-dd HH:00:00.000000"), "event_id"))


def _upserts(spark, sf, name, sink, table):
    """Readings streamed into the keyed table, keys by the hour: they are written again and again."""
    ck = _dirs(spark, name)[1]
    stream, _ = _replayed(spark, td.readings(spark, sf).withColumn("hour", F.date_trunc("hour", "ts")), name, key="hour")
    (stream.writeStream.foreachBatch(sink).option("checkpointLocation", ck)
     .trigger(availableNow=True).start().awaitTermination())


def q_stream_macro_counts(spark, sf):
    """The batch view next to the speed view, kept up to date by what each micro-batch changes."""
    table, view = work_path(spark, "view_table"), work_path(spark, "view_changes")
    _upserts(spark, sf, "stream_macro", S.view_sink(table, view, _hour_cells, compact_every=3), table)
    return S.read_view(spark, table, view)


def q_stream_upsert(spark, sf):
    """Keyed upsert driven by a stream: each micro-batch is one idempotent upsert, compacted on the way."""
    table = work_path(spark, "stream_wave")
    _upserts(spark, sf, "stream_wave", S.upsert_sink(table, _hour_cells, compact_every=3), table)
    return wide.read_cells(spark, table)


def q_stream_interval_join(spark, sf):
    """Samples and mute windows as two streams: the window each sample falls in."""
    samples = monitor.valid_samples(td.sample_readings(spark, sf))
    windows = eventlog.windows_only(eventlog.mute_windows(td.mute_toggles(spark, sf), P))
    # the closing rows lie far enough behind both ends for either watermark
    far = 60 * 86_400
    left = replay(spark, samples, work_path(spark, "replay_points"), N_SLICES, key="event_id", end_after_s=far)
    right = replay(spark, windows, work_path(spark, "replay_windows"), N_SLICES, ts="start_ts", end_after_s=far)
    delay = f"{max(left.delay_s, right.delay_s)} seconds"
    joined = S.interval_join_stream(source(spark, left), source(spark, right), P.mute_s, delay)
    cols = ("event_id", "device_id", "ts", "interval_start", "interval_end")
    return spark.read.parquet(_written(spark, joined.select(*cols), "stream_interval"))


def q_stream_poll(spark, sf):
    """The keyed table polled by row key: once with the older half of the readings, then after a
    restart with the younger half and late puts on old keys, then with nothing new."""
    table, (out, ck) = work_path(spark, "polled"), _dirs(spark, "stream_poll")
    cells, key = td.cells(spark, sf), F.col("row_key")
    lo, hi = td.readings(spark, sf).agg(F.min(X.epoch_seconds("ts")), F.max(X.epoch_seconds("ts"))).first()
    half = X.row_key(S.instant_to_ntz(F.timestamp_seconds(F.lit((lo + hi) // 2))))
    late = cells.filter((key <= half) & (F.col("version") % 3 == 0)).withColumn("value", F.lit("9"))

    def poll():
        (polling.poll_cells(spark, table).writeStream.foreachBatch(polling.poll_sink(out)).option("checkpointLocation", ck)
         .trigger(availableNow=True).start().awaitTermination())

    wide.upsert_cells(spark, table, cells.filter(key <= half), 1)
    poll()
    wide.upsert_cells(spark, table, cells.filter(key > half), 2)
    wide.upsert_cells(spark, table, late, 3)
    wide.compact_cells(spark, table)
    poll()
    poll()
    return spark.read.parquet(out).withColumn("poll", F.col("poll").cast("long"))


def q_stream_supervised(spark, sf):
    """A sink that breaks once, after it wrote its second batch: status rows, one reconnect, every alert once."""
    text = td.reading_text(td.sample_readings(spark, sf))
    stream, delay = _replayed(spark, text, "supervised")
    (out, ck), status = _dirs(spark, "stream_supervised"), work_path(spark, "feed_status")
    broken = []

    def sink(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        if batch_id == 1 and not broken:
            broken.append(batch_id)
            raise OSError("the store went away")

    def start():
        return (S.alert_stream(stream, P, delay).writeStream.foreachBatch(sink).option("checkpointLocation", ck)
                .trigger(availableNow=True).start())

    supervisor.supervise(start, supervisor.status_writer(spark, status, "speed"), pause_s=0.1)
    rows = supervisor.status_rows(spark, status)
    now, n = monitor.source_status(rows), rows.groupBy("source").agg(F.count_if(~F.col("online")).alias("failures"))
    again = monitor.reconnect_count(rows).select(F.lit("speed").alias("source"), F.col("speed_reconnects").alias("reconnects"))
    alerts = spark.read.parquet(out).agg(F.count("event_id").alias("n_alerts"), F.count_distinct("event_id").alias("n_distinct"))
    return (now.select("source", "online").join(n, "source").join(again, "source")
            .join(alerts.withColumn("source", F.lit("speed")), "source"))


def q_stream_score(spark, sf):
    """Model trained in batch, saved, loaded by the stream and applied to arriving rows."""
    from pyspark.ml import PipelineModel

    w = ml.hash_split(td.wide_features(spark, sf), "row_id")
    model_path = work_path(spark, "rf_model")
    ml.fit_rf(w.filter(F.col("split") == "train"), td.FEATURES_W, P, key="row_id").write().overwrite().save(model_path)
    model = PipelineModel.load(model_path)
    test = w.filter(F.col("split") == "test").drop("split", "split_bucket")
    scored = model.transform(_replayed(spark, test, "score", key="row_id")[0]).select("row_id", "ts", "label", "prediction")
    scored = spark.read.parquet(_written(spark, scored, "stream_score"))
    return scored.select("row_id", "ts", "label", F.col("prediction").isin(0.0, 1.0).alias("is_class"))


STREAM_QUERIES = {name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_stream")}

_ALERTS_SQL = O.w(O.R, O.S, O.TEXT) + f"""SELECT event_id, device_id, {O.message('row_key', 's04n', 's10n')} AS message
FROM PT WHERE reason IS NULL AND predn = 1.0"""

STREAM_ORACLES = {
    "stream_alerts": _ALERTS_SQL,
    "stream_restart": _ALERTS_SQL,
    "stream_alerts_shared_ts": O.w(O.R.replace("R AS (", "R0 AS ("), """R AS (
  SELECT * REPLACE (date_trunc('hour', ts) AS ts) FROM R0 WHERE event_type NOT IN ('error', 'signup')
  QUALIFY row_number() OVER (PARTITION BY device_id, date_trunc('hour', ts) ORDER BY event_id) = 1)""", O.TEXT)
    + f"""SELECT event_id, device_id, {O.message('row_key', 's04n', 's10n')} AS message
FROM PT WHERE reason IS NULL AND predn = 1.0""",
    "stream_late_drop": O.w(O.R) + f"""SELECT device_id, CAST(ts AS DATE) AS day, count(*) AS n_rows
FROM R, (SELECT epoch(min(ts))::BIGINT AS lo, greatest(1, (epoch(max(ts))::BIGINT - epoch(min(ts))::BIGINT) // {N_SLICES} + 1) AS width FROM R) b
WHERE NOT (event_id % 50 = 0 AND (epoch_us(ts) // 1000000 - lo) // width = 0)
GROUP BY device_id, CAST(ts AS DATE)""",
    "stream_mute_windows": O.ORACLES["mute_windows"],
    "stream_event_log": O.ORACLES["event_log"],
    "stream_device_state": O.ORACLES["device_state"],
    "stream_counters": O.w(O.R, O.VS, O.S, O.RECONNECTS) + """SELECT d.device_id,
  coalesce(a.session_alerts, 0) AS session_alerts,
  coalesce(RCN.batch_reconnects + RCN.speed_reconnects, 0) AS total_reconnects
FROM (SELECT device_id FROM VS UNION SELECT device_id FROM S) d
LEFT JOIN (SELECT device_id, count(*) FILTER (WHERE pred = 1.0) AS session_alerts FROM VS GROUP BY device_id) a
  USING (device_id)
LEFT JOIN RCN USING (device_id)""",
    "stream_recent_alerts": O.w(O.R, O.V) + f"""SELECT device_id, window_start, count(*) AS alerts FROM (
  SELECT device_id, date_trunc('hour', ts) - INTERVAL (k) HOUR AS window_start
  FROM V, range(0, {P.recent_horizon_s // 3600}) t(k) WHERE pred = 1.0) z
GROUP BY device_id, window_start""",
    "stream_conflate": O.w(O.R, O.V) + """SELECT device_id, tick_start, event_id, ts, s04, s10, pred FROM (
  SELECT *, make_timestamp((epoch_us(ts) // {t}) * {t}) AS tick_start,
         row_number() OVER (PARTITION BY device_id, epoch_us(ts) // {t} ORDER BY ts DESC, event_id DESC) AS rn
  FROM V) z WHERE rn = 1""".format(t=P.tick_ms * 1000),
    "stream_macro_counts": O.w(O.R, O.cells_cte("strftime(ts, '%Y-%m-%d %H:00:00.000000')"), O.PIVOT,
                               "MV AS (SELECT row_key, TRY_CAST(pred AS FLOAT) AS pred FROM P)") + O._macro("MV", ""),
    "stream_interval_join": O.ORACLES["interval_join"],
    "stream_poll": O.w(O.R, O.cells_cte(), O.PIVOT, """H AS (
  SELECT strftime(make_timestamp(((epoch_us(min(ts)) // 1000000 + epoch_us(max(ts)) // 1000000) // 2) * 1000000), '%Y-%m-%d %H:%M:%S.%f') AS half
  FROM R)""") + """SELECT row_key, TRY_CAST(s04 AS FLOAT) AS s04, TRY_CAST(s10 AS FLOAT) AS s10, TRY_CAST(pred AS FLOAT) AS pred,
  CASE WHEN row_key <= half THEN 0 ELSE 1 END AS poll FROM P, H""",
    "stream_supervised": O.w(O.R, O.S, O.TEXT) + """SELECT 'speed' AS source, true AS online, 1 AS failures, 1 AS reconnects,
  count(event_id) AS n_alerts, count(DISTINCT event_id) AS n_distinct
FROM PT WHERE reason IS NULL AND predn = 1.0""",
    "stream_score": O.w(O.W) + O._TEST + "SELECT row_id, ts, label, true AS is_class FROM TS",
    "stream_route_events": O.ORACLES["route_events"],
    "stream_recent_alerts_exact": O.w(O.R, O.V, f"""A AS (
  SELECT device_id, epoch_us(ts) AS us FROM V WHERE pred = 1.0),
Q AS (
  SELECT event_id, device_id, epoch_us(ts) AS us FROM V
  UNION ALL SELECT DISTINCT CAST(NULL AS BIGINT), device_id, us + {P.recent_horizon_s * 1000000 + 1} FROM A)""") + f"""
SELECT Q.event_id, Q.device_id, make_timestamp(Q.us) AS ts, count(A.us) AS recent_alerts
FROM Q LEFT JOIN A ON A.device_id = Q.device_id AND A.us BETWEEN Q.us - {P.recent_horizon_s * 1000000} AND Q.us
GROUP BY Q.event_id, Q.device_id, Q.us""",
    "stream_upsert": O.w(O.R, O.cells_cte("strftime(ts, '%Y-%m-%d %H:00:00.000000')", "R", "C")) + """
SELECT row_key, family, qualifier, value, version FROM (
  SELECT *, row_number() OVER (PARTITION BY row_key, family, qualifier ORDER BY version DESC) AS rn FROM C) z
WHERE rn = 1""",
}
