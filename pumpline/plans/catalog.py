"""Query catalogue: name -> callable(spark, sf_dir) -> DataFrame.

Each query runs one operator (or a short chain) over the fixture views of the
driver's tables; ``pumpline.plans.oracles`` holds the DuckDB SQL for the same
name.  Parameters are the testdata settings of FIXTURES.md (thresholds 100/45,
horizons 86,400 s); the library defaults stay the dashboard's values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pumpline.config import TESTDATA_PARAMS as P
from pumpline.functions import expressions as X
from pumpline.operators import clean, eventlog, jobs, ml, monitor
from pumpline.session import work_path
from pumpline.sources import external, files, folders, testdata as td, wide

Query = Callable[[SparkSession, str], DataFrame]
R_COLS = td.READING_COLUMNS


# --- inputs -------------------------------------------------------------------

def _valid(spark, sf):
    """Readings the speed layer can use."""
    return monitor.valid_samples(td.readings(spark, sf))


def _samples(spark, sf):
    """Valid readings of the non-status event types (used next to view S)."""
    return monitor.valid_samples(td.sample_readings(spark, sf))


def _parsed_text(spark, sf):
    return clean.parse_reject(td.reading_text(td.sample_readings(spark, sf)))


def _event_log(spark, sf):
    return eventlog.event_log(td.monitor_feed(spark, sf), P)


def _presses(spark, sf):
    return eventlog.mute_windows(td.mute_toggles(spark, sf), P)


def _log_lines(spark, sf):
    return eventlog.log_lines(eventlog.event_log(td.monitor_feed(spark, sf), P, ("log",)))


def _lines_since_clear(spark, sf):
    clears = td.clear_marks(spark, sf)
    return eventlog.since_last_clear(eventlog.log_lines(eventlog.event_log(td.monitor_feed(spark, sf), P, ("log",), clears)), clears)


# --- A: sources and sinks -----------------------------------------------------------

def q_csv_scan_typed(spark, sf):
    path = work_path(spark, "csv_scan")
    files.write_csv(td.readings(spark, sf), path)
    good, _bad = files.read_csv_typed(spark, path)
    return good.select(*R_COLS)


def q_bronze_landing(spark, sf):
    path = work_path(spark, "bronze_csv")
    files.write_csv(td.readings(spark, sf), path)
    landed = files.bronze_landing(spark, path, work_path(spark, "bronze_parquet"))
    return landed.select(*R_COLS)


def q_parquet_scan(spark, sf):
    return td.table(spark, sf, "events").select("event_id", F.col("user_id").alias("device_id"), "ts", "event_type", "value")


def q_parquet_scan_pushdown(spark, sf):
    ev = td.table(spark, sf, "events")
    return (ev.filter((F.col("event_type") == "error") & (F.col("value") > 50))
              .select("event_id", F.col("user_id").alias("device_id"), "ts", "value"))


def q_parquet_roundtrip(spark, sf):
    path = work_path(spark, "readings_by_day")
    files.write_partitioned(td.readings(spark, sf), path)
    return spark.read.parquet(path).select(*R_COLS, "dt")


def q_external_table(spark, sf):
    loc = work_path(spark, "predictions")
    preds = clean.label_binary(td.readings(spark, sf)).select(
        F.col("ts").cast("timestamp").alias("timestamp"), "machine_status", "label", F.col("pred").alias("prediction"))
    preds.write.mode("overwrite").parquet(loc)
    db = "pumpline_" + loc.rsplit("-", 1)[-1]
    db_loc, columns = work_path(spark, "db"), "`timestamp` TIMESTAMP, machine_status STRING, label INT, prediction DOUBLE"
    for _ in range(2):  # both statements are idempotent
        t = files.create_external_table(spark, db, "sensor_predictions", loc, db_loc, columns)
    return t.select("timestamp", "machine_status", "label", "prediction")


def q_wide_unpivot(spark, sf):
    r = td.readings(spark, sf)
    return wide.unpivot_cells(r, X.row_key("ts"), "event_id")


def q_wide_pivot(spark, sf):
    return wide.mapped_view(td.cells(spark, sf))


def _upsert_batches(spark, sf):
    r = td.readings(spark, sf)
    key = F.date_format("ts", "yyyy-MM-dd HH:00:00.000000")
    first = r.filter(F.col("event_type").isin("click", "view"))
    second = r.filter(~F.col("event_type").isin("click", "view"))
    return [td.inject_cell_faults(wide.unpivot_cells(b, key, "event_id")) for b in (first, second)]


def q_keyed_upsert(spark, sf):
    path = work_path(spark, "sensor_wave")
    for i, b in enumerate(_upsert_batches(spark, sf), start=1):
        wide.upsert_cells(spark, path, b, batch_id=i)
    return wide.read_cells(spark, path)


def q_latest_row(spark, sf):
    return wide.latest_row(td.cells(spark, sf))


def _device_cells(spark, sf):
    """Cells keyed by time and device, with devices that share instants."""
    r = td.readings(spark, sf).withColumn("_hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    return td.inject_cell_faults(wide.unpivot_cells(r, X.row_key("_hour", "device_id"), "event_id"))


def q_wide_pivot_devices(spark, sf):
    return wide.mapped_view(_device_cells(spark, sf))


def q_keyed_upsert_devices(spark, sf):
    """Batches 1 and 3, a compaction, then batch 2 for the first time (late) and batch 1 again (a replay), and another compaction."""
    path = work_path(spark, "sensor_wave_devices")
    c = _device_cells(spark, sf)
    batch = {i: c.filter(F.col("version") % 3 == i - 1) for i in (1, 2, 3)}
    for i in (1, 3):
        wide.upsert_cells(spark, path, batch[i], i)
    wide.compact_cells(spark, path)
    for i in (2, 1):
        wide.upsert_cells(spark, path, batch[i], i)
    wide.compact_cells(spark, path)
    return wide.read_cells(spark, path)


def q_external_upsert(spark, sf):
    """The readings' cells put into an outside store row by row, in calls of bounded size; what it holds afterwards."""
    root = work_path(spark, "external")
    external.put_cells(td.cells(spark, sf), root, P.put_rows)
    return external.stored_cells(spark, root)


# --- B: cleaning and expressions ----------------------------------------------------

def _with_junk_columns(spark, sf):
    return td.readings(spark, sf).withColumn("_c0", F.col("event_id")) \
        .withColumn("sensor_15", F.lit(None).cast("double"))


def q_drop_columns(spark, sf):
    return clean.drop_columns(_with_junk_columns(spark, sf))


def q_null_profile(spark, sf):
    return clean.null_profile(_with_junk_columns(spark, sf).drop("_c0"))


def _ts_text(spark, sf):
    ev = td.table(spark, sf, "events")
    txt = (F.when(F.col("event_id") % 31 == 0, F.lit("not-a-time"))
            .when(F.col("event_id") % 37 == 0, F.lit("2024-13-01 00:00:00"))
            .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    return ev.select("event_id", txt.alias("ts_text"))


def q_parse_timestamp(spark, sf):
    d = _ts_text(spark, sf)
    return d.withColumn("ts_parsed", clean.parse_timestamp("ts_text")) \
            .withColumn("quarantined", F.col("ts_parsed").isNull())


def q_parse_reject(spark, sf):
    p = clean.parse_reject(wide.pivot_cells(td.cells(spark, sf)))
    return p.select("row_key", F.col("s04_num").alias("s04"), F.col("s10_num").alias("s10"),
                    F.col("pred_num").alias("pred"), "ok", "reason")


def q_fill_zero(spark, sf):
    r = td.readings(spark, sf).withColumn(
        "s10", F.when(F.col("event_id") % 37 == 0, F.lit(float("nan"))).otherwise(F.col("s10")))
    return clean.fill_zero(r)


def q_clean_job(spark, sf):
    """Cleaning job end to end: raw rows with index/empty columns -> cleaned Parquet,
    metrics observed during the write."""
    raw = _with_junk_columns(spark, sf)
    path = work_path(spark, "cleaned")
    clean.write_with_metrics(clean.clean_readings(raw), path)
    return spark.read.parquet(path)


def q_label_binary(spark, sf):
    return clean.label_binary(td.readings(spark, sf)).select("event_id", "machine_status", "label")


def q_feature_columns(spark, sf):
    w = td.wide_features(spark, sf)
    return w.select("row_id", *clean.feature_columns(w))


def q_row_key(spark, sf):
    r = td.readings(spark, sf).withColumn(
        "ts", F.when(F.col("event_id") % 41 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(F.col("ts")))
    good, _bad = clean.with_row_key(r)
    return good.select("event_id", "row_key")


def q_decode_key(spark, sf):
    r = td.readings(spark, sf)
    raw = F.encode(X.row_key("ts"), "UTF-8")
    key = F.when(F.col("event_id") % 43 == 0, F.concat(raw, F.unhex(F.lit("FF")))).otherwise(raw)
    return r.select("event_id", wide.decode_key(key).alias("key_text"))


def q_threshold_flags(spark, sf):
    return monitor.threshold_flags(td.readings(spark, sf), P).select("event_id", "vib_exceeded", "temp_exceeded")


def q_alert_reason(spark, sf):
    return monitor.alerts(_valid(spark, sf).withColumn("row_key", X.row_key("ts")), P) \
        .select("event_id", "device_id", "reason")


def q_alert_message(spark, sf):
    return monitor.alerts(_valid(spark, sf).withColumn("row_key", X.row_key("ts")), P) \
        .select("event_id", "message")


def q_sample_text(spark, sf):
    return monitor.sample_text(_valid(spark, sf).withColumn("row_key", X.row_key("ts")), P) \
        .select("event_id", "sample_line")


# --- C / D: joins and aggregates -------------------------------------------------------

def q_join_predictions(spark, sf):
    cleaned = clean.fill_zero(td.readings(spark, sf)).select("device_id", "ts", "s04", "s10", "machine_status")
    preds = ml.hash_split(td.readings(spark, sf).withColumn("row_key", X.row_key("ts")), "row_key") \
        .filter(F.col("split") == "test").select("device_id", "ts", F.col("pred").alias("prediction"))
    return cleaned.join(preds, ["device_id", "ts"], "inner")


def q_join_predictions_bucketed(spark, sf):
    """The same join over tables that were written bucketed by its keys: no shuffle when it runs."""
    both = {
        "cleaned": clean.fill_zero(td.readings(spark, sf)).select("device_id", "ts", "s04", "s10", "machine_status"),
        "predicted": ml.hash_split(td.readings(spark, sf).withColumn("row_key", X.row_key("ts")), "row_key")
        .filter(F.col("split") == "test").select("device_id", "ts", F.col("pred").alias("prediction"))}
    tables = []
    for name, df in both.items():
        at = work_path(spark, name)
        tables.append(files.write_bucketed(df, "pumpline_" + at.rsplit("/", 1)[-1].replace("-", "_"), at, ["device_id", "ts"], 16))
    return tables[0].hint("merge").join(tables[1], ["device_id", "ts"], "inner")


def q_row_count(spark, sf):
    return clean.row_count(td.readings(spark, sf))


def q_status_distribution(spark, sf):
    return clean.status_distribution(td.readings(spark, sf))


def q_macro_counts(spark, sf):
    return monitor.macro_counts(td.readings(spark, sf))


def q_macro_counts_wide(spark, sf):
    return monitor.macro_counts(wide.mapped_view(td.cells(spark, sf)), by=())


def q_macro_ratio(spark, sf):
    return monitor.macro_ratio(monitor.macro_counts(td.readings(spark, sf))) \
        .select("device_id", "normal", "anomaly", "normal_ratio")


def q_monthly_counts(spark, sf):
    return monitor.monthly_counts(td.readings(spark, sf))


def q_session_alerts(spark, sf):
    return monitor.session_alerts(_valid(spark, sf), P).select("event_id", "device_id", "ts", "session_alerts")


def q_recent_alerts_5m(spark, sf):
    return monitor.recent_alerts(_valid(spark, sf), P).select("event_id", "device_id", "ts", "recent_alerts")


def q_session_alerts_global(spark, sf):
    return monitor.session_alerts(_valid(spark, sf), P, by=()).select("event_id", "ts", "session_alerts")


def q_recent_alerts_global(spark, sf):
    return monitor.recent_alerts(_valid(spark, sf), P, by=()).select("event_id", "ts", "recent_alerts")


def q_waveform_last80(spark, sf):
    return monitor.waveform_last(_valid(spark, sf), 80, P)


def q_waveform_global(spark, sf):
    return monitor.waveform_last_global(_valid(spark, sf), 80, P)


def q_waveform_last20(spark, sf):
    return monitor.waveform_last(_valid(spark, sf), 20, P)


def q_rolling80_stats(spark, sf):
    r = monitor.rolling_stats(_valid(spark, sf), 80, P, chunk_rows=P.buffer_len * 4)
    return r.select("event_id", "device_id", "ts", "n_window", F.round("avg_s10", 9).alias("avg_s10"), "min_s10", "max_s10",
                    "max_s04", F.round("avg_s04", 9).alias("avg_s04"))


def q_latest_per_device(spark, sf):
    return monitor.latest_per_device(_valid(spark, sf))


def _polls(spark, sf):
    """Polls with a key an hour; some have none."""
    key = F.when(F.col("event_id") % 13 != 0, F.date_format("ts", "yyyy-MM-dd HH"))
    return _valid(spark, sf).withColumn("poll_key", key)


def q_dedupe_consecutive(spark, sf):
    return monitor.dedupe_consecutive(_polls(spark, sf), "poll_key", P) \
        .select("device_id", "event_id", "ts", "poll_key")


def q_dedupe_consecutive_global(spark, sf):
    return monitor.dedupe_consecutive(_polls(spark, sf), "poll_key", P, by=()).select("event_id", "ts", "poll_key")


def q_drain_ticks(spark, sf):
    """One capped queue per device."""
    return monitor.drain_ticks(_valid(spark, sf), P).select("device_id", "event_id", "tick_arrived", "tick_handled", "queued")


def q_reconnect_count(spark, sf):
    return monitor.reconnect_count(td.source_status(spark, sf), P)


def q_source_status(spark, sf):
    return monitor.source_status(td.source_status(spark, sf))


def q_device_state(spark, sf):
    return monitor.device_state(_samples(spark, sf), td.source_status(spark, sf), P)


def q_kpi_snapshot(spark, sf):
    return monitor.kpi_snapshot(_samples(spark, sf), td.source_status(spark, sf), P)


# --- E / F: event log ------------------------------------------------------------------

def q_mute_windows(spark, sf):
    return eventlog.windows_only(eventlog.mute_windows(td.mute_toggles(spark, sf), P))


def q_mute_remaining(spark, sf):
    return eventlog.mute_remaining(_samples(spark, sf), _presses(spark, sf), P).select("event_id", "device_id", "ts", "remaining")


def q_interval_join(spark, sf):
    win = eventlog.windows_only(_presses(spark, sf))
    return eventlog.interval_join(_samples(spark, sf), win, P).select("event_id", "device_id", "ts", "interval_start", "interval_end")


def q_event_log(spark, sf):
    return _event_log(spark, sf).select(
        "device_id", "ts", "seq", "event_id", "tag", "level", "message", "source", "online", "normal", "anomaly", "muted", "line")


def q_log_mute_tag(spark, sf):
    return _event_log(spark, sf).filter(F.col("level") == "ERROR").select("device_id", "event_id", "ts", "muted", "line")


def q_route_events(spark, sf):
    path = work_path(spark, "event_log")
    _event_log(spark, sf).select("tag", "level").write.parquet(path)
    routed = eventlog.route_events(spark.read.parquet(path))
    parts = [d.groupBy(F.lit(t).alias("handler"), "level").agg(F.count(F.lit(1)).alias("n_events"))
             for t, d in routed.items()]
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_)
    return out


def q_log_lines(spark, sf):
    return _log_lines(spark, sf).select("device_id", "ts", "seq", "event_id", "level", "line")


def q_log_tail(spark, sf):
    return eventlog.log_tail(_log_lines(spark, sf), P.log_keep).select("device_id", "ts", "seq", "event_id", "line")


def q_log_since_clear(spark, sf):
    return _lines_since_clear(spark, sf).select("device_id", "ts", "seq", "event_id", "line")


def q_log_export_lines(spark, sf):
    return eventlog.export_lines(_lines_since_clear(spark, sf), P)


def q_log_export_files(spark, sf):
    """The export as files, one folder for each device, read back as text."""
    path = work_path(spark, "log_export")
    eventlog.write_export(eventlog.export_lines(_lines_since_clear(spark, sf), P), path)
    return folders.read_text_folders(spark, path, "device_id").select(F.col("device_id").cast("long").alias("device_id"), F.col("value").alias("line"))


# --- G: machine learning ------------------------------------------------------------------

FW = td.FEATURES_W


def q_assemble_features(spark, sf):
    from pyspark.ml.functions import vector_to_array
    a = ml.assemble(td.wide_features(spark, sf), FW).withColumn("_v", vector_to_array("raw_features"))
    return a.select("row_id", *[F.col("_v")[i].alias(f"f{i}") for i in range(len(FW))])


def q_feature_stats(spark, sf):
    s = ml.feature_stats(td.wide_features(spark, sf), FW)
    return s.select("position", "feature", F.round("mean", 9).alias("mean"), F.round("std", 9).alias("std"))


def q_standardize(spark, sf):
    from pyspark.ml.functions import vector_to_array
    z = ml.standardize(td.wide_features(spark, sf), FW).withColumn("_z", vector_to_array("features"))
    return z.select("row_id", *[F.round(F.col("_z")[i], 6).alias(f"{f}_z") for i, f in enumerate(FW)])


def q_hash_split(spark, sf):
    return ml.hash_split(td.wide_features(spark, sf), "row_id").select("row_id", "split_bucket", "split")


def q_auc_exact(spark, sf):
    v = _valid(spark, sf).withColumn("is_alert", X.is_alert("pred", P.alert_pred))
    return ml.auc_exact(v, "s10", "is_alert").select(F.round("auc", 6).alias("auc"))


def _split_w(spark, sf):
    return ml.hash_split(td.wide_features(spark, sf), "row_id")


def _fit(spark, sf):
    w = _split_w(spark, sf)
    return ml.fit_rf(w.filter(F.col("split") == "train"), FW, P, key="row_id"), w


AGREES = 0.98  # share of rows on which the forest must agree with the rule behind the label
HOLDOUT_AUC = 0.9


def _agreement(scored):
    """What SQL can state of scored rows: their number by label, and that the model has learned the rule."""
    return scored.groupBy("label").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(~F.col("prediction").isin(0.0, 1.0)).alias("n_other"),
        (F.count_if(F.col("prediction") == F.col("label")) >= F.lit(AGREES) * F.count(F.lit(1))).alias("agrees"))


def q_rf_train(spark, sf):
    model, w = _fit(spark, sf)
    scored = ml.score(model, w.filter(F.col("split") == "test")).persist()
    try:
        holdout_auc = ml.auc_exact(scored, "raw_score", "label").first()["auc"]
        mllib_auc = ml.evaluator_auc(scored, num_bins=1000)   # the original job's metric
    finally:
        scored.unpersist()
    rf = model.stages[-1]
    imp = [float(x) for x in rf.featureImportances.toArray()]
    meta = spark.createDataFrame([(f, i, x) for i, (f, x) in enumerate(zip(FW, imp))], "feature string, position int, importance double")
    # the two features of the rule carry the forest
    return meta.select("feature", "position", (F.col("importance") > 0.2).alias("matters"), F.lit(rf.getNumTrees).alias("num_trees"),
                       F.lit(abs(sum(imp) - 1) < 1e-6).alias("sums_to_one"), F.lit(holdout_auc > HOLDOUT_AUC).alias("auc_ok"),
                       F.lit(mllib_auc > HOLDOUT_AUC).alias("auc_mllib_ok"))


def q_score_holdout(spark, sf):
    model, w = _fit(spark, sf)
    return _agreement(ml.score(model, w.filter(F.col("split") == "test")))


def q_score_all(spark, sf):
    model, w = _fit(spark, sf)
    scored = ml.score(model, w)
    return scored.select("row_id", "ts", "label", F.col("prediction").isin(0.0, 1.0).alias("is_class"))


def q_confusion(spark, sf):
    model, w = _fit(spark, sf)
    c = ml.confusion(ml.score(model, w.filter(F.col("split") == "test")))
    return c.groupBy("label").agg(F.sum("n_rows").alias("n_rows"), (F.max_by("prediction", "n_rows") == F.col("label")).alias("mostly_right"))


def q_pipeline_end_to_end(spark, sf):
    """The whole batch path on the raw file layout: CSV -> clean -> label, scale, forest
    -> predictions -> join -> upsert -> served view; bad rows are counted next to it."""
    raw = td.raw_sensor_csv(spark, sf, work_path(spark, "raw_csv"))
    served, rejected, untimed = jobs.csv_to_served(spark, raw, work_path(spark, "job"), P)
    counts = untimed.agg(F.count(F.lit(1)).alias("n_untimed")).crossJoin(rejected.agg(F.count(F.lit(1)).alias("n_rejected")))
    keys = served.agg(F.count(F.lit(1)).alias("n_keys"), F.count("s04").alias("n_s04"), F.count("s10").alias("n_s10"),
                      F.count_if(F.col("pred").isin(0.0, 1.0)).alias("n_pred"), F.min("row_key").alias("first_key"), F.max("row_key").alias("last_key"),
                      F.round(F.sum(F.col("s04").cast("decimal(18,2)")), 2).cast("double").alias("sum_s04"))
    return keys.crossJoin(counts)


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
