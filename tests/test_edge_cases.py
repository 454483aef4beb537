"""Hand-written edge cases (FIXTURES.md 2.6), default dashboard parameters."""

import tempfile
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pumpline import config as C
from pumpline.config import DEFAULT_PARAMS as D
from pumpline.functions import expressions as X
from pumpline.operators import clean, eventlog, ml, monitor
from pumpline.session import work_path
from pumpline.sources import files, wide

T0 = datetime(2024, 1, 1, 0, 0, 0)


def test_csv_empty_first_header_is_not_a_feature(spark):
    d = tempfile.mkdtemp(prefix="pl-csv-")
    with open(f"{d}/x.csv", "w") as f:
        f.write(",timestamp,sensor_04,sensor_10,sensor_15,machine_status\n")
        f.write("0,2024-01-01 00:00:00,1.5,2.5,,NORMAL\n1,2024-01-01 00:01:00,,3.5,,BROKEN\n")
    raw = spark.read.csv(d, header=True, inferSchema=True)
    assert "_c0" in raw.columns
    cleaned = clean.drop_columns(raw)
    assert "_c0" not in cleaned.columns and "sensor_15" not in cleaned.columns
    assert clean.feature_columns(raw) == ["sensor_04", "sensor_10"] or "_c0" not in clean.feature_columns(raw)


def test_unparseable_timestamp_is_quarantined(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("not a time",), ("2024-02-30 00:00:00",)], "t string")
    good, bad = clean.split_bad_timestamps(df, "t")
    assert good.count() == 1 and bad.count() == 2


def test_typed_csv_quarantines_bad_rows(spark):
    d = tempfile.mkdtemp(prefix="pl-csv2-")
    with open(f"{d}/x.csv", "w") as f:
        f.write("event_id,device_id,ts,event_type,s04,s10,pred,machine_status\n")
        f.write("1,1,2024-01-01 00:00:00,click,1.0,2.0,0.0,NORMAL\n")
        f.write("2,1,garbage,click,1.0,2.0,0.0,NORMAL\n")
    good, bad = files.read_csv_typed(spark, d)
    assert good.count() == 1 and bad.count() == 1


def _readings(spark, rows):
    return spark.createDataFrame(rows, "event_id long, device_id long, ts timestamp_ntz, s04 double, s10 double, "
                                       "pred double")


def test_nan_reading_with_alert_is_unknown(spark):
    df = _readings(spark, [(1, 1, T0, float("nan"), 10.0, 1.0)]).withColumn("row_key", F.lit("k"))
    a = monitor.alerts(monitor.threshold_flags(df, D), D).first()
    assert a.vib_exceeded is False and a.reason == C.REASON_UNKNOWN


def test_threshold_exact_values_not_exceeded(spark):
    df = _readings(spark, [(1, 1, T0, 650.0, 45.0, 1.0)]).withColumn("row_key", F.lit("k"))
    a = monitor.alerts(df, D).first()
    assert a.reason == C.REASON_UNKNOWN


def test_recent_alert_exactly_300s_counts(spark):
    rows = [(1, 1, T0, 1.0, 1.0, 1.0), (2, 1, T0 + timedelta(seconds=300), 1.0, 1.0, 0.0),
            (3, 2, T0, 1.0, 1.0, 1.0), (4, 2, T0 + timedelta(seconds=300, microseconds=1), 1.0, 1.0, 0.0)]
    got = {r.event_id: r.recent_alerts for r in monitor.recent_alerts(_readings(spark, rows), D).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 0}


def test_short_history_is_padded(spark):
    rows = [(i, 1, T0 + timedelta(seconds=i), 600.0 + i, 41.0, 0.0) for i in range(3)]
    buf = sorted(monitor.waveform_last(_readings(spark, rows), 80, D).collect(), key=lambda r: r.pos)
    assert len(buf) == 80
    assert [r.s04 for r in buf[:77]] == [D.seed_s04] * 77 and [r.s10 for r in buf[:77]] == [D.seed_s10] * 77
    assert [r.s04 for r in buf[77:]] == [600.0, 601.0, 602.0]


def test_reconnects_only_from_offline(spark):
    s = spark.createDataFrame(
        [(1, 1, T0, "speed", True), (2, 2, T0, "speed", False), (3, 2, T0 + timedelta(seconds=1), "speed", True),
         (4, 3, T0, "speed", True), (5, 3, T0 + timedelta(seconds=1), "speed", True)],
        "event_id long, device_id long, ts timestamp_ntz, source string, online boolean")
    got = {r.device_id: r.total_reconnects for r in monitor.reconnect_count(s, D).collect()}
    assert got == {1: 0, 2: 1, 3: 0}


def test_mute_toggle_inside_and_at_end(spark):
    L = D.mute_s
    t = spark.createDataFrame(
        [(1, 1, T0), (2, 1, T0 + timedelta(seconds=100)), (3, 1, T0 + timedelta(seconds=200)),
         (4, 2, T0), (5, 2, T0 + timedelta(seconds=L))],
        "event_id long, device_id long, ts timestamp_ntz")
    st = {r.event_id: r.opens for r in eventlog.mute_windows(t, D).collect()}
    assert st == {1: True, 2: False, 3: True, 4: True, 5: True}
    win = sorted((r.device_id, r.start_ts, r.end_ts) for r in eventlog.windows_only(eventlog.mute_windows(t, D)).collect())
    assert win[0] == (1, T0, T0 + timedelta(seconds=100))
    assert win[1] == (1, T0 + timedelta(seconds=200), T0 + timedelta(seconds=200 + L))
    assert win[2] == (2, T0, T0 + timedelta(seconds=L))


def test_upsert_keeps_last_put(spark):
    path = work_path(spark, "t_upsert")
    b1 = spark.createDataFrame([("2024-01-01 00:00:00.000000", "wave", "s04", "1.0", 1)],
                               "row_key string, family string, qualifier string, value string, version long")
    b2 = spark.createDataFrame([("2024-01-01 00:00:00.000000", "wave", "s04", "2.0", 0),
                                ("2024-01-02 00:00:00.000000", "wave", "s04", "3.0", 5)],
                               "row_key string, family string, qualifier string, value string, version long")
    wide.upsert_cells(spark, path, b1, 1)
    wide.upsert_cells(spark, path, b2, 2)
    wide.upsert_cells(spark, path, b2, 2)   # replayed batch: same result
    got = sorted((r.row_key[:10], r.value) for r in wide.read_cells(spark, path).collect())
    assert got == [("2024-01-01", "2.0"), ("2024-01-02", "3.0")]


def test_null_pred_in_batch_source_is_unknown(spark):
    df = spark.createDataFrame([(1, 0.0), (1, 1.0), (1, 0.5), (1, None)], "device_id long, pred double")
    r = monitor.macro_counts(df).first()
    assert (r.normal, r.anomaly, r.unknown, r.total) == (1, 2, 1, 4)


def test_constant_feature_standardises_to_zero(spark):
    from pyspark.ml.functions import vector_to_array
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, b double")
    z = ml.standardize(df, ["a", "b"]).select(vector_to_array("features").alias("z")).collect()
    assert [r.z[1] for r in z] == [0.0, 0.0, 0.0]
    z2 = ml.standardize_columns(df, ["a", "b"]).collect()
    assert [r.b_z for r in z2] == [0.0, 0.0, 0.0]


def test_label_binary_null_status_is_one(spark):
    df = spark.createDataFrame([("NORMAL",), ("BROKEN",), (None,), ("normal",)], "machine_status string")
    assert [r.label for r in clean.label_binary(df).collect()] == [0, 1, 1, 1]


def test_fill_zero_numeric_only(spark):
    df = spark.createDataFrame([(None, float("nan"), None)], "a long, b double, c string")
    r = clean.fill_zero(df).first()
    assert (r.a, r.b, r.c) == (0, 0.0, None)


def test_device_state_precedence(spark):
    samples = spark.createDataFrame(
        [(10, 1, T0 + timedelta(seconds=1), 1.0, 700.25, 46.0), (11, 1, T0 + timedelta(seconds=3), 1.0, 1.0, 1.0),
         (12, 2, T0 + timedelta(seconds=1), 0.0, 1.0, 1.0)],
        "event_id long, device_id long, ts timestamp_ntz, pred double, s04 double, s10 double")
    status = spark.createDataFrame(
        [(1, 1, T0 + timedelta(seconds=2), "speed", False), (2, 1, T0 + timedelta(seconds=3), "batch", False)],
        "event_id long, device_id long, ts timestamp_ntz, source string, online boolean")
    rows = monitor.device_state(samples, status, D).collect()
    assert {r.event_id: r.state for r in rows} == {10: "ABNORMAL", 11: "INTERRUPTED", 12: "NORMAL"}
    texts = {r.event_id: r.state_text for r in rows}
    assert texts[10] == C.STATE_TEXT_ABNORMAL.format(s04=f"{700.25:.1f}", s10=f"{46.0:.1f}")
    assert texts[11] == C.STATE_TEXT_INTERRUPTED and texts[12] == C.STATE_TEXT_NORMAL


def test_auc_exact_matches_evaluator(spark):
    import random
    rnd = random.Random(3)
    rows = [(float(rnd.randint(0, 30)), int(rnd.random() < 0.3)) for _ in range(500)]
    df = spark.createDataFrame(rows, "score double, label int")
    got = ml.auc_exact(df, "score", "label").first().auc
    pos = [s for s, l in rows if l]
    neg = [s for s, l in rows if not l]
    exp = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(got - exp) < 1e-9


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(0.5, 1), (0.7, 1)], "score double, label int")
    assert ml.auc_exact(df, "score", "label").first().auc is None
    assert ml.auc_exact(df.limit(0), "score", "label").first().auc is None


def test_export_text_in_order(spark):
    lines = spark.createDataFrame([(1, i, f"line {i}") for i in range(1, 301)] + [(2, 1, "x")],
                                  "device_id long, line_no long, line string")
    path = work_path(spark, "t_export")
    eventlog.write_export(lines, path)
    import glob
    parts = sorted(glob.glob(f"{path.replace('file:', '')}/device_id=1/part-*"))
    text = [ln.rstrip("\n") for fp in parts for ln in open(fp, encoding="utf-8")]
    assert text == [f"line {i}" for i in range(1, 301)]


def test_export_of_many_devices_is_spread_over_tasks(spark):
    n = 2 * eventlog.EXPORT_DEVICES
    lines = spark.range(2 * n).select((F.col("id") % n).alias("device_id"), F.floor(F.col("id") / n).alias("line_no"),
                                      F.concat_ws(" ", "id", F.lit("x")).alias("line"))
    path = work_path(spark, "export_many")
    eventlog.write_export(lines, path)
    back = spark.read.text(path).select("device_id", "value", F.regexp_extract(F.input_file_name(), r"/(part-\d+)", 1).alias("part"))
    assert back.select("part").distinct().count() >= 2
    assert {(r[0], r[1]) for r in back.collect()} == {(i % n, f"{i} x") for i in range(2 * n)}


def test_write_with_metrics_counts_in_one_pass(spark):
    df = spark.createDataFrame([("NORMAL",), ("BROKEN",), (None,), ("NORMAL",)], "machine_status string")
    df = df.union(spark.createDataFrame([("MAINT",), ("MAINT",)], "machine_status string"))
    m = {r.machine_status: r.n_rows for r in clean.write_with_metrics(df, work_path(spark, "t_metrics")).collect()}
    assert m == {"NORMAL": 2, "BROKEN": 1, None: 1, "MAINT": 2}


def test_auc_exact_equals_mllib_evaluator_on_model(spark):
    from pumpline.sources import testdata as td
    from tests.conftest import SF_SMALL
    w = ml.hash_split(td.wide_features(spark, SF_SMALL), "row_id")
    model = ml.fit_rf(w.filter("split = 'train'"), td.FEATURES_W, D.with_(num_trees=5, max_depth=3))
    scored = ml.score(model, w.filter("split = 'test'"))
    scored = scored.persist()
    ours = ml.auc_exact(scored, "raw_score", "label").first().auc
    theirs = ml.evaluator_auc(scored)
    scored.unpersist()
    assert abs(ours - theirs) < 1e-6, (ours, theirs)
    assert ours > 0.9, ours   # the derived label is learnable


def test_global_waveform_pads_short_history(spark):
    rows = [(i, i % 2, T0 + timedelta(seconds=i), 600.0 + i, 41.0, 0.0) for i in range(3)]
    buf = sorted(monitor.waveform_last_global(_readings(spark, rows), 80, D).collect(), key=lambda r: r.pos)
    assert len(buf) == 80 and [r.s04 for r in buf[:77]] == [D.seed_s04] * 77
    assert [r.s04 for r in buf[77:]] == [600.0, 601.0, 602.0]


CELL = "row_key string, family string, qualifier string, value string, version long"


def _cells(spark, *rows):
    return spark.createDataFrame([(f"2024-01-0{d} 00:00:00.000000", "wave", "s04", v, n) for d, v, n in rows], CELL)


def _table(spark, path, **kw):
    return sorted((r.row_key[9], r.value) for r in wide.read_cells(spark, path, **kw).collect())


def test_upsert_survives_a_cut_between_its_steps(spark, monkeypatch):
    path = work_path(spark, "t_cut")
    wide.upsert_cells(spark, path, _cells(spark, (1, "1.0", 1)), 1)

    def cut(*args):
        raise RuntimeError("cut")

    with monkeypatch.context() as m:
        m.setattr(wide, "_commit", cut)
        with pytest.raises(RuntimeError):
            wide.upsert_cells(spark, path, _cells(spark, (1, "2.0", 2), (2, "2.0", 2)), 2)
        with pytest.raises(RuntimeError):
            wide.compact_cells(spark, path)
    assert _table(spark, path) == [("1", "1.0")]  # what was not committed is not there
    wide.upsert_cells(spark, path, _cells(spark, (1, "2.0", 2), (2, "2.0", 2)), 2)
    assert _table(spark, path) == [("1", "2.0"), ("2", "2.0")]


def test_upsert_late_replay_and_compaction_change_nothing(spark):
    path = work_path(spark, "t_replay")
    old = _cells(spark, (1, "1.0", 9), (3, "1.0", 9))
    wide.upsert_cells(spark, path, old, 1)
    wide.upsert_cells(spark, path, _cells(spark, (1, "2.0", 0)), 2)
    wide.upsert_cells(spark, path, old, 1)
    want = [("1", "2.0"), ("3", "1.0")]
    assert _table(spark, path) == want
    wide.compact_cells(spark, path)
    assert _table(spark, path) == want
    wide.upsert_cells(spark, path, _cells(spark, (2, "5.0", 1)), 3)
    assert _table(spark, path) == [("1", "2.0"), ("2", "5.0"), ("3", "1.0")]
    assert _table(spark, path, dates=["2024-01-02"]) == [("2", "5.0")]
    plan = wide.read_cells(spark, path, dates=["2024-01-02"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [") >= 2 and plan.count("2024-01-02") >= 2  # base and batches


def test_unreadable_table_is_an_error_not_an_empty_table(spark):
    path = work_path(spark, "t_bad")
    spark.createDataFrame([("not a commit",)], "x string").write.text(f"{path}/commits/batch-1")
    with pytest.raises(Exception):
        wide.upsert_cells(spark, path, _cells(spark, (1, "1.0", 1)), 1)


def test_upsert_keeps_devices_apart(spark):
    df = spark.createDataFrame([(1, T0), (2, T0), (None, T0)], "device_id long, ts timestamp_ntz")
    keys = [r[0] for r in df.select(X.row_key("ts", "device_id")).collect()]
    assert len(set(keys)) == 3 and keys[2] is None and keys[0].startswith(f"{T0:%Y-%m-%d}")


def test_rolling_stats_on_fine_values_and_nan(spark):
    rows = [(i, 1, T0 + timedelta(seconds=i), 634.3756, 41.25, 0.0) for i in range(100)]
    r = monitor.rolling_stats(_readings(spark, rows), 80, D, chunk_rows=90).collect()
    assert all(abs(x.avg_s04 - 634.3756) < 1e-9 and x.avg_s10 == 41.25 for x in r)
    rows = [(i, 1, T0 + timedelta(seconds=i), float("nan") if i == 1 else 1.0, 1.0, 0.0) for i in range(4)]
    got = {x.event_id: x.avg_s04 for x in monitor.rolling_stats(_readings(spark, rows), 2, D).collect()}
    assert got[0] == 1.0 and got[1] != got[1] and got[2] != got[2] and got[3] == 1.0


def test_forest_does_not_follow_the_layout(spark):
    from pumpline.sources import testdata as td
    from tests.conftest import SF_SMALL
    w = ml.hash_split(td.wide_features(spark, SF_SMALL), "row_id").limit(2000).persist()
    p = D.with_(num_trees=3, max_depth=3)
    scores = []
    for n in (1, 9):
        model = ml.fit_rf(w.repartition(n), td.FEATURES_W, p, key="row_id")
        scores.append({r.row_id: r.score for r in ml.score(model, w).select("row_id", "score").collect()})
    w.unpersist()
    assert scores[0] == scores[1]


def test_forest_scores_in_a_session_that_has_observed(spark):
    from pyspark.sql import Observation
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 3}
    rows = spark.range(200).select("id", (F.col("id") % 10).cast("double").alias("x"), (F.col("id") % 10 >= 5).cast("int").alias("label"))
    model = ml.fit_rf(rows, ["x"], D.with_(num_trees=3, max_depth=2), key="id")
    assert ml.score(model, rows).filter("prediction = label").count() == 200


def test_sample_at_the_instant_of_a_press_comes_before_it(spark):
    L = D.mute_s
    press = spark.createDataFrame([(1, 1, T0), (2, 1, T0 + timedelta(seconds=100))], "event_id long, device_id long, ts timestamp_ntz")
    at = [0, 50, 100, 101]
    points = spark.createDataFrame([(10 + s, 1, T0 + timedelta(seconds=s)) for s in at], "event_id long, device_id long, ts timestamp_ntz")
    got = {r.event_id - 10: r.mute_until for r in eventlog.muted_until(points, eventlog.mute_windows(press, D), D).collect()}
    until = T0 + timedelta(seconds=L)
    assert got == {0: None, 50: until, 100: until, 101: None}


def test_interval_join_is_half_open(spark):
    iv = spark.createDataFrame([(1, T0, T0 + timedelta(seconds=10)), (1, T0 + timedelta(seconds=10), T0 + timedelta(seconds=20))],
                               "device_id long, start_ts timestamp_ntz, end_ts timestamp_ntz")
    pts = spark.createDataFrame([(s, 1, T0 + timedelta(seconds=s)) for s in (-1, 0, 9, 10, 20)] + [(99, 2, T0)],
                                "event_id long, device_id long, ts timestamp_ntz")
    got = {r.event_id: r.interval_start for r in eventlog.interval_join(pts, iv, D).collect()}
    assert got == {-1: None, 0: T0, 9: T0, 10: T0 + timedelta(seconds=10), 20: None, 99: None}


def test_external_database_is_dropped(spark):
    from pumpline.sources import files
    loc, db = work_path(spark, "t_ext"), "t_pumpline_drop"
    spark.range(3).write.parquet(loc)
    for _ in range(2):
        t = files.create_external_table(spark, db, "ids", loc, work_path(spark, "t_db"), "id BIGINT")
    assert t.count() == 3
    spark.sql(f"DROP DATABASE {db} CASCADE")
    assert spark.read.parquet(loc).count() == 3  # the files are not the catalog's


def test_late_batch_below_a_base_is_read(spark):
    path = work_path(spark, "t_late_batch")
    wide.upsert_cells(spark, path, _cells(spark, (1, "1.0", 1)), 1)
    wide.upsert_cells(spark, path, _cells(spark, (3, "3.0", 1)), 3)
    assert wide.compact_cells(spark, path) and not wide.compact_cells(spark, path)
    wide.upsert_cells(spark, path, _cells(spark, (1, "2.0", 1), (2, "2.0", 1), (3, "2.0", 9)), 2)  # older than the base's last batch
    want = {"1.0": 0, "2.0": 2, "3.0": 1}
    for _ in range(2):
        values = [r.value for r in wide.read_cells(spark, path).collect()]
        assert {v: values.count(v) for v in want} == want  # batch 2 wins over 1 and loses to 3
        assert wide.compact_cells(spark, path, least=2) is False
    assert wide.compact_cells(spark, path)
    wide.upsert_cells(spark, path, _cells(spark, (3, "9.0", 9)), 2)  # a replay
    assert sorted(r.value for r in wide.read_cells(spark, path).collect()) == ["2.0", "2.0", "3.0"]


def test_null_poll_keys_compare_as_equal(spark):
    from datetime import datetime, timedelta

    t = datetime(2024, 1, 1)
    rows = [(dev, i, t + timedelta(minutes=i), k) for dev in (1, None) for i, k in enumerate(["a", None, None, "a", "a", None], start=1)]
    df = spark.createDataFrame(rows, "device_id long, event_id long, ts timestamp_ntz, poll_key string")
    got = monitor.dedupe_consecutive(df).collect()
    for dev in (1, None):
        assert sorted(r.event_id for r in got if r.device_id == dev) == [1, 2, 4, 6]


def test_clear_of_a_device_without_id(spark):
    from datetime import datetime

    at = lambda h: datetime(2024, 1, 1, h)
    lines = spark.createDataFrame([(d, at(h), 0, h, f"{d}-{h}") for d in (1, None) for h in (1, 2, 3)],
                                  "device_id long, ts timestamp_ntz, seq int, event_id long, line string")
    clears = spark.createDataFrame([(d, at(2), 0) for d in (1, None)], "device_id long, ts timestamp_ntz, event_id long")
    assert sorted(r.line for r in eventlog.since_last_clear(lines, clears).collect()) == ["1-3", "None-3"]
    assert sorted(r.line for r in eventlog.after_clear(lines, clears).collect()) == ["1-2", "1-3", "None-2", "None-3"]
