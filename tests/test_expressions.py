"""Scalar expressions against the dashboard's Python semantics."""

import math
from datetime import datetime

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from pumpline import config as C
from pumpline.functions import expressions as X


def _fixed1_spark(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    return [r[0] for r in df.select(X.fixed1("x")).collect()]


def test_fixed1_matches_python_on_ties(spark):
    vals = [6.55, 6.45, 0.25, 0.75, 0.05, 0.15, 2.5, 1.05, -6.55, -0.04, 0.0, -0.0, 123.45, 489.95, 1e-7, 99.99]
    assert _fixed1_spark(spark, vals) == [f"{v:.1f}" for v in vals]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=1, max_size=50))
def test_fixed1_matches_python_random(spark, vals):
    assert _fixed1_spark(spark, vals) == [f"{v:.1f}" for v in vals]


def test_fixed1_two_decimal_grid(spark):
    vals = [i / 100 for i in range(0, 50000, 7)]
    assert _fixed1_spark(spark, vals) == [f"{v:.1f}" for v in vals]


def test_thresholds_are_strict_and_nan_safe(spark):
    rows = [(650.0, 45.0), (650.0000001, 45.0000001), (float("nan"), float("nan")), (None, None)]
    df = spark.createDataFrame(rows, "s04 double, s10 double")
    got = df.select(X.exceeds("s04", 650.0).alias("a"), X.exceeds("s10", 45.0).alias("b")).collect()
    assert [(r.a, r.b) for r in got] == [(False, False), (True, True), (False, False), (False, False)]


def test_alert_reason_texts(spark):
    rows = [(700.0, 50.0), (700.0, 10.0), (10.0, 50.0), (10.0, 10.0), (float("nan"), 10.0)]
    df = spark.createDataFrame(rows, "s04 double, s10 double")
    got = [r[0] for r in df.select(X.alert_reason("s04", "s10", 650.0, 45.0)).collect()]
    assert got == [C.REASON_VIBRATION + " + " + C.REASON_TEMPERATURE, C.REASON_VIBRATION,
                   C.REASON_TEMPERATURE, C.REASON_UNKNOWN, C.REASON_UNKNOWN]


def test_alert_message_format(spark):
    df = spark.createDataFrame([("k1", 6.55, 45.25)], "row_key string, s04 double, s10 double")
    got = df.select(X.alert_message(F.lit(C.REASON_UNKNOWN), "row_key", "s04", "s10")).first()[0]
    assert got == f"{C.ALERT_PREFIX}{C.REASON_UNKNOWN} | key=k1 | S04={6.55:.1f} | S10={45.25:.1f}"


def test_clock_text_truncates_millis(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 12, 34, 56, 999999),)], "ts timestamp_ntz")
    assert df.select(X.clock_text("ts")).first()[0] == "12:34:56.999"


def test_remaining_text(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 0, 5, 0), datetime(2024, 1, 1, 0, 0, 0, 500000))],
                               "until timestamp_ntz, now timestamp_ntz")
    assert df.select(X.remaining_text("until", "now")).first()[0] == "04:59"


def test_epoch_micros_is_zone_free(spark):
    df = spark.createDataFrame([(datetime(2024, 3, 10, 2, 30, 0, 123456),)], "ts timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        got = df.select(X.epoch_micros("ts")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    expect = int((datetime(2024, 3, 10, 2, 30, 0, 123456) - datetime(1970, 1, 1)).total_seconds() * 1e6)
    assert abs(got - expect) <= 1 and not math.isnan(got)


def test_fixed1_of_huge_values_does_not_fail(spark):
    vals = [9e17, 1e18, 1e19, 4503599627370496.0, -4503599627370497.0, 1e30, float("inf")]
    got = _fixed1_spark(spark, vals)
    assert got[:5] == [f"{v:.1f}" for v in vals[:5]] and got[5] == "1" + "0" * 30 + ".0" and got[6] == "inf"


def test_epoch_micros_is_exact(spark):
    from datetime import datetime, timedelta
    ts = [datetime(1970, 1, 1), datetime(2024, 2, 29, 23, 59, 59, 999999), datetime(1969, 12, 31, 23, 59, 59, 1), datetime(2024, 3, 10, 2, 30, 0, 7)]
    df = spark.createDataFrame([(t,) for t in ts], "ts timestamp_ntz")
    assert [r[0] for r in df.select(X.epoch_micros("ts")).collect()] == [(t - datetime(1970, 1, 1)) // timedelta(microseconds=1) for t in ts]
