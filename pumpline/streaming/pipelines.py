"""Speed layer on Structured Streaming.

The stream operators reuse the batch column logic (parse, classify, format).
Per-device sequential state (as-of feed status, counters, mute windows, the event
log) runs in ``applyInPandasWithState`` through ``ordered``: arrival order does not
matter, because rows wait in the state until the watermark has passed them and are
then folded in event-time order; rows behind the watermark are dropped, rows without
a device are one more device, as in the batch forms.  A call
sees one group of devices' rows of one micro-batch and what waits, so its size is bounded
by the trigger's admission limit and the watermark delay, never by the table.

Event time: the tables carry TIMESTAMP_NTZ, and watermarks need TIMESTAMP.
``event_time`` reads the wall time as a UTC instant (no session-zone shift), so
windows and watermarks behave the same in every session time zone.
"""

from __future__ import annotations

import bisect
import json
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pumpline.config import DEFAULT_PARAMS, Params
from pumpline.functions import expressions as X
from pumpline.operators import clean, eventlog, monitor
from pumpline.sources import wide

DEV = "device_id"


def event_time(ts_ntz) -> Column:
    return F.timestamp_micros(X.epoch_micros(ts_ntz))


def instant_to_ntz(ts) -> Column:
    """TIMESTAMP -> TIMESTAMP_NTZ of its UTC wall time, independent of the session zone."""
    us = F.unix_micros(F.col(ts) if isinstance(ts, str) else ts)
    days = F.floor(us / F.lit(86_400_000_000)).cast("int")
    rest = (us - days.cast("long") * 86_400_000_000).cast("decimal(18,6)") / F.lit(1_000_000)
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(days, F.lit(0), F.lit(0), rest)


# Tests and backfills drain what is there; a live batch view would pass
# {"processingTime": "30 seconds"}, a speed view {"processingTime": "100 milliseconds"}.
DRAIN = {"availableNow": True}


def run_to_files(stream: DataFrame, out: str, checkpoint: str, mode: str = "append",
                 trigger: dict | None = None):
    """File sink (exactly once through its commit log).  With the default drain
    trigger the call returns when the input is consumed; otherwise it returns the
    running query."""
    trig = trigger or DRAIN
    q = (stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint)
         .trigger(**trig).start(out))
    if trig is DRAIN or trig == DRAIN:
        q.awaitTermination()
    return q


def run_foreach_batch(stream: DataFrame, out: str, checkpoint: str, mode: str = "update",
                      trigger: dict | None = None):
    """Each micro-batch lands under ``batch=<id>`` with overwrite: a replayed batch
    after a restart rewrites the same folder, so the sink is idempotent."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    trig = trigger or DRAIN
    q = (stream.writeStream.foreachBatch(sink).outputMode(mode).option("checkpointLocation", checkpoint)
         .trigger(**trig).start())
    if trig is DRAIN or trig == DRAIN:
        q.awaitTermination()
    return q


def latest_per_key(spark: SparkSession, out: str, keys: list[str]) -> DataFrame:
    """Final state of an update-mode sink: the newest batch's row per key."""
    d = spark.read.parquet(out)
    cols = [c for c in d.columns if c not in (*keys, "batch")]
    last = F.max_by(F.struct(*cols), F.col("batch"))
    return d.groupBy(*keys).agg(last.alias("_l")).select(*keys, *[F.col(f"_l.{c}").alias(c) for c in cols])


# --- F1 / F9: alerts ----------------------------------------------------------------

def alert_stream(text_rows: DataFrame, p: Params = DEFAULT_PARAMS, delay: str = "1 hour") -> DataFrame:
    """Speed-layer alert pipeline: decode -> dedupe by device and key -> classify -> message.

    Devices that report at the same instant share the key text, so the device is
    part of what makes a reading the same.
    """
    parsed = clean.good_rows(clean.parse_reject(text_rows))
    deduped = (parsed.withColumn("_et", event_time("ts")).withWatermark("_et", delay)
               .dropDuplicatesWithinWatermark([DEV, "row_key"]))
    return monitor.alerts(deduped, p).select("event_id", DEV, "message")


# --- F2: lateness -------------------------------------------------------------------

def daily_counts_stream(readings: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Per device and day counts; rows behind the watermark are dropped."""
    return (readings.withColumn("_et", event_time("ts")).withWatermark("_et", delay)
            .groupBy(DEV, F.window("_et", "1 day").alias("w")).agg(F.count(F.lit(1)).alias("n_rows"))
            .select(DEV, F.date_from_unix_date(F.floor(F.unix_micros("w.start") / F.lit(86_400_000_000)).cast("int"))
                    .alias("day"), "n_rows"))


# --- F3: conflation ----------------------------------------------------------------

def conflate_stream(readings: DataFrame, p: Params = DEFAULT_PARAMS, delay: str = "1 hour") -> DataFrame:
    """One refresh per device and event-time tick: the tick's newest sample.

    Ticks are tumbling event-time windows, so the result does not depend on how
    arrivals are cut into micro-batches (see ``conflate_batches`` for the
    arrival-based form).  Run in update mode; the sink keeps the latest row per
    (device, tick).
    """
    last = F.max_by(F.struct("event_id", "ts", "s04", "s10", "pred"), F.struct("ts", "event_id"))
    return (readings.withColumn("_et", event_time("ts")).withWatermark("_et", delay)
            .groupBy(DEV, F.window("_et", f"{int(p.tick_ms)} milliseconds").alias("w")).agg(last.alias("_l"))
            .select(DEV, instant_to_ntz("w.start").alias("tick_start"),
                    *[F.col(f"_l.{c}").alias(c) for c in ("event_id", "ts", "s04", "s10", "pred")]))


def conflate_batches(out: str):
    """foreachBatch body for arrival-based conflation: newest sample per device
    per micro-batch (the admission limit plays the role of the drain cap)."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        (monitor.latest_per_device(batch).withColumn("batch", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").parquet(f"{out}/b={batch_id}"))
    return sink


# --- F5: sliding alert counts ---------------------------------------------------------

def sliding_alerts_stream(readings: DataFrame, window_s: int, slide_s: int, p: Params = DEFAULT_PARAMS,
                          delay: str = "1 hour") -> DataFrame:
    a = readings.filter(X.is_alert("pred", p.alert_pred))
    return (a.withColumn("_et", event_time("ts")).withWatermark("_et", delay)
            .groupBy(DEV, F.window("_et", f"{window_s} seconds", f"{slide_s} seconds").alias("w"))
            .agg(F.count(F.lit(1)).alias("alerts"))
            .select(DEV, instant_to_ntz("w.start").alias("window_start"), "alerts"))


# --- ordered state per device -------------------------------------------------------

Fold = Callable[[pd.DataFrame, dict, int], tuple[pd.DataFrame | None, int | None]]
#: Marks a row that only moves the watermark.  A stream may carry the column or not.
CLOSING = "_closing"
#: Groups of devices.  A call of the state function costs some milliseconds whatever it
#: holds, so it gets a group of devices, not one.  Fixed for the life of a checkpoint.
DEVICE_GROUPS = 512
WAITING_STATE = T.StructType([T.StructField("waiting", T.BinaryType()), T.StructField("folded", T.StringType())])


def _closing(rows: DataFrame) -> Column:
    return F.coalesce(F.col(CLOSING), F.lit(False)) if CLOSING in rows.columns else F.lit(False)


def _packed(rows: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(rows, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as w:
        w.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(raw: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(raw).read_all().to_pandas()


def _devices(rows: pd.DataFrame) -> list[int | None]:
    return [None if nobody else key for nobody, key in zip(rows["_nobody"].tolist(), rows["_key"].tolist())]


def _ids(values) -> pd.Series:
    """A column of whole numbers or nulls for the output."""
    return pd.Series(pd.array(values, dtype="Int64"))


def _ordered_fn(fold: Fold, order: list[str]):
    """State function: keeps rows until the watermark passes them, then folds them in order.

    ``fold(rows, folded, passed_us)`` gets the rows of a group of devices with ``_us``
    below the watermark, in order.  ``folded`` holds what is kept by device; the fold
    changes it in place.  It returns the output (or None) and the next moment in
    microseconds at which it wants to be called without rows, or None.
    """
    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        waiting, folded = (None, {})
        if state.exists:
            raw, text = state.get
            folded = dict(json.loads(text))
            if raw:
                waiting = _unpacked(bytes(raw))
        passed = state.getCurrentWatermarkMs() * 1000
        if not state.hasTimedOut:
            new = pd.concat(list(pdfs), ignore_index=True)
            new = new[(new["_us"] >= passed) & ~new[CLOSING].astype(bool)]  # rows behind the watermark are late
            new = new.drop(columns=[CLOSING, "_et", "_group", "_eventless"]).assign(
                _us=new["_us"].astype("int64"), event_id=new["event_id"].astype("Int64").mask(new["_eventless"].astype(bool)))
            waiting = new if waiting is None else pd.concat([waiting, new], ignore_index=True)
        rows = pd.DataFrame()
        if waiting is not None:
            due = waiting["_us"] < passed
            rows, waiting = waiting[due].sort_values(order, kind="stable", ignore_index=True), waiting[~due]
        out, wake = fold(rows, folded, passed) if len(rows) or folded else (None, None)
        blob = None
        if waiting is not None and len(waiting):
            blob = _packed(waiting)
            first = int(waiting["_us"].min())
            wake = first if wake is None else min(wake, first)
        state.update((blob, json.dumps(list(folded.items()))))
        if wake is not None:
            state.setTimeoutTimestamp(max(wake // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        if out is not None and len(out):
            yield out
    return fn


def ordered(rows: DataFrame, fold: Fold, order: list[str], out: T.StructType, delay: str, mode: str = "append",
            groups: int = DEVICE_GROUPS) -> DataFrame:
    """Fold each device's rows (columns device_id, ts, event_id, ...) in event-time order as the watermark passes them.

    The state is held by group of devices (a hash of the device), the fold keeps the
    devices of its group apart.  Rows without a device are folded together, under the
    device None.  Rows marked ``CLOSING`` move the watermark and nothing else.
    """
    d = (rows.withColumn(CLOSING, _closing(rows)).withColumn("_us", X.epoch_micros("ts"))
         .withColumn("_et", event_time("ts")).withWatermark("_et", delay))
    # two plain columns each, so that no number stands for "none" and none is rounded next to it
    keyed = (d.withColumn("_nobody", F.col(DEV).isNull()).withColumn("_key", F.coalesce(F.col(DEV), F.lit(0)).cast("long"))
             .withColumn("_eventless", F.col("event_id").isNull()).withColumn("event_id", F.coalesce(F.col("event_id"), F.lit(0)).cast("long")))
    return keyed.withColumn("_group", F.pmod(F.xxhash64("_nobody", "_key"), F.lit(groups))).groupBy("_group").applyInPandasWithState(
        _ordered_fn(fold, order), out, WAITING_STATE, mode, GroupStateTimeout.EventTimeTimeout)


def mixed_feed(samples: DataFrame, status: DataFrame, feed: str | None = "speed") -> DataFrame:
    """One stream of status rows (_kind 0) and samples (_kind 1)."""
    st = status if feed is None else status.filter(F.col("source") == feed)
    nul = F.lit(None).cast("double")
    st = st.select(DEV, "ts", "event_id", F.lit(0).alias("_kind"), "source", "online",
                   nul.alias("pred"), nul.alias("s04"), nul.alias("s10"))
    sm = samples.select(DEV, "ts", "event_id", F.lit(1).alias("_kind"), F.lit(None).cast("string").alias("source"),
                        F.lit(None).cast("boolean").alias("online"), "pred", "s04", "s10")
    return st.unionByName(sm)


MIXED_ORDER = ["_us", "_kind", "event_id"]


# --- F4: device state ------------------------------------------------------------------

STATE_OUT = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField(DEV, T.LongType()),
    T.StructField("ts", T.TimestampNTZType()), T.StructField("online_asof", T.BooleanType()),
    T.StructField("state", T.StringType()), T.StructField("s04", T.DoubleType()), T.StructField("s10", T.DoubleType())])


def device_state_stream(mixed: DataFrame, p: Params = DEFAULT_PARAMS, delay: str = "1 hour") -> DataFrame:
    """``mixed``: status rows and samples of one feed.  The label text is built by the batch formatter."""
    alert = float(p.alert_pred)

    def fold(rows, folded, passed):
        if not len(rows):
            return None, None
        asof = []  # tri-state feed status: True, False or not known yet
        for dev, kind, online in zip(_devices(rows), rows["_kind"].tolist(), rows["online"].tolist()):
            if kind == 0 and online in (True, False):
                folded[dev] = bool(online)
            asof.append(folded.get(dev))
        is_sample = (rows["_kind"] == 1).to_numpy()
        smp, on = rows[is_sample], pd.Series(pd.array(asof, dtype="boolean"))[is_sample]
        state = np.where((on == False).fillna(False), "INTERRUPTED", np.where(smp["pred"] == alert, "ABNORMAL", "NORMAL"))  # noqa: E712
        return pd.DataFrame({"event_id": _ids(smp["event_id"]).array, DEV: _ids(_devices(smp)).array, "ts": smp["ts"].array,
                             "online_asof": on.array, "state": state, "s04": smp["s04"].array, "s10": smp["s10"].array}), None

    out = ordered(mixed, fold, MIXED_ORDER, STATE_OUT, delay)
    return out.withColumn("state_text", X.state_text("state", "s04", "s10")).drop("s04", "s10")


# --- F6: counters -------------------------------------------------------------------------

COUNTER_OUT = T.StructType([
    T.StructField(DEV, T.LongType()), T.StructField("session_alerts", T.LongType()),
    T.StructField("total_reconnects", T.LongType())])


def counters_stream(mixed: DataFrame, p: Params = DEFAULT_PARAMS, delay: str = "1 hour") -> DataFrame:
    """Session alert count and reconnect count per device (``lag`` is not allowed on streams)."""
    alert = float(p.alert_pred)

    def fold(rows, folded, passed):
        if not len(rows):
            return None, None
        touched = _devices(rows)
        for dev, kind, source, online, pred in zip(touched, *(rows[c].tolist() for c in ("_kind", "source", "online", "pred"))):
            own = folded.setdefault(dev, {"alerts": 0, "reconnects": 0, "last": {}})
            if kind == 1:
                own["alerts"] += pred == alert
            elif isinstance(source, str):
                own["reconnects"] += own["last"].get(source) is False and bool(online)
                own["last"][source] = bool(online)
        touched = list(dict.fromkeys(touched))
        return pd.DataFrame({DEV: _ids(touched), "session_alerts": [folded[d]["alerts"] for d in touched],
                             "total_reconnects": [folded[d]["reconnects"] for d in touched]}), None

    return ordered(mixed, fold, MIXED_ORDER, COUNTER_OUT, delay, mode="update")


# --- F5: exact trailing count, with the moments at which it falls -------------------------

RECENT_OUT = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField(DEV, T.LongType()),
    T.StructField("at_us", T.LongType()), T.StructField("recent_alerts", T.LongType())])


def recent_alerts_exact_stream(readings: DataFrame, p: Params = DEFAULT_PARAMS, delay: str = "1 hour") -> DataFrame:
    """Exact trailing alert count at every sample, and at every moment an alert leaves the horizon.

    The second kind of row (event_id NULL) comes from an event-time timer: the
    count falls without any new sample.  The state keeps the alerts younger than
    the horizon, so it is bounded by the alert rate times the horizon.
    """
    horizon, alert = int(p.recent_horizon_s) * 1_000_000, float(p.alert_pred)

    def fold(rows, folded, passed):
        asked = {}  # the samples by device
        if len(rows):
            for dev, us, event, pred in zip(_devices(rows), rows["_us"].tolist(), rows["event_id"].tolist(), rows["pred"].tolist()):
                asked.setdefault(dev, []).append((us, event))
                if pred == alert:
                    folded.setdefault(dev, []).append(us)
        out, wake = [], None
        for dev in list(dict.fromkeys([*asked, *folded])):
            times = sorted(folded.get(dev, ()))
            live = bisect.bisect_left(times, passed - horizon - 1)
            gone = [(us + horizon + 1, None) for us in dict.fromkeys(times[:live])]  # the first microsecond without it
            # alerts in [now - horizon, now]; peers at the same instant count (range frame)
            out += [(event, dev, at, bisect.bisect_right(times, at) - bisect.bisect_left(times, at - horizon))
                    for at, event in asked.get(dev, []) + gone]
            folded[dev] = times[live:]
            if folded[dev]:
                fall = folded[dev][0] + horizon + 2
                wake = fall if wake is None else min(wake, fall)
            else:
                del folded[dev]
        if not out:
            return None, wake
        event, dev, at, n = zip(*out)
        return pd.DataFrame({"event_id": _ids(event), DEV: _ids(dev), "at_us": at, "recent_alerts": n}), wake

    out = ordered(readings.select(DEV, "ts", "event_id", "pred", _closing(readings).alias(CLOSING)), fold, ["_us", "event_id"], RECENT_OUT, delay)
    return out.withColumn("ts", instant_to_ntz(F.timestamp_micros("at_us"))).drop("at_us")


# --- F7 / F8: mute windows and the event log ----------------------------------------------

WINDOW_OUT = T.StructType([T.StructField(DEV, T.LongType()), T.StructField("start_us", T.LongType()), T.StructField("end_us", T.LongType())])


def mute_windows_stream(toggles: DataFrame, p: Params = DEFAULT_PARAMS, delay: str = "1 hour") -> DataFrame:
    """Closed mute windows (device_id, start_ts, end_ts): by the next press, or by themselves through a timer."""
    span = int(p.mute_s) * 1_000_000

    def fold(rows, folded, passed):
        done = []
        for dev, us in zip(_devices(rows), rows["_us"].tolist()) if len(rows) else ():
            start = folded.pop(dev, None)
            if start is not None and us < start + span:
                done.append((dev, start, us))
            else:
                if start is not None:
                    done.append((dev, start, start + span))
                folded[dev] = us
        for dev, start in list(folded.items()):
            if start + span < passed:
                done.append((dev, start, start + span))
                del folded[dev]
        wake = min(folded.values()) + span + 1 if folded else None
        if not done:
            return None, wake
        dev, start, end = zip(*done)
        return pd.DataFrame({DEV: _ids(dev), "start_us": start, "end_us": end}), wake

    out = ordered(toggles.select(DEV, "ts", "event_id", _closing(toggles).alias(CLOSING)), fold, ["_us", "event_id"], WINDOW_OUT, delay)
    at = lambda c: instant_to_ntz(F.timestamp_micros(c))
    return out.select(DEV, at("start_us").alias("start_ts"), at("end_us").alias("end_ts"))


#: Order of a device's rows at one instant: the place of their records in the log.
FEED_PLACE = {"status": 0, "sample": 1, "press": 2, "clear": 3, "export": 4}


def event_log_stream(rows: DataFrame, p: Params = DEFAULT_PARAMS, delay: str = "1 hour") -> DataFrame:
    """The event log of a ``feed`` stream: the same records as the batch ``event_log``.

    The state holds the open mute window, the counts by class, and whether the
    device has been seen; it only marks the rows.  The records and their texts are
    built from the marked rows by the batch expressions.
    """
    span, keep = int(p.mute_s) * 1_000_000, [f for f in rows.schema.fields if f.name != CLOSING]
    marks = [T.StructField("opens", T.BooleanType()), T.StructField("muted", T.BooleanType()), T.StructField("first", T.BooleanType()),
             T.StructField("normal", T.LongType()), T.StructField("anomaly", T.LongType())]
    names = [f.name for f in keep]
    n_sample, n_press = FEED_PLACE["sample"], FEED_PLACE["press"]

    def fold(rows, folded, passed):
        if not len(rows):
            return None, None
        devices, seen = _devices(rows), []
        good = ((rows["_place"] == n_sample) & rows["reason"].isna()).tolist()
        for dev, place, us, ok, pred in zip(devices, rows["_place"].tolist(), rows["_us"].tolist(), good, rows["pred_num"].tolist()):
            first = dev not in folded
            until, normal, anomaly = folded.get(dev, (0, 0, 0))
            muted, opens = until > us, None
            if place == n_press:
                until = 0 if muted else us + span
                opens = until > 0
            normal, anomaly = normal + (ok and pred == 0), anomaly + (ok and pred != 0)
            folded[dev] = (until, normal, anomaly)
            seen.append((opens, muted, first, normal, anomaly))
        out = rows[names].copy()
        out[DEV], out["event_id"] = _ids(devices), _ids(out["event_id"])
        opens, out["muted"], out["first"], out["normal"], out["anomaly"] = zip(*seen)
        out["opens"] = pd.array(opens, dtype="boolean")
        return out, None

    place = F.lit(None).cast("int")
    for kind, n in FEED_PLACE.items():
        place = F.when(F.col("kind") == kind, n).otherwise(place)
    marked = ordered(rows.withColumn("_place", place), fold, ["_us", "_place", "event_id"], T.StructType([*keep, *marks]), delay)
    return eventlog.records_of_marked(marked, p)


# --- C3: points and intervals, both streams -------------------------------------------

def interval_join_stream(points: DataFrame, intervals: DataFrame, longest_s: int, delay: str) -> DataFrame:
    """``eventlog.interval_join`` of two streams: each point with the interval that holds it, or none.

    ``intervals`` (device_id, start_ts, end_ts) of a device do not overlap and last at
    most ``longest_s``; one without an end holds nothing.  The join's key is the device and a time bucket as wide as
    that, so a device's rows are spread over time; an interval goes to the one or two
    buckets it touches.  Both sides have a watermark: an unmatched point comes out,
    and its state goes, once no interval that could hold it can still arrive.
    """
    wide_us = int(longest_s) * 1_000_000
    bucket = lambda us: F.floor(us / F.lit(wide_us)).cast("long")
    key = lambda b: F.struct(F.col(DEV).alias("d"), b.alias("b"))  # noqa: E731 -- null-safe in one column
    pt = (points.withColumn("_pt", event_time("ts")).withWatermark("_pt", delay)
          .withColumn("_pk", key(bucket(X.epoch_micros("ts")))))
    # an interval without an end is empty, not null: a closing row must reach the watermark,
    # which the optimiser's not-null filters would take it away from
    intervals = intervals.select(DEV, "start_ts", F.coalesce("end_ts", "start_ts").alias("end_ts"))
    first, last = bucket(X.epoch_micros("start_ts")), F.greatest(bucket(X.epoch_micros("start_ts")), bucket(X.epoch_micros("end_ts") - 1))
    iv = (intervals.withColumn("_it", event_time("start_ts")).withWatermark("_it", delay)
          .withColumn("_b", F.explode(F.sequence(first, last)))
          .select(key(F.col("_b")).alias("_ik"), "_it", F.col("start_ts").alias("interval_start"), F.col("end_ts").alias("interval_end")))
    held = ((F.col("_pk") == F.col("_ik")) & (F.col("_pt") >= F.col("_it")) & (F.col("ts") < F.col("interval_end"))
            & (F.col("_pt") < F.col("_it") + F.expr(f"INTERVAL {int(longest_s)} SECONDS")))
    return pt.join(iv, held, "left").drop("_pt", "_it", "_pk", "_ik", CLOSING)


# --- F10: batch view over the keyed table ----------------------------------------------

def upsert_sink(table: str, to_cells: Callable[[DataFrame], DataFrame], compact_every: int = 64):
    """foreachBatch body: each micro-batch is one idempotent upsert into the keyed table,
    which is compacted whenever ``compact_every`` batches are not in its base yet."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        wide.upsert_cells(batch.sparkSession, table, to_cells(batch), batch_id)
        wide.compact_cells(batch.sparkSession, table, least=compact_every)
    return sink


def batch_view(spark: SparkSession, table: str) -> DataFrame:
    """Counts by class over the keyed table as it is now: a key that was written again counts once."""
    return monitor.macro_counts(wide.mapped_view(wide.read_cells(spark, table)), by=())


VIEW_COUNTS = ("normal", "anomaly", "unknown", "total")


def view_change(spark: SparkSession, table: str, cells: DataFrame) -> DataFrame:
    """What the puts ``cells`` change in the counts by class, one row: each touched key leaves its old class and enters its new one.

    Reads the table's dates that the cells touch (their number is bounded by the
    micro-batch) and of these only the keys that are written.  Keys that were not
    there before have no old class.
    """
    day = F.substring("row_key", 1, 10)
    dates = [r[0] for r in cells.select(day).distinct().collect()]
    keys = cells.select("row_key").distinct()
    old = wide.read_cells(spark, table, dates).join(keys, "row_key", "left_semi").withColumn("age", F.lit(0))
    put = old.select("row_key", "family", "qualifier", "value", "version", "age").unionByName(
        cells.select("row_key", "family", "qualifier", "value", "version", F.lit(1).alias("age")))
    pred = (F.col("family") == "status") & (F.col("qualifier") == "pred")
    order = F.struct("age", "version", "value")
    per = put.groupBy("row_key").agg(
        F.max_by("value", F.when(pred & (F.col("age") == 0), order)).alias("was"), F.max_by("value", F.when(pred, order)).alias("is"),
        F.max(F.col("age") == 0).alias("existed"))
    was, now = F.expr("try_cast(was as float)"), F.expr("try_cast(is as float)")
    of = {"normal": lambda c: c == 0, "anomaly": lambda c: c != 0, "unknown": lambda c: c.isNull(), "total": lambda c: F.lit(True)}
    return per.agg(*[(F.count_if(of[n](now)) - F.count_if(F.col("existed") & of[n](was))).alias(n) for n in VIEW_COUNTS])


def view_sink(table: str, view: str, to_cells: Callable[[DataFrame], DataFrame], compact_every: int = 64):
    """foreachBatch body: the keyed table and its counts by class together, from the changed keys only.

    The change is written first, then the batch is committed to the table.  A run
    that dies in between leaves a change that the retry replaces (the table does not
    hold the batch yet); after the commit a replay does nothing.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if wide.is_committed(spark, table, batch_id):
            return
        batch.persist()
        try:
            cells = to_cells(batch)
            view_change(spark, table, cells).write.mode("overwrite").parquet(f"{view}/batch={batch_id}")
            wide.upsert_cells(spark, table, cells, batch_id)
        finally:
            batch.unpersist()
        wide.compact_cells(spark, table, least=compact_every)
    return sink


def read_view(spark: SparkSession, table: str, view: str) -> DataFrame:
    """The counts: the sum of the committed batches' changes."""
    changes = spark.read.schema(", ".join(f"{c} long" for c in (*VIEW_COUNTS, "batch"))).parquet(view)
    done = spark.createDataFrame([(b,) for b in sorted(wide.committed(spark, table))], "batch long")
    return changes.join(done, "batch", "left_semi").agg(*[F.sum(c).alias(c) for c in VIEW_COUNTS])


def route_batch(out: str, tags=("log", "macro", "status", "micro")):
    """foreachBatch body: cache the batch once, write one output per known tag.

    Unknown tags are ignored.  Each output folder is keyed by batch id, so a
    replayed batch overwrites its own files.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for t in tags:
                batch.filter(F.col("tag") == t).write.mode("overwrite").parquet(f"{out}/{t}/batch={batch_id}")
        finally:
            batch.unpersist()
    return sink
