"""Monitoring semantics of the speed and batch layers, as per-device operators.

Batch tables and micro-batches go through the same functions.  Ordered
per-device logic uses ``pumpline.plans.sequencing`` (device x time bucket), and
top-N per device uses ``row_number() <= n``, which Spark plans with a partial
``WindowGroupLimit`` before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pumpline import config as C
from pumpline.config import DEFAULT_PARAMS, Params
from pumpline.functions import expressions as X
from pumpline.plans import sequencing as Q

DEV = "device_id"
ORDER = ["ts", "event_id"]


def valid_samples(df: DataFrame) -> DataFrame:
    """Rows the speed layer can use: all three signals present."""
    return df.filter(F.col("s04").isNotNull() & F.col("s10").isNotNull() & F.col("pred").isNotNull())


# --- scalar classification -------------------------------------------------

def threshold_flags(df: DataFrame, p: Params = DEFAULT_PARAMS) -> DataFrame:
    return (df.withColumn("vib_exceeded", X.exceeds("s04", p.vib_threshold))
              .withColumn("temp_exceeded", X.exceeds("s10", p.temp_threshold)))


def alerts(df: DataFrame, p: Params = DEFAULT_PARAMS, key: str = "row_key") -> DataFrame:
    """Alert rows (pred == alert value) with their reason and message text."""
    a = df.filter(X.is_alert("pred", p.alert_pred))
    a = a.withColumn("reason", X.alert_reason("s04", "s10", p.vib_threshold, p.temp_threshold))
    return a.withColumn("message", X.alert_message("reason", key, "s04", "s10"))


def sample_text(df: DataFrame, p: Params = DEFAULT_PARAMS, key: str = "row_key") -> DataFrame:
    """The 'last sample' line: key, both signals with one decimal, ALERT/NORMAL."""
    return df.withColumn("sample_line", F.concat(
        F.lit(C.SAMPLE_PREFIX), F.lit("key="), F.col(key), F.lit(" | S04="), X.fixed1("s04"), F.lit(" | S10="), X.fixed1("s10"),
        F.lit(" | PRED="), X.sample_state("pred", p.alert_pred)))


# --- batch-layer counts ------------------------------------------------------

def macro_counts(df: DataFrame, by=(DEV,), pred: str = "pred") -> DataFrame:
    """normal = pred == 0, anomaly = pred != 0 (0.5 included), unknown = NULL pred."""
    pc = F.col(pred)
    return df.groupBy(*by).agg(
        F.count_if(pc == 0).alias("normal"),
        F.count_if(pc != 0).alias("anomaly"),
        F.count_if(pc.isNull()).alias("unknown"),
        F.count(F.lit(1)).alias("total"))


def macro_ratio(counts: DataFrame) -> DataFrame:
    """Normal share of classified rows; NULL when there are none."""
    return counts.withColumn("normal_ratio", F.try_divide(F.col("normal").cast("double"),
                                                          (F.col("normal") + F.col("anomaly")).cast("double")))


def monthly_counts(df: DataFrame, pred: str = "pred") -> DataFrame:
    """Monthly rollup of the macro counts, with a grand-total row (month NULL)."""
    pc = F.col(pred)
    return (df.withColumn("month", F.trunc(F.to_date("ts"), "month"))
              .rollup("month").agg(F.count_if(pc == 0).alias("normal"), F.count_if(pc != 0).alias("anomaly"),
                                   F.count_if(pc.isNull()).alias("unknown"), F.count(F.lit(1)).alias("total")))


# --- speed-layer sequences -------------------------------------------------------

def session_alerts(df: DataFrame, p: Params = DEFAULT_PARAMS, by=(DEV,)) -> DataFrame:
    """Cumulative alert count at each sample, per device (or global with ``by=()``;
    then only the per-bucket totals are ordered in one window)."""
    flag = X.is_alert("pred", p.alert_pred).cast("long")
    return Q.running_sum(df, list(by), ORDER, "ts", p.bucket_s, flag, "session_alerts")


def recent_alerts(df: DataFrame, p: Params = DEFAULT_PARAMS, by=(DEV,)) -> DataFrame:
    """Alerts in the trailing horizon at each sample; an alert exactly horizon old still counts.

    ``by=()`` gives the global form (one monitored unit, as on the original
    dashboard): rows are then partitioned by time bucket alone.
    """
    flag = X.is_alert("pred", p.alert_pred).cast("long")
    return Q.trailing_sum(df, list(by), "ts", flag, p.recent_horizon_s, p.bucket_s, "recent_alerts")


def waveform_last(df: DataFrame, n: int = DEFAULT_PARAMS.buffer_len, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """Last-n buffer per device as (device_id, pos, s04, s10), oldest first, always n long.

    Missing history is padded on the left with the seed values.  The top-n cut
    runs partially on the map side, so at most n rows per device and task are
    shuffled; the n rows of a device then form one array, padded and unfolded in
    place (one scan, one ranking, one shuffle).
    """
    w = Window.partitionBy(DEV).orderBy(F.col("ts").desc(), F.col("event_id").desc())
    top = df.select(DEV, "ts", "event_id", "s04", "s10").withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
    newest_last = F.sort_array(F.collect_list(F.struct((-F.col("_rn")).alias("o"), "s04", "s10")))
    arr = top.groupBy(DEV).agg(F.transform(newest_last, lambda x: F.struct(x["s04"].alias("s04"), x["s10"].alias("s10"))).alias("a"))
    seed = F.struct(F.lit(float(p.seed_s04)).alias("s04"), F.lit(float(p.seed_s10)).alias("s10"))
    padded = F.concat(F.array_repeat(seed, F.lit(n) - F.size("a")), F.col("a"))
    return (arr.select(DEV, F.posexplode(padded).alias("pos", "v"))
               .select(DEV, F.col("pos").cast("int"), F.col("v.s04").alias("s04"), F.col("v.s10").alias("s10")))


def waveform_last_global(df: DataFrame, n: int = DEFAULT_PARAMS.buffer_len, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """Global last-n buffer (one monitored unit): (pos, s04, s10), oldest first, n long.

    ``orderBy().limit(n)`` is a top-n (each partition keeps n rows, then one merge);
    only those n rows are gathered into one array for positions and padding.
    """
    top = df.orderBy(F.col("ts").desc(), F.col("event_id").desc()).limit(n)
    arr = top.agg(F.sort_array(F.collect_list(F.struct("ts", "event_id", "s04", "s10"))).alias("a"))
    seed = F.struct(F.lit(None).cast("timestamp_ntz").alias("ts"), F.lit(None).cast("long").alias("event_id"),
                    F.lit(float(p.seed_s04)).alias("s04"), F.lit(float(p.seed_s10)).alias("s10"))
    padded = F.concat(F.array_repeat(seed, F.lit(n) - F.size("a")), F.col("a"))
    return (arr.select(F.posexplode(padded).alias("pos", "v"))
               .select(F.col("pos").cast("int"), F.col("v.s04").alias("s04"), F.col("v.s10").alias("s10")))


def rolling_stats(df: DataFrame, n: int = DEFAULT_PARAMS.buffer_len, p: Params = DEFAULT_PARAMS,
                  chunk_rows: int = 1_000_000) -> DataFrame:
    """Statistics of the buffer as seen at each sample (seeds excluded).

    Averages are plain double averages, added up in row order inside each frame;
    a NaN in the frame makes them NaN.
    """
    aggs = {
        "n_window": F.count(F.lit(1)),
        "avg_s04": F.avg("s04"),
        "avg_s10": F.avg("s10"),
        "min_s10": F.min("s10"),
        "max_s10": F.max("s10"),
        "max_s04": F.max("s04"),
    }
    return Q.rolling_rows(df, [DEV], ORDER, "ts", p.bucket_s, n, aggs, chunk_rows=chunk_rows)


def latest_per_device(df: DataFrame, cols=("event_id", "ts", "s04", "s10", "pred")) -> DataFrame:
    """Newest sample per device (max_by: an aggregate with a partial step, no sort)."""
    latest = F.max_by(F.struct(*cols), F.struct(*[F.col(c) for c in ORDER]))
    return df.groupBy(DEV).agg(latest.alias("_l")).select(DEV, *[F.col(f"_l.{c}").alias(c) for c in cols])


def dedupe_consecutive(df: DataFrame, key: str = "poll_key", p: Params = DEFAULT_PARAMS,
                       by=(DEV,)) -> DataFrame:
    """Drop a poll whose key equals the previous poll's key (only keys are compared,
    and no key equals no key); per device, or over one stream with ``by=()``."""
    d = Q.ordered_context(df, list(by), ORDER, "ts", p.bucket_s, seq="_n", prev={key: "_prev_key"})
    return d.filter((F.col("_n") == 1) | ~F.col("_prev_key").eqNullSafe(F.col(key))).drop("_n", "_prev_key")


def drain_ticks(df: DataFrame, p: Params = DEFAULT_PARAMS, by=(DEV,)) -> DataFrame:
    """The tick in which a capped consumer handles each event: columns tick_arrived, tick_handled, queued.

    A consumer takes at most ``drain_cap`` waiting events in each tick, oldest
    first; the others wait (backlog = max(0, backlog + arrivals - cap)).  Seen as a
    row of places, ``drain_cap`` of them a tick, an event takes the place after the
    one before it, or the first of its own tick if that is later:
    place(i) = i + max over j <= i of (tick(j) * cap - j), a running maximum.
    ``queued`` is the number of ticks an event waits.  One queue per device, or over
    all rows with ``by=()``.
    """
    cap, tick_us = int(p.drain_cap), int(p.tick_ms) * 1000
    d = Q.sequence_number(df, list(by), ORDER, "ts", p.bucket_s, "_n")
    d = d.withColumn("tick_arrived", F.floor(X.epoch_micros("ts") / F.lit(tick_us)).cast("long"))
    d = Q.running_max(d, list(by), ORDER, "ts", p.bucket_s, F.col("tick_arrived") * cap - F.col("_n"), "_ahead")
    d = d.withColumn("tick_handled", F.floor((F.col("_n") + F.col("_ahead")) / F.lit(cap)).cast("long"))
    return d.withColumn("queued", F.col("tick_handled") - F.col("tick_arrived")).drop("_n", "_ahead")


def reconnects(status: DataFrame, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """Offline -> online transitions per (device, source); None -> online is not one."""
    d = Q.neighbor_value(status, [DEV, "source"], ORDER, "ts", p.bucket_s, "online", "_prev", "prev")
    return d.withColumn("reconnect", (F.col("_prev") == F.lit(False)) & (F.col("online") == F.lit(True)))


def reconnect_count(status: DataFrame, p: Params = DEFAULT_PARAMS) -> DataFrame:
    r = reconnects(status, p)
    return (r.groupBy(DEV).agg(
        F.count_if(F.col("reconnect") & (F.col("source") == "batch")).alias("batch_reconnects"),
        F.count_if(F.col("reconnect") & (F.col("source") == "speed")).alias("speed_reconnects"))
        .withColumn("total_reconnects", F.col("batch_reconnects") + F.col("speed_reconnects")))


def source_status(status: DataFrame) -> DataFrame:
    """Current status of each feed with its detail text."""
    last = F.max_by(F.struct("online", "detail", "ts"), F.struct(*[F.col(c) for c in ORDER]))
    return (status.groupBy(DEV, "source").agg(last.alias("_s"))
                  .select(DEV, "source", F.col("_s.online").alias("online"), F.col("_s.detail").alias("detail"),
                          F.col("_s.ts").alias("status_ts")))


def device_state(samples: DataFrame, status: DataFrame, p: Params = DEFAULT_PARAMS,
                 feed: str = "speed") -> DataFrame:
    """Device state at every sample from an as-of lookup of the feed's latest status.

    Precedence: INTERRUPTED if the latest status at or before the sample is
    offline, else ABNORMAL if pred is the alert value, else NORMAL.  A status and
    a sample at the same instant: the status applies first.
    """
    nul = F.lit(None).cast("double")
    st = (status.filter(F.col("source") == feed)
                .select(DEV, "ts", "event_id", F.lit(0).alias("_kind"), F.col("online"),
                        nul.alias("pred"), nul.alias("s04"), nul.alias("s10")))
    sm = samples.select(DEV, "ts", "event_id", F.lit(1).alias("_kind"),
                        F.lit(None).cast("boolean").alias("online"), "pred", "s04", "s10")
    u = st.unionByName(sm)
    a = Q.carry_last(u, [DEV], ["ts", "_kind", "event_id"], "ts", p.bucket_s, ["online"])
    state = (F.when(F.col("online_asof") == F.lit(False), F.lit("INTERRUPTED"))
              .when(X.is_alert("pred", p.alert_pred), F.lit("ABNORMAL"))
              .otherwise(F.lit("NORMAL")))
    return (a.filter(F.col("_kind") == 1)
             .select("event_id", DEV, "ts", "online_asof", state.alias("state"), "s04", "s10")
             .withColumn("state_text", X.state_text("state", "s04", "s10")).drop("s04", "s10"))


# --- serving merge --------------------------------------------------------------

def kpi_snapshot(samples: DataFrame, status: DataFrame, p: Params = DEFAULT_PARAMS,
                 feed: str = "speed") -> DataFrame:
    """One row per device: batch-layer counts next to speed-layer KPIs.

    Counts are per-device aggregates, combined before the shuffle.  Raw rows meet
    a device's newest sample only by (device, time bucket): recent alerts in the
    two buckets the horizon can touch, statuses in the newest bucket; older
    statuses come as one row per bucket.  Keys are structs, so a null device is a
    device like any other.
    """
    alert = X.is_alert("pred", p.alert_pred)
    last = F.max_by(F.struct("ts", "event_id", "s04", "s10", "pred"), F.struct("ts", "event_id"))
    agg = samples.groupBy(DEV).agg(
        F.count_if(F.col("pred") == 0).alias("normal"),
        F.count_if(F.col("pred") != 0).alias("anomaly"),
        F.count_if(F.col("pred").isNull()).alias("unknown"),
        F.count_if(alert).alias("session_alerts"),
        last.alias("_last"))
    agg = macro_ratio(agg).select(
        DEV, "normal", "anomaly", "unknown", "normal_ratio", "session_alerts",
        F.col("_last.ts").alias("last_ts"), X.row_key("_last.ts").alias("last_key"),
        F.col("_last.s04").alias("last_s04"), F.col("_last.s10").alias("last_s10"),
        F.col("_last.pred").alias("last_pred"))
    width = max(int(p.recent_horizon_s), 1)
    one, per_bucket = F.struct(DEV), F.struct(DEV, "_b")
    last = agg.select(DEV, F.col("last_ts").alias("_lts")).withColumn("_lb", X.time_bucket("_lts", width))
    horizon = X.plus_seconds(F.col("_lts"), -p.recent_horizon_s)
    near = (last.withColumn("_b", F.explode(F.array(F.col("_lb") - 1, F.col("_lb"))))
                .select(per_bucket.alias("_k"), "_lts"))
    recent = (samples.filter(alert).select(DEV, "ts").withColumn("_b", X.time_bucket("ts", width)).withColumn("_k", per_bucket)
              .join(near, "_k").filter((F.col("ts") >= horizon) & (F.col("ts") <= F.col("_lts")))
              .groupBy(one.alias("_k")).agg(F.count(F.lit(1)).alias("recent_alerts")))
    st = status.filter(F.col("source") == feed).select(DEV, "ts", "event_id", "online").withColumn("_b", X.time_bucket("ts", width))
    newest = F.max(F.struct("ts", "event_id", "online")).alias("_s")
    older = (st.groupBy(DEV, "_b").agg(newest).withColumn("_k", one)
             .join(last.select(one.alias("_k"), "_lb"), "_k").filter(F.col("_b") < F.col("_lb")).select("_k", "_s"))
    same = (st.withColumn("_k", per_bucket).join(last.select(F.struct(DEV, F.col("_lb").alias("_b")).alias("_k"), "_lts"), "_k")
            .filter(F.col("ts") <= F.col("_lts")).select(one.alias("_k"), F.struct("ts", "event_id", "online").alias("_s")))
    feed_now = older.unionByName(same).groupBy("_k").agg(F.max("_s").alias("_s")).select("_k", F.col("_s.online").alias("_online"))
    rc = reconnect_count(status, p).withColumn("_k", one).drop(DEV)
    # the device set comes from the two per-device aggregates (full outer join),
    # not from another distinct over the raw inputs
    out = (agg.withColumn("_k", one).drop(DEV).join(rc, "_k", "full").join(recent, "_k", "left").join(feed_now, "_k", "left")
              .withColumn(DEV, F.col("_k")[DEV]))
    state = (F.when(F.col("last_ts").isNull(), F.lit("STANDBY"))
              .when(F.col("_online") == F.lit(False), F.lit("INTERRUPTED"))
              .when(F.coalesce(F.col("last_pred") == F.lit(float(p.alert_pred)), F.lit(False)), F.lit("ABNORMAL"))
              .otherwise(F.lit("NORMAL")))
    zero = F.lit(0).cast("long")
    return out.select(
        DEV,
        *[F.coalesce(F.col(c), zero).alias(c) for c in ("normal", "anomaly", "unknown", "session_alerts",
                                                          "recent_alerts", "total_reconnects")],
        "normal_ratio", "last_key", "last_s04", "last_s10", "last_pred", state.alias("state")) \
        .withColumn("state_text", X.state_text("state", "last_s04", "last_s10"))
