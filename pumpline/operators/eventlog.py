"""Event log, mute windows and log views of the monitoring layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pumpline import config as C
from pumpline.config import DEFAULT_PARAMS, Params
from pumpline.functions import expressions as X
from pumpline.plans import sequencing as Q
from pumpline.session import work_path
from pumpline.sources import folders

DEV = "device_id"
ORDER = ["ts", "event_id"]
# ordering of records that share a timestamp
SEQ_START, SEQ_STATUS, SEQ_SAMPLE, SEQ_MUTE, SEQ_CLEAR, SEQ_EXPORT = -1, 0, 1, 2, 3, 4


def mute_windows(toggles: DataFrame, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """Mute intervals [start, end) from toggle presses, per device.

    A press while a window is open closes it; otherwise it opens a window of
    ``mute_s`` seconds that ends by itself (open while ``end > now``).  That
    recurrence has a closed form: a press opens iff it starts a run (no press
    in the ``mute_s`` before it) or is an even number of presses into its run.
    So the fold becomes a previous/next lookup, a run-start carry and a parity
    test, all of them split by device and time bucket.
    """
    L = int(p.mute_s)
    t = Q.ordered_context(toggles, [DEV], ORDER, "ts", p.bucket_s, seq="_n",
                          prev={"ts": "_prev_ts"}, nxt={"ts": "_next_ts"})
    starts_run = F.col("_prev_ts").isNull() | (F.col("ts") >= X.plus_seconds("_prev_ts", L))
    t = t.withColumn("_run_start", F.when(starts_run, F.col("_n")))
    t = Q.carry_last(t, [DEV], ORDER, "ts", p.bucket_s, ["_run_start"])
    t = t.withColumn("opens", ((F.col("_n") - F.col("_run_start_asof")) % 2) == 0)
    natural_end = X.plus_seconds("ts", L)
    end = F.when(F.col("_next_ts").isNotNull() & (F.col("_next_ts") < natural_end), F.col("_next_ts")) \
           .otherwise(natural_end)
    return t.select(DEV, "event_id", "ts", "opens", end.alias("_end"))


def windows_only(toggle_states: DataFrame) -> DataFrame:
    return (toggle_states.filter("opens")
                         .select(DEV, F.col("ts").alias("start_ts"), F.col("_end").alias("end_ts")))


def interval_join(points: DataFrame, intervals: DataFrame, p: Params = DEFAULT_PARAMS,
                  start: str = "start_ts", end: str = "end_ts", ts: str = "ts") -> DataFrame:
    """Left join points to the interval ``start <= ts < end`` of the same device.

    Intervals of one device must not overlap.  Then only the newest interval that
    starts at or before a point can hold it: an as-of lookup, linear in both sides
    whatever their densities.  Adds ``interval_start`` and ``interval_end``.
    """
    cols = [c for c in points.columns if c not in (DEV, ts)]
    iv = intervals.select(DEV, F.col(start).alias("_at"), F.lit(0).alias("_kind"), F.struct(F.col(start).alias("s"), F.col(end).alias("e")).alias("_iv"),
                          F.lit(None).cast(points.select(F.struct(*cols)).schema[0].dataType).alias("_row"))
    pt = points.select(DEV, F.col(ts).alias("_at"), F.lit(1).alias("_kind"), F.lit(None).cast(iv.schema["_iv"].dataType).alias("_iv"),
                       F.struct(*cols).alias("_row"))
    a = Q.carry_last(iv.unionByName(pt), [DEV], ["_at", "_kind"], "_at", p.bucket_s, ["_iv"]).filter("_kind = 1")
    inside = F.col("_at") < F.col("_iv_asof.e")
    return a.select(DEV, F.col("_at").alias(ts), *[F.col("_row")[c].alias(c) for c in cols],
                    F.when(inside, F.col("_iv_asof.s")).alias("interval_start"), F.when(inside, F.col("_iv_asof.e")).alias("interval_end"))


def muted_until(points: DataFrame, presses: DataFrame, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """Adds ``mute_until``: when the mute window open at each point ends by itself, NULL if none is open.

    Records of one instant are in the order status, sample, press, clear.  A sample
    at the instant of a press thus comes before it: an opening press does not mute
    it yet, a closing press has not unmuted it yet.  So the newest press before the
    point decides: if it opened, the point is muted until ``mute_s`` after it.
    Points are samples unless they carry their own ``seq``.
    """
    place = F.col("seq") if "seq" in points.columns else F.lit(SEQ_SAMPLE)
    cols = [c for c in points.columns if c not in (DEV, "ts", "event_id")]
    pr = presses.select(DEV, "ts", F.col("event_id").cast("long").alias("event_id"), F.lit(SEQ_MUTE).alias("_seq"),
                        F.struct(F.col("ts").alias("at"), "opens").alias("_press"),
                        F.lit(None).cast(points.select(F.struct(F.lit(1), *cols)).schema[0].dataType).alias("_row"))
    pt = points.select(DEV, "ts", F.col("event_id").cast("long").alias("event_id"), place.alias("_seq"),
                       F.lit(None).cast(pr.schema["_press"].dataType).alias("_press"), F.struct(F.lit(1), *cols).alias("_row"))
    a = Q.carry_last(pr.unionByName(pt), [DEV], ["ts", "_seq", "event_id"], "ts", p.bucket_s, ["_press"]).filter("_row IS NOT NULL")
    until = X.plus_seconds("_press_asof.at", int(p.mute_s))
    return a.select(DEV, "ts", "event_id", *[F.col("_row")[c].alias(c) for c in cols],
                    F.when(F.col("_press_asof.opens") & (F.col("ts") < until), until).alias("mute_until"))


def mute_remaining(points: DataFrame, presses: DataFrame, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """``MM:SS`` left in the mute window at each point inside one."""
    j = muted_until(points, presses, p).filter(F.col("mute_until").isNotNull())
    return j.withColumn("remaining", X.remaining_text("mute_until", "ts"))


# --- the log: one feed of raw rows, records unfolded from each ---------------------------

TAGS = ("log", "macro", "status", "micro")
FEED_STATUS, FEED_SAMPLE, FEED_PRESS, FEED_CLEAR, FEED_EXPORT = "status", "sample", "press", "clear", "export"
LOG_COLS = [DEV, "ts", "seq", "event_id", "tag", "level", "message", "source", "online", "normal", "anomaly"]


def feed(parsed: DataFrame, status: DataFrame, toggles: DataFrame, clears: DataFrame, exports: DataFrame) -> DataFrame:
    """Everything the monitor receives as one table, told apart by ``kind``.

    ``parsed`` is the output of ``clean.parse_reject`` with device_id, ts and
    event_id kept; ``exports`` has device_id, ts, event_id, path and error (NULL
    where the export succeeded).
    """
    def rows(df: DataFrame, kind: str, **cols) -> DataFrame:
        text = {c: F.lit(None).cast("string") for c in ("row_key", "s04", "s10", "pred", "reason", "source", "detail", "path", "error")}
        numbers = {c: F.lit(None).cast("double") for c in ("s04_num", "s10_num", "pred_num")}
        all_cols = {**text, **numbers, "online": F.lit(None).cast("boolean"), **cols}
        return df.select(DEV, "ts", F.col("event_id").cast("long").alias("event_id"), F.lit(kind).alias("kind"),
                         *[c.alias(n) for n, c in sorted(all_cols.items())])

    own = lambda *names: {n: F.col(n) for n in names}
    return (rows(parsed, FEED_SAMPLE, **own("row_key", "s04", "s10", "pred", "reason", "s04_num", "s10_num", "pred_num"))
            .unionByName(rows(status, FEED_STATUS, **own("source", "online", "detail")))
            .unionByName(rows(toggles, FEED_PRESS)).unionByName(rows(clears, FEED_CLEAR))
            .unionByName(rows(exports, FEED_EXPORT, **own("path", "error"))))


def _record(seq: int, tag: str, level, message, source=None, online=None, normal=None, anomaly=None):
    none = lambda t: F.lit(None).cast(t)
    return F.struct(F.lit(seq).alias("seq"), F.lit(tag).alias("tag"), (F.lit(level).cast("string") if not hasattr(level, "alias") else level).alias("level"),
                    message.cast("string").alias("message"), (none("string") if source is None else source).alias("source"),
                    (none("boolean") if online is None else online).alias("online"),
                    (none("long") if normal is None else normal).alias("normal"), (none("long") if anomaly is None else anomaly).alias("anomaly"))


def plain_array(p: Params = DEFAULT_PARAMS, tags=TAGS):
    """Array of the records (those with one of ``tags``) that each feed row gives by itself (mute presses and macro counts need other rows).

    sample: a micro record, and an ERROR for an alert, or a WARN for a rejected row;
    status: a status record, and a WARN when it is offline; clear: INFO; export:
    INFO, or ERROR when it failed.
    """
    is_ = lambda k: F.col("kind") == k
    ok, alert = F.col("reason").isNull(), X.is_alert("pred_num", p.alert_pred)
    reason = X.alert_reason("s04_num", "s10_num", p.vib_threshold, p.temp_threshold)
    sample_line = F.concat(F.lit(C.SAMPLE_PREFIX), F.lit("key="), F.col("row_key"), F.lit(" | S04="), X.fixed1("s04_num"),
                           F.lit(" | S10="), X.fixed1("s10_num"), F.lit(" | PRED="), X.sample_state("pred_num", p.alert_pred))
    bad = (F.when(F.col("s04_num").isNull(), F.col("s04")).when(F.col("s10_num").isNull(), F.col("s10")).otherwise(F.col("pred")))
    why = (F.when(F.col("reason") == "missing", F.concat(F.lit("'"), F.lit(C.MSG_MISSING_CELLS), F.lit("'")))
            .otherwise(F.concat(F.lit("could not convert string to float: '"), bad, F.lit("'"))))
    failed = F.when(F.col("source") == "batch", F.lit(C.MSG_BATCH_FAIL)).otherwise(F.lit(C.MSG_SPEED_FAIL))
    records = (
        ("micro", F.when(is_(FEED_SAMPLE) & ok, _record(SEQ_SAMPLE, "micro", None, sample_line))),
        ("log", F.when(is_(FEED_SAMPLE) & ok & alert, _record(SEQ_SAMPLE, "log", "ERROR", X.alert_message(reason, "row_key", "s04_num", "s10_num")))),
        ("log", F.when(is_(FEED_SAMPLE) & ~ok, _record(SEQ_SAMPLE, "log", "WARN", F.concat(F.lit(C.MSG_ROW_FAIL), F.lit("["), F.col("row_key"), F.lit("]："), why)))),
        ("status", F.when(is_(FEED_STATUS), _record(SEQ_STATUS, "status", None, F.col("detail"), F.col("source"), F.col("online")))),
        ("log", F.when(is_(FEED_STATUS) & ~F.col("online"), _record(SEQ_STATUS, "log", "WARN", F.concat(failed, F.col("detail"))))),
        ("log", F.when(is_(FEED_CLEAR), _record(SEQ_CLEAR, "log", "INFO", F.lit(C.MSG_CLEARED)))),
        ("log", F.when(is_(FEED_EXPORT) & F.col("error").isNull(), _record(SEQ_EXPORT, "log", "INFO", F.concat(F.lit(C.MSG_EXPORT_OK), F.col("path"))))),
        ("log", F.when(is_(FEED_EXPORT) & F.col("error").isNotNull(), _record(SEQ_EXPORT, "log", "ERROR", F.concat(F.lit(C.MSG_EXPORT_FAIL), F.col("error"))))))
    return F.array_compact(F.array(*[r for tag, r in records if tag in tags]))


def unfold(rows: DataFrame, records, *more: str) -> DataFrame:
    """One log row for each record of each row, with the columns ``more`` of the row."""
    r = rows.select(DEV, "ts", "event_id", *more, F.explode(records).alias("r"))
    return r.select(DEV, "ts", F.col("r.seq").alias("seq"), "event_id", *[F.col("r")[c].alias(c) for c in LOG_COLS[4:]], *more)


def plain_records(rows: DataFrame, p: Params = DEFAULT_PARAMS, tags=TAGS) -> DataFrame:
    return unfold(rows, plain_array(p, tags))


def may_be_error(p: Params = DEFAULT_PARAMS):
    """Feed rows that give an ERROR record: alerts and failed exports."""
    alert = (F.col("kind") == FEED_SAMPLE) & F.col("reason").isNull() & X.is_alert("pred_num", p.alert_pred)
    return F.coalesce(alert | ((F.col("kind") == FEED_EXPORT) & F.col("error").isNotNull()), F.lit(False))


def after_clear(rows: DataFrame, clears: DataFrame) -> DataFrame:
    """``rows`` not older than the device's last clear (by time alone: a first cut)."""
    last = clears.groupBy(F.col(DEV).alias("_dev")).agg(F.max("ts").alias("_cut"))
    j = rows.join(last, F.col(DEV).eqNullSafe(F.col("_dev")), "left")
    return j.filter(F.col("_cut").isNull() | (F.col("ts") >= F.col("_cut"))).drop("_dev", "_cut")


def macro_records(rows: DataFrame, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """One macro record per successful poll of the batch feed: the samples counted up to then, by class."""
    poll = (F.col("kind") == FEED_STATUS) & (F.col("source") == "batch") & F.col("online")
    good = (F.col("kind") == FEED_SAMPLE) & F.col("reason").isNull()
    some = rows.filter(poll | good).select(
        DEV, "ts", "event_id", poll.alias("_poll"), F.when(poll, 1).otherwise(0).alias("_late"),
        (good & (F.col("pred_num") == 0)).cast("long").alias("_normal"), (good & (F.col("pred_num") != 0)).cast("long").alias("_anomaly"))
    run = Q.running_sums(some, [DEV], ["ts", "_late", "event_id"], "ts", p.bucket_s, {"normal": F.col("_normal"), "anomaly": F.col("_anomaly")})
    rec = _record(SEQ_STATUS, "macro", None, F.lit(None), F.lit("batch"), None, F.col("normal"), F.col("anomaly"))
    return unfold(run.filter("_poll"), F.array(rec))


def records_of_marked(rows: DataFrame, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """The log from feed rows that carry their state (see ``streaming.pipelines.event_log_stream``):
    opens, muted, first, normal, anomaly.  One unfolding, no other row is needed."""
    said = F.when(F.col("opens"), F.lit(C.MSG_MUTE_ON)).otherwise(F.lit(C.MSG_MUTE_OFF))
    poll = (F.col("kind") == FEED_STATUS) & (F.col("source") == "batch") & F.col("online")
    more = F.array_compact(F.array(
        F.when(F.col("kind") == FEED_PRESS, _record(SEQ_MUTE, "log", "INFO", said)),
        F.when(poll, _record(SEQ_STATUS, "macro", None, F.lit(None), F.lit("batch"), None, F.col("normal"), F.col("anomaly"))),
        F.when(F.col("first"), _record(SEQ_START, "log", "INFO", F.lit(C.MSG_STARTED)))))
    log = unfold(rows, F.concat(plain_array(p), more), "muted")
    log = (log.withColumn("event_id", F.when(F.col("seq") == SEQ_START, F.lit(-1).cast("long")).otherwise(F.col("event_id")))
              .withColumn("muted", F.col("muted") & F.coalesce(F.col("level") == "ERROR", F.lit(False))))
    return log.withColumn("line", F.when(F.col("tag") == "log", X.log_line("ts", "level", "message", "muted")))


def event_log(rows: DataFrame, p: Params = DEFAULT_PARAMS, tags=TAGS, clears: DataFrame | None = None) -> DataFrame:
    """Typed records of everything the monitor reports, in one table, from one ``feed``.

    The small parts that need other rows are written to the shared folder first:
    presses with their effect, macro counts, and the ERROR records with the mute
    window they fall in (only rows that give one are unfolded for that).  The log
    itself is then one unfolding scan of the feed and one scan of each of these.
    ERROR lines inside a mute window are tagged, never dropped.  The monitor's
    start-up record opens each device's log.

    ``tags`` builds records of these tags only.  With ``clears`` only records since
    each device's last clear are built; what came before still counts for them.
    """
    spark = rows.sparkSession

    def saved(df: DataFrame, name: str) -> DataFrame:
        path = work_path(spark, name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    cut = (lambda df: df) if clears is None else (lambda df: after_clear(df, clears))
    parts = [plain_records(cut(rows.filter(~may_be_error(p)) if "micro" not in tags else rows), p, tags)
             .filter(~F.coalesce(F.col("level") == "ERROR", F.lit(False))).withColumn("muted", F.lit(False))]
    if "macro" in tags:
        parts.append(cut(saved(macro_records(rows, p), "log-macro")).withColumn("muted", F.lit(False)))
    if "log" in tags:
        presses = saved(mute_windows(rows.filter(F.col("kind") == FEED_PRESS).select(DEV, "ts", "event_id"), p), "log-presses")
        errors = saved(plain_records(cut(rows.filter(may_be_error(p))), p, ("log",)), "log-errors")
        tagged = saved(muted_until(errors, presses, p).withColumn("muted", F.col("mute_until").isNotNull()).drop("mute_until"), "log-tagged")
        said = F.when(F.col("opens"), F.lit(C.MSG_MUTE_ON)).otherwise(F.lit(C.MSG_MUTE_OFF))
        mute = unfold(cut(presses), F.array(_record(SEQ_MUTE, "log", "INFO", said)))
        first = unfold(cut(rows.groupBy(DEV).agg(F.min("ts").alias("ts"))).withColumn("event_id", F.lit(-1).cast("long")),
                       F.array(_record(SEQ_START, "log", "INFO", F.lit(C.MSG_STARTED))))
        parts += [tagged.select(*LOG_COLS, "muted"), mute.withColumn("muted", F.lit(False)), first.withColumn("muted", F.lit(False))]
    log = parts[0]
    for part in parts[1:]:
        log = log.unionByName(part)
    return log.withColumn("line", F.when(F.col("tag") == "log", X.log_line("ts", "level", "message", "muted")))


def route_events(log: DataFrame, tags=TAGS) -> dict[str, DataFrame]:
    """Split the event table by tag; unknown tags go nowhere."""
    return {t: log.filter(F.col("tag") == t) for t in tags}


def log_lines(log: DataFrame) -> DataFrame:
    return log.filter(F.col("tag") == "log").select(DEV, "ts", "seq", "event_id", "level", "muted", "line")


def log_tail(lines: DataFrame, keep: int = DEFAULT_PARAMS.log_keep) -> DataFrame:
    """Newest ``keep`` lines per device (partial top-N on the map side)."""
    w = Window.partitionBy(DEV).orderBy(F.col("ts").desc(), F.col("seq").desc(), F.col("event_id").desc())
    return lines.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= keep).drop("_rn")


def since_last_clear(lines: DataFrame, clears: DataFrame) -> DataFrame:
    """Lines recorded at or after the device's last clear (the clear's own record included)."""
    last = clears.groupBy(F.col(DEV).alias("_dev")).agg(F.max(F.struct("ts", "event_id")).alias("_c"))
    j = lines.join(last, F.col(DEV).eqNullSafe(F.col("_dev")), "left")
    keep = F.col("_c").isNull() | (F.struct(F.col("ts"), F.col("seq"), F.col("event_id"))
                                   >= F.struct(F.col("_c.ts"), F.lit(SEQ_CLEAR), F.col("_c.event_id")))
    return j.filter(keep).drop("_dev", "_c")


def export_lines(lines_since_clear: DataFrame, p: Params = DEFAULT_PARAMS) -> DataFrame:
    """Export text per device: header, rule, then the records in order, numbered.

    The lines are written to the shared folder once and numbered from there; header
    and rule are unfolded from each device's first line.
    """
    path = work_path(lines_since_clear.sparkSession, "log-since-clear")
    lines_since_clear.write.parquet(path)
    lines_since_clear = lines_since_clear.sparkSession.read.parquet(path)
    body = Q.sequence_number(lines_since_clear, [DEV], ["ts", "seq", "event_id"], "ts", p.bucket_s, "_n")
    first = F.array(F.struct(F.lit(1).cast("long").alias("line_no"), F.lit(C.EXPORT_HEADER).alias("line")),
                    F.struct(F.lit(2).cast("long").alias("line_no"), F.lit(C.EXPORT_RULE).alias("line")))
    own = F.array(F.struct((F.col("_n") + 2).alias("line_no"), F.col("line").alias("line")))
    return body.select(DEV, F.explode(F.when(F.col("_n") == 1, F.concat(first, own)).otherwise(own)).alias("x")).select(DEV, "x.line_no", "x.line")


#: What one task of the export writes at most, on average.  Each device costs a folder and a file,
#: which may take longer than its lines, so the tasks follow both.
EXPORT_DEVICES, EXPORT_LINES = 256, 200_000


def export_parts(lines: DataFrame) -> int:
    """Tasks that write the export of ``lines``: they follow the devices and the lines."""
    n_lines, n_devices = lines.agg(F.count(F.lit(1)), F.approx_count_distinct(DEV)).first()
    return max(1, -(-n_lines // EXPORT_LINES), -(-n_devices // EXPORT_DEVICES))


def write_export(lines: DataFrame, path: str) -> None:
    """Write export text per device folder, lines in order.

    Range partitioning on (device, line_no) spreads a long log over several
    ordered files (part-00000, part-00001, ...) instead of one task per device, and
    many devices over many tasks (the adaptive shuffle would size the parts by their bytes
    alone).  The lines are saved first: they are counted and sampled before they are written.
    How the files are opened is the part of ``folders``: it takes longer than their lines.
    """
    spark, saved = lines.sparkSession, work_path(lines.sparkSession, "log-export-lines")
    lines.write.parquet(saved)
    lines = spark.read.schema(lines.schema).parquet(saved)
    folders.write_text_folders(lines.repartitionByRange(export_parts(lines), DEV, "line_no").sortWithinPartitions(DEV, "line_no"), DEV, "line", path)
