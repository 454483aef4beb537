"""Sensor-shaped views over the driver's parquet tables (FIXTURES.md section 2).

The same expressions are written in DuckDB SQL in ``pumpline.plans.oracles`` so
both engines see identical inputs.  All views are lazy projections: Catalyst
prunes the columns each query needs down to the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pumpline.functions.expressions import row_key

READING_COLUMNS = ["event_id", "device_id", "ts", "event_type", "s04", "s10", "pred", "machine_status"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def readings_from_events(ev: DataFrame) -> DataFrame:
    """View R: one reading per event; gaps in s04, nulls in status, pred 0/0.5/1."""
    eid = F.col("event_id")
    return ev.select(
        eid,
        F.col("user_id").alias("device_id"),
        F.col("ts"),
        F.col("event_type"),
        F.when(eid % 7 != 0, F.col("value")).alias("s04"),
        F.get_json_object("props", "$.k").cast("double").alias("s10"),
        F.when(eid % 19 == 0, F.lit(0.5))
         .when((F.col("value") > 100) | (eid % 13 == 0), F.lit(1.0))
         .otherwise(F.lit(0.0)).cast("double").alias("pred"),
        F.when(eid % 23 == 0, F.lit(None).cast("string"))
         .when(F.col("event_type") == "error", F.lit("BROKEN"))
         .when(F.col("event_type") == "signup", F.lit("RECOVERING"))
         .otherwise(F.lit("NORMAL")).alias("machine_status"),
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_from_events(table(spark, sf_dir, "events"))


def sample_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings used next to the status view S: the event types that are not statuses."""
    return readings(spark, sf_dir).filter(~F.col("event_type").isin("error", "signup"))


def cells(spark: SparkSession, sf_dir: str, hour_keys: bool = False) -> DataFrame:
    """View C: wide-column cells of R, with the injected faults of FIXTURES 2.2."""
    from pumpline.sources.wide import unpivot_cells

    r = readings(spark, sf_dir)
    key = F.date_format("ts", "yyyy-MM-dd HH:00:00.000000") if hour_keys else row_key("ts")
    c = unpivot_cells(r, key_col=key, version_col="event_id")
    return inject_cell_faults(c)


def inject_cell_faults(c: DataFrame) -> DataFrame:
    v = F.col("version")
    return (c.filter(~((v % 11 == 0) & (F.col("family") == "status") & (F.col("qualifier") == "pred")))
             .withColumn("value", F.when((v % 29 == 0) & (F.col("family") == "wave") & (F.col("qualifier") == "s10"),
                                         F.lit("bad")).otherwise(F.col("value"))))


def source_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View S: status history of the two feeds, per device."""
    ev = table(spark, sf_dir, "events")
    return (ev.filter(F.col("event_type").isin("error", "signup"))
              .select(F.col("event_id"), F.col("user_id").alias("device_id"), F.col("ts"),
                      F.when(F.col("event_id") % 2 == 0, F.lit("batch")).otherwise(F.lit("speed")).alias("source"),
                      (F.col("event_type") == "signup").alias("online"),
                      F.col("event_type").alias("detail")))


def mute_toggles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View G: operator presses of the mute button, one stream per device."""
    ev = table(spark, sf_dir, "events")
    return (ev.filter(F.col("event_type") == "signup")
              .select("event_id", F.col("user_id").alias("device_id"), "ts"))


def clear_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return (ev.filter((F.col("event_type") == "purchase") & (F.col("event_id") % 17 == 0))
              .select("event_id", F.col("user_id").alias("device_id"), "ts"))


FEATURES_W = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def wide_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View W: lineitem as a feature table with a learnable binary label."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("row_id"),
        F.col("l_shipdate").alias("ts"),
        *FEATURES_W,
        F.when((F.col("l_quantity") >= 40) & (F.col("l_discount") > 0.05), 1).otherwise(0).cast("int").alias("label"),
    )


def reading_text(r: DataFrame, *more: str) -> DataFrame:
    """Each reading as the speed layer sees it: row key + text cells with the
    injected faults of view C (pred cell absent, s10 = 'bad')."""
    eid = F.col("event_id")
    return r.select(
        "device_id", "ts", "event_id", row_key("ts").alias("row_key"),
        F.col("s04").cast("string").alias("s04"),
        F.when(eid % 29 == 0, F.lit("bad")).otherwise(F.col("s10").cast("string")).alias("s10"),
        F.when(eid % 11 == 0, F.lit(None).cast("string")).otherwise(F.col("pred").cast("string")).alias("pred"), *more)


def at_full_hours(r: DataFrame) -> DataFrame:
    """Readings with the time cut to the hour, so that devices share instants; of a
    device's readings in one hour the one with the smallest event id."""
    hour = F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz")
    first = F.min_by(F.struct(*[c for c in r.columns if c not in ("device_id", "ts")]), "event_id")
    return (r.groupBy("device_id", hour.alias("ts")).agg(first.alias("_r"))
             .select("device_id", "ts", *[F.col("_r")[c].alias(c) for c in r.columns if c not in ("device_id", "ts")]))


def monitor_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything the monitor receives (``eventlog.feed``) from one scan of the events.

    An event can be several things at once: a sign-up is a feed status and a mute
    press, a purchase is a sample and, for some ids, a clear or an export.
    """
    from pumpline.operators.clean import parse_reject

    ev = table(spark, sf_dir, "events")
    text = reading_text(readings_from_events(ev).withColumn("_type", F.col("event_type")), "_type")
    rows = parse_reject(text).drop("ok")
    eid, kind = F.col("event_id"), F.col("_type")
    is_status = kind.isin("error", "signup")
    kinds = F.array_compact(F.array(
        F.when(~is_status, F.lit("sample")), F.when(is_status, F.lit("status")), F.when(kind == "signup", F.lit("press")),
        F.when((kind == "purchase") & (eid % 17 == 0), F.lit("clear")), F.when((kind == "purchase") & (eid % 34 == 1), F.lit("export"))))
    rows = rows.select(
        "device_id", "ts", eid.cast("long").alias("event_id"), F.explode(kinds).alias("kind"), "row_key", "s04", "s10", "pred", "reason",
        "s04_num", "s10_num", "pred_num", F.when(eid % 2 == 0, "batch").otherwise("speed").alias("source"),
        (kind == "signup").alias("online"), kind.alias("detail"),
        F.concat(F.lit("/logs/"), eid.cast("string"), F.lit(".txt")).alias("path"),
        F.when(eid % 4 == 3, F.lit("disk full")).alias("error"))
    return rows


def raw_sensor_csv(spark: SparkSession, sf_dir: str, path: str) -> str:
    """The events as the original raw file: row index, time text, sensor_00 to sensor_51
    (sensor_15 empty), status.  Some times and some numbers cannot be read."""
    r = readings(spark, sf_dir)
    eid = F.col("event_id")
    time = F.when(eid % 97 == 0, F.lit("not a time")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    sensors = {4: F.col("s04").cast("string"), 10: F.when(eid % 89 == 0, F.lit("x1")).otherwise(F.col("s10").cast("string")),
               15: F.lit(None).cast("string")}
    fill = lambda i: ((eid * (i + 3)) % 101).cast("string")
    (r.select(eid.alias("_c0"), time.alias("timestamp"), *[sensors.get(i, fill(i)).alias(f"sensor_{i:02d}") for i in range(52)],
              F.coalesce("machine_status", F.lit("NORMAL")).alias("machine_status"))
      .write.mode("overwrite").option("header", True).csv(path))
    return path
