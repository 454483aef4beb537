"""Turns a given table into a file stream, for the registered streaming queries.

A fixture: production streams come from ``spark.readStream`` directly.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pumpline.functions import expressions as X
from pumpline.streaming.pipelines import CLOSING


@dataclass(frozen=True)
class Replay:
    path: str
    schema: T.StructType
    files_per_trigger: int
    delay: str           # watermark delay that covers one slice of arrival disorder
    delay_s: int


def replay(spark: SparkSession, df: DataFrame, path: str, n_slices: int = 4, ts: str = "ts", key: str = "device_id",
           late: Column | None = None, end_after_s: int | None = None) -> Replay:
    """Write ``df`` as a file stream in event-time slices, oldest slice first.

    File sources admit files in modification order, so slices are written one after
    another; a micro-batch takes as many files as the largest slice has (the
    adaptive shuffle decides).  Rows of the first slice for which ``late`` holds
    arrive after the last slice, long behind the watermark.  ``df`` is computed once, into
    the shared folder; its span and the slices are read from there.  ``end_after_s`` marks the
    rows (column ``CLOSING``) and adds a closing one, so much after the end: it
    carries the watermark past everything that waits for it.
    """
    if end_after_s is not None:
        df = df.withColumn(CLOSING, F.lit(False))
    df.write.parquet(f"{path}_all")
    df = spark.read.schema(df.schema).parquet(f"{path}_all")
    sec = X.epoch_seconds(ts)
    lo, hi = df.agg(F.min(sec), F.max(sec)).first()
    if lo is None:
        df.limit(0).write.mode("append").parquet(path)
        return Replay(path, df.schema, 1, "1 hour", 3600)
    width = max(1, (hi - lo) // n_slices + 1)
    delay_s = width + 3600
    piece = F.floor((sec - lo) / width)
    if late is not None:
        piece = F.when((piece == 0) & late, n_slices).otherwise(piece)
    files, seen = 1, 0
    for i in range(n_slices + (late is not None)):
        df.filter(piece == i).repartition(key).write.mode("append").parquet(path)
        now = len(spark.read.schema(df.schema).parquet(path).inputFiles())
        files, seen = max(files, now - seen), now
    if end_after_s is not None:
        end = df.agg(F.max(ts).alias(ts)).select(X.plus_seconds(ts, delay_s + int(end_after_s)).alias(ts))
        known = {ts: F.col(ts), CLOSING: F.lit(True)}
        row = [known.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in df.schema.fields]
        end.select(*row).write.mode("append").parquet(path)
    return Replay(path, df.schema, files, f"{delay_s} seconds", delay_s)


def source(spark: SparkSession, rp: Replay) -> DataFrame:
    return (spark.readStream.schema(rp.schema).option("maxFilesPerTrigger", rp.files_per_trigger)
            .parquet(rp.path))
