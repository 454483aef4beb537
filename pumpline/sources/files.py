"""File sources and sinks: CSV with an explicit schema, bronze landing,
partitioned Parquet, and catalog tables over existing Parquet folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pumpline.operators.clean import drop_columns

CORRUPT = "_corrupt_record"
TS_NTZ_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"

READING_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("device_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("s04", T.DoubleType()),
    T.StructField("s10", T.DoubleType()),
    T.StructField("pred", T.DoubleType()),
    T.StructField("machine_status", T.StringType()),
])


def write_csv(df: DataFrame, path: str) -> None:
    (df.write.mode("overwrite").option("header", True)
       .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path))


def read_csv_typed(spark: SparkSession, path: str, schema: T.StructType = READING_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """CSV with a declared schema: no inference pass; bad rows are quarantined.

    Returns (good rows, rejected rows with the raw line).  Index columns a
    spreadsheet export adds (``_c0``, ``Unnamed: 0``) are dropped.
    """
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    raw = (spark.read.schema(full).option("header", True).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", CORRUPT)
           .option("timestampNTZFormat", TS_NTZ_FORMAT).csv(path))
    # A row is only valid if every field parses, but the CSV reader parses just
    # the referenced columns (and refuses scans that reference only the
    # corrupt-record column, e.g. ``bad.count()``).  An always-true test over all
    # fields, which the optimizer cannot fold, keeps every field parsed.
    anchor = F.length(F.concat_ws("", *[F.col(f.name).cast("string") for f in schema.fields])) >= 0
    good = drop_columns(raw.filter(F.col(CORRUPT).isNull() & anchor).drop(CORRUPT))
    bad = raw.filter(F.col(CORRUPT).isNotNull() & anchor).select(CORRUPT)
    return good, bad


def bronze_landing(spark: SparkSession, csv_path: str, out_path: str) -> DataFrame:
    """Lossless landing: every column as text plus the source file, written as Parquet."""
    raw = (spark.read.option("header", True).option("inferSchema", False).csv(csv_path)
           .withColumn("source_file", F.col("_metadata.file_path")))
    raw.write.mode("overwrite").parquet(out_path)
    return spark.read.parquet(out_path)


def write_partitioned(df: DataFrame, path: str, ts: str = "ts", part: str = "dt",
                      key: str = "device_id") -> None:
    """Parquet sink partitioned by day, rows clustered by device and time inside files.

    Range partitioning on (day, device, time) gives each task a contiguous slice:
    a heavy day is spread over many tasks and files, light days share a task, the
    adaptive shuffle sizes the parts,
    and min/max statistics on device and time stay tight for pruning.
    """
    (df.withColumn(part, F.to_date(ts))
       .repartitionByRange(part, key, ts)
       .sortWithinPartitions(part, key, ts)
       .write.mode("overwrite").partitionBy(part).parquet(path))


def write_bucketed(df: DataFrame, table: str, location: str, keys: list[str], buckets: int) -> DataFrame:
    """Save ``df`` bucketed and sorted by ``keys``: one file a bucket, so tables with the same
    keys and bucket count join without a shuffle or a sort.

    ``buckets`` is the same for all tables that are to be joined; choose it so that a
    bucket of the largest one fits a task.
    """
    (df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").option("path", location)
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))
    return df.sparkSession.table(table)


def create_external_table(spark: SparkSession, db: str, table: str, location: str, db_location: str,
                          ddl_columns: str) -> DataFrame:
    """Database + external table over an existing Parquet folder, both idempotent."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{db_location}'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {db}.{table} ({ddl_columns}) USING parquet LOCATION '{location}'")
    return spark.table(f"{db}.{table}")
