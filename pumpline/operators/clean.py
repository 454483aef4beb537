"""Cleaning and typing of raw readings (batch cleaning job of the pipeline)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pumpline import config as C
from pumpline.functions.expressions import row_key as row_key_expr

TS_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
REJECT_MISSING = "missing"
REJECT_UNPARSEABLE = "unparseable"


def drop_columns(df: DataFrame, cols: Sequence[str] = ("sensor_15",),
                 index_cols: Sequence[str] = C.INDEX_COLUMNS) -> DataFrame:
    """Drop the configured columns and the row-index columns that CSV exports add.

    ``DataFrame.drop`` ignores absent names; an unnamed first header becomes
    ``_c0``, which would otherwise slip through and become a model feature.  A
    column really called ``index`` is data: name it in ``index_cols`` to drop it.
    """
    present = set(df.columns)
    return df.drop(*[c for c in [*cols, *index_cols] if c in present])


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column: NULL (or NaN) count, total, share, and whether it is 100 % missing.

    One aggregate pass over the data; the result has one row per column.
    """
    cols = list(cols or df.columns)
    types = dict(df.dtypes)

    def missing(c):
        m = F.col(c).isNull()
        if types[c] in ("double", "float"):
            m = m | F.isnan(F.col(c))
        return F.sum(F.when(m, 1).otherwise(0)).cast("long")

    agg = df.agg(F.count(F.lit(1)).alias("_total"), *[missing(c).alias(f"_m{i}") for i, c in enumerate(cols)])
    rows = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"), F.col(f"_m{i}").alias("null_count"))
                     for i, c in enumerate(cols)])
    return (agg.select("_total", F.inline(rows))
               .select(F.col("position").cast("int"), "column_name", "null_count",
                       F.col("_total").alias("total"),
                       F.try_divide(F.col("null_count"), F.col("_total")).alias("null_fraction"),
                       ((F.col("null_count") == F.col("_total")) & (F.col("_total") > 0)).alias("all_missing")))


def parse_timestamp(text) -> F.Column:
    """``yyyy-MM-dd HH:mm:ss`` text -> TIMESTAMP_NTZ, NULL (not an error) when invalid."""
    c = F.col(text) if isinstance(text, str) else text
    return F.when(c.rlike(TS_PATTERN), c.try_cast("timestamp_ntz"))


def split_bad_timestamps(df: DataFrame, text_col: str, out_col: str = "ts") -> tuple[DataFrame, DataFrame]:
    """(good rows with ``out_col``, quarantined rows) for a timestamp text column."""
    d = df.withColumn(out_col, parse_timestamp(text_col))
    return d.filter(F.col(out_col).isNotNull()), d.filter(F.col(out_col).isNull()).drop(out_col)


def parse_reject(wide_text: DataFrame, required: Sequence[str] = ("s04", "s10", "pred"),
                 key: str = "row_key") -> DataFrame:
    """Decode text cells to doubles and mark unusable rows.

    A row lacking a required cell is rejected as ``missing`` (checked first, as
    in the original reader); a cell that does not parse as a number makes it
    ``unparseable``.  Output keeps every row with ``ok`` and ``reason`` so one
    pass feeds both the good stream and the quarantine.
    """
    out = wide_text
    for c in required:
        out = out.withColumn(f"{c}_num", F.col(c).try_cast("double"))
    missing = F.lit(False)
    bad = F.lit(False)
    for c in required:
        missing = missing | F.col(c).isNull()
        bad = bad | F.col(f"{c}_num").isNull()
    reason = F.when(missing, F.lit(REJECT_MISSING)).when(bad, F.lit(REJECT_UNPARSEABLE))
    return out.withColumn("reason", reason).withColumn("ok", F.col("reason").isNull())


def good_rows(parsed: DataFrame, required: Sequence[str] = ("s04", "s10", "pred")) -> DataFrame:
    d = parsed.filter("ok")
    for c in required:
        d = d.drop(c).withColumnRenamed(f"{c}_num", c)
    return d.drop("ok", "reason")


def fill_zero(df: DataFrame) -> DataFrame:
    """``fillna(0)`` semantics: every numeric column, NULL and NaN -> 0; others untouched."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.coalesce(F.nanvl(c, F.lit(None).cast(f.dataType)), F.lit(0).cast(f.dataType))
        elif isinstance(f.dataType, NUMERIC):
            c = F.coalesce(c, F.lit(0).cast(f.dataType))
        out.append(c.alias(f.name))
    return df.select(*out)


def label_binary(df: DataFrame, status: str = "machine_status", out: str = "label") -> DataFrame:
    """NORMAL -> 0, anything else (including NULL) -> 1; case-sensitive, untrimmed."""
    return df.withColumn(out, F.when(F.col(status) == C.NORMAL_STATUS, 0).otherwise(1).cast("int"))


def feature_columns(df: DataFrame, ignore: Sequence[str] = ("timestamp", "ts", "machine_status", "label"),
                    index_cols: Sequence[str] = C.INDEX_COLUMNS) -> list[str]:
    """Every numeric column not ignored, in schema order; index columns are refused."""
    skip = set(ignore) | set(index_cols)
    return [f.name for f in df.schema.fields if f.name not in skip and isinstance(f.dataType, NUMERIC)]


def with_row_key(df: DataFrame, ts: str = "ts") -> tuple[DataFrame, DataFrame]:
    """(rows with the text row key, rows quarantined for a NULL timestamp)."""
    d = df.withColumn("row_key", row_key_expr(ts))
    return d.filter(F.col("row_key").isNotNull()), d.filter(F.col("row_key").isNull())


def status_distribution(df: DataFrame, status: str = "machine_status") -> DataFrame:
    return df.groupBy(status).agg(F.count(F.lit(1)).alias("n_rows"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def clean_readings(raw: DataFrame, ts_text: str | None = None) -> DataFrame:
    """The cleaning step: drop index/empty columns, type the timestamp, fill numeric gaps."""
    d = drop_columns(raw)
    if ts_text:
        d = d.withColumn(ts_text, parse_timestamp(ts_text))
    return fill_zero(d)


def write_with_metrics(df: DataFrame, path: str, status: str = "machine_status") -> DataFrame:
    """Write ``df`` as Parquet, then take row count + status histogram from the output.

    The original job counted and grouped the raw CSV in separate passes.  Here the
    input is read once (by the write); the metrics read one pruned column of the
    written Parquet.  Returns (status, n_rows) for every status there is, null included.
    (``DataFrame.observe`` would do it inside the write, but an ``Observation``
    left on the session makes later jobs fail to serialize in Spark 4.1.)
    """
    df.write.mode("overwrite").parquet(path)
    return status_distribution(df.sparkSession.read.parquet(path), status)
