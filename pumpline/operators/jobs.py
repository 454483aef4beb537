"""Jobs that string the operators together on the original file layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pumpline.config import DEFAULT_PARAMS, Params
from pumpline.functions import expressions as X
from pumpline.operators import clean, ml
from pumpline.sources import files, wide

#: The raw file: a row index without a name, the time as text, sensors, the status.
def sensor_schema(n_sensors: int = 52) -> T.StructType:
    return T.StructType([T.StructField("_c0", T.LongType()), T.StructField("timestamp", T.StringType()),
                         *[T.StructField(f"sensor_{i:02d}", T.DoubleType()) for i in range(n_sensors)],
                         T.StructField("machine_status", T.StringType())])


def csv_to_served(spark: SparkSession, csv_path: str, root: str, p: Params = DEFAULT_PARAMS,
                  schema: T.StructType | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """CSV file -> cleaned table -> forest -> predictions -> keyed table.

    Steps: declared schema with bad lines kept apart; index column and empty
    sensor dropped; time typed, rows without a valid one kept apart; gaps filled
    with 0; binary label; features scaled and a forest fitted on the hash split's
    training part; every row predicted; the predictions joined to the cleaned rows
    by time and put into the keyed table.  Each step's table is written under
    ``root``.  Returns (served view, rejected lines, rows without a time).
    """
    good, rejected = files.read_csv_typed(spark, csv_path, schema or sensor_schema())
    timed, untimed = clean.split_bad_timestamps(good, "timestamp", "ts")
    labelled = clean.label_binary(clean.fill_zero(clean.drop_columns(timed).drop("timestamp")))
    labelled.write.mode("overwrite").parquet(f"{root}/cleaned")
    cleaned = ml.hash_split(spark.read.parquet(f"{root}/cleaned").withColumn("row_key", X.row_key("ts")), "row_key")
    names = clean.feature_columns(cleaned, ignore=("ts", "machine_status", "label", "row_key", "split", "split_bucket"))
    model = ml.fit_rf(cleaned.filter(F.col("split") == "train"), names, p, key="row_key")
    ml.score(model, cleaned).select("ts", F.col("prediction").alias("pred")).write.mode("overwrite").parquet(f"{root}/predictions")
    predicted = spark.read.parquet(f"{root}/predictions")
    joined = cleaned.join(predicted, "ts").select("row_key", "machine_status", "pred", F.col("sensor_04").alias("s04"),
                                                  F.col("sensor_10").alias("s10"), F.lit(1).alias("version"))
    wide.upsert_cells(spark, f"{root}/served", wide.unpivot_cells(joined, F.col("row_key"), "version"), 1)
    return wide.mapped_view(wide.read_cells(spark, f"{root}/served")), rejected, untimed
