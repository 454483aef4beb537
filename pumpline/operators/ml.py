"""Failure model: features, standardisation, split, random forest, exact AUC."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pumpline.config import DEFAULT_PARAMS, Params
from pumpline.functions.expressions import hash_bucket
from pumpline.plans.sequencing import B, range_buckets


def assemble(df: DataFrame, features: Sequence[str], out: str = "raw_features") -> DataFrame:
    """Feature vector; a NULL input raises (fill first), as in the original job."""
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="error").transform(df)


def feature_stats(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean and sample standard deviation per feature, one aggregate pass."""
    aggs = []
    for f in features:
        aggs += [F.avg(f).alias(f"m_{f}"), F.stddev_samp(f).alias(f"s_{f}")]
    row = df.agg(*aggs)
    arr = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(f).alias("feature"),
                             F.col(f"m_{f}").alias("mean"), F.col(f"s_{f}").alias("std"))
                    for i, f in enumerate(features)])
    return row.select(F.inline(arr)).withColumn("position", F.col("position").cast("int"))


def standardize_columns(df: DataFrame, features: Sequence[str], suffix: str = "_z") -> DataFrame:
    """(x - mean) / std with the fitted scalars; std 0 gives 0.0.

    The fit is one aggregate returning two numbers per feature (the model
    parameters, like MLlib's scaler model); the transform uses them as
    constants, so there is no ``avg() over ()`` and no join.
    """
    aggs = []
    for f in features:
        aggs += [F.avg(f).alias(f"m_{f}"), F.stddev_samp(f).alias(f"s_{f}")]
    fit = df.agg(*aggs).first()
    out = df
    for f in features:
        m, sd = fit[f"m_{f}"], fit[f"s_{f}"]
        z = F.lit(0.0) if not sd else (F.col(f) - F.lit(m)) / F.lit(sd)
        out = out.withColumn(f"{f}{suffix}", z)
    return out


def standardize(df: DataFrame, features: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """MLlib form: assemble + StandardScaler(withMean, withStd) -> ``features`` vector."""
    a = assemble(df, features)
    model = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True) \
        .fit(assemble(fit_on, features) if fit_on is not None else a)
    return model.transform(a)


def hash_split(df: DataFrame, key: str, train_pct: int = DEFAULT_PARAMS.train_pct) -> DataFrame:
    """Deterministic train/test label from md5(key): same split on any partitioning."""
    b = hash_bucket(key)
    return df.withColumn("split_bucket", b).withColumn(
        "split", F.when(F.col("split_bucket") < train_pct, F.lit("train")).otherwise(F.lit("test")))


def rf_pipeline(features: Sequence[str], p: Params = DEFAULT_PARAMS, label: str = "label") -> Pipeline:
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="raw_features", handleInvalid="error"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
        RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=p.num_trees,
                               maxDepth=p.max_depth, seed=p.seed),
    ])


def train_parts(rows: DataFrame, p: Params = DEFAULT_PARAMS) -> int:
    """Parts of the training rows: at most ``train_rows_per_part`` rows each on average."""
    return max(p.train_partitions, -(-rows.count() // p.train_rows_per_part))


def fit_rf(train: DataFrame, features: Sequence[str], p: Params = DEFAULT_PARAMS,
           label: str = "label", key: str | None = None) -> PipelineModel:
    """Fit assembler + scaler + forest.  The forest makes one pass per tree level,
    so only the needed columns are cached for the fit and released afterwards.

    The scaler is part of the pipeline, so it is fitted on the training rows only.
    The forest bags per partition.  With ``key`` the rows are hash-partitioned by it
    into sorted parts, whose number follows the rows (``train_parts``), so the same rows
    give the same model on any cluster and any layout; without, the input's
    partitions are used.

    The fitted forest carries its training summary, which holds the session, and a
    session on which ``observe`` was called cannot be sent to tasks.  The model that is
    returned is a copy, which has no summary.
    """
    cols = list(dict.fromkeys([*features, label, *([key] if key else [])]))
    rows = train.select(*cols)
    if key:
        rows = rows.repartition(train_parts(rows, p), key).sortWithinPartitions(*cols)
    rows = rows.persist()
    try:
        return rf_pipeline(features, p, label).fit(rows).copy()
    finally:
        rows.unpersist()


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Predictions with the positive-class probability as a plain double."""
    out = model.transform(df)
    return (out.withColumn("score", vector_to_array("probability")[1])
               .withColumn("raw_score", vector_to_array("rawPrediction")[1]))


def evaluator_auc(scored: DataFrame, label: str = "label", num_bins: int = 0) -> float:
    """MLlib's evaluator.  ``num_bins=0`` is exact (cross-checks auc_exact); the
    original job used the default of 1000 bins."""
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction",
                                         metricName="areaUnderROC", numBins=num_bins).evaluate(scored)


def auc_exact(df: DataFrame, score: str, label: str) -> DataFrame:
    """Area under ROC by rank sums over distinct scores (ties count one half).

    1. aggregate to distinct scores (positives, negatives per score);
    2. range-partition them by score, written with their partition's number: the
       number of parts follows the data (adaptive shuffle), the parts are even;
    3. negative totals per part -> offsets (a window over one row per part);
    4. negatives below each score = offset + window within its part.
    No step orders all distinct scores in one task.  NULL without both classes.
    """
    pos = F.col(label).cast("boolean")
    per = df.groupBy(F.col(score).alias("sc")).agg(
        F.sum(F.when(pos, 1).otherwise(0)).cast("long").alias("p"),
        F.sum(F.when(pos, 0).otherwise(1)).cast("long").alias("n"))
    ranged = range_buckets(per, ["sc"])
    tot = ranged.groupBy(B).agg(F.sum("n").alias("rn"))
    offs = tot.select(B, F.coalesce(F.sum("rn").over(Window.orderBy(B).rowsBetween(Window.unboundedPreceding, -1)),
                                    F.lit(0)).alias("off"))
    w = Window.partitionBy(B).orderBy("sc").rowsBetween(Window.unboundedPreceding, -1)
    cn = ranged.withColumn("cn_in", F.coalesce(F.sum("n").over(w), F.lit(0))).join(offs, B)
    part = cn.agg(F.sum(F.col("p").cast("double") * ((F.col("off") + F.col("cn_in")).cast("double")
                                                     + F.col("n").cast("double") / F.lit(2.0))).alias("num"),
                  F.sum("p").alias("P"), F.sum("n").alias("N"))
    return part.select(F.try_divide(F.col("num"), F.col("P").cast("double") * F.col("N").cast("double")).alias("auc"))


def confusion(scored: DataFrame, label: str = "label") -> DataFrame:
    return scored.groupBy(label, "prediction").agg(F.count(F.lit(1)).alias("n_rows"))
