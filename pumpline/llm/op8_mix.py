"""Mixing sources to target weights by hash-random keys and distributed prefix sums.

Every document gets a key from a hash of its id: a random order that reruns
repeat.  Within a source the key space is cut into equal ranges; since keys are
hashes, ranges of a source hold about the same share of it, however large the
source.  One running sum inside each range plus the sums of the ranges before
it (a small table) give every document the words that precede it in its source,
without one task ever holding a source.  A source whose target is e times its
size plus a rest gives every document e times, and the rest from the start of
the order; the document at the cut gives only the words that are missing, so
the words taken equal the target rounded to a whole word.

Targets: weights 5, 2, 1 repeat over the sources in code-point order, null last.
A target that would be above three times its source's size is set to that, and
the excess is shared among the others by weight until none is above.  Sorted by
size per weight, the capped sources are the first ones, so one pass decides.

Rows: null text has size 0 and takes 0; a null source is a source; rows equal in
every column are kept apart as rows and are in any order among themselves, which
does not show; an empty table gives no rows.  No Python runs on the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pumpline.llm.common import WORD, names, save

WEIGHTS = (5, 2, 1)
MOST_TIMES = 3

#: Leading hex digits of the key that name its range: 4,096 ranges for each source.
RANGE_DIGITS = 3


def targets(totals: DataFrame, weights=WEIGHTS, most: int = MOST_TIMES) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row for each source.

    The windows run over one row per source, never over documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (place + 1).cast("int"))
    t = totals.select("source", F.col("source_size"), w.alias("w"), (F.col("source_size") * float(most)).alias("cap"))
    all_ = Window.partitionBy(F.lit(0))
    before = Window.orderBy((F.col("cap") / F.col("w")), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    t = t.select("*", F.sum(F.col("source_size").cast("double")).over(all_).alias("total"), F.sum("w").over(all_).alias("ws"),
                 F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("cap0"), F.coalesce(F.sum("w").over(before), F.lit(0.0)).alias("w0"))
    t = t.withColumn("capped", F.col("cap") * (F.col("ws") - F.col("w0")) < (F.col("total") - F.col("cap0")) * F.col("w"))
    t = t.select("*", F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0.0)).over(all_).alias("cap1"),
                 F.sum(F.when(F.col("capped"), F.col("w")).otherwise(0.0)).over(all_).alias("w1"))
    free = (F.col("total") - F.col("cap1")) * F.col("w") / (F.col("ws") - F.col("w1"))
    return t.select("source", "source_size", F.when(F.col("capped"), F.col("cap")).otherwise(F.least("cap", free)).alias("target"))


def _range_key(source: Column, r: Column) -> Column:
    """Text of a source's range, never null: a struct's type would differ between a table that was saved and one that was not,
    and the cast would cost the join and the window one shuffle each."""
    return F.concat(r, F.when(source.isNull(), "-").otherwise(F.concat(F.lit("+"), source)))


def mix(spark: SparkSession, docs: DataFrame, everything: bool = False) -> DataFrame:
    """One row for each row of ``docs`` (with all its columns in ``__row`` if ``everything``): __id, __size, __source_size, __target and __taken."""
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    size = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    slim = docs.select(F.col("source").cast("string").alias("source"), F.substring(key, 1, RANGE_DIGITS).alias("r"), size.alias("size"))
    ranges = save(spark, slim.groupBy("source", "r").agg(F.sum("size").alias("size")), "mix-ranges")
    goal = targets(ranges.groupBy("source").agg(F.sum("size").alias("source_size")))
    ahead = Window.partitionBy("source").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranges.select(F.col("source"), "r", F.coalesce(F.sum("size").over(ahead), F.lit(0)).alias("offset"))
               .join(goal.withColumnRenamed("source", "goal_source"), F.col("source").eqNullSafe(F.col("goal_source")))
               .select(_range_key(F.col("source"), F.col("r")).alias("__range"), *[F.col(c).alias(f"__{c}") for c in ("offset", "source_size", "target")]))
    offsets = save(spark, offsets, "mix-offsets")
    # source and range as one key: null-safe, and the join and the window need the same partitions
    rows = docs.select(*([F.struct(*names(docs)).alias("__row")] if everything else []),
                       _range_key(F.col("source").cast("string"), F.substring(key, 1, RANGE_DIGITS)).alias("__range"),
                       F.col("doc_id").alias("__id"), key.alias("__key"), size.alias("__size"))
    rows = rows.join(offsets, "__range")
    order = Window.partitionBy("__range").orderBy("__key", "__id", "__size").rowsBetween(Window.unboundedPreceding, -1)
    ahead_words = F.col("__offset") + F.coalesce(F.sum("__size").over(order), F.lit(0))
    goal_words = F.floor(F.col("__target") + 0.5)
    epochs = F.when(F.col("__source_size") > 0, F.floor(goal_words / F.greatest(F.col("__source_size"), F.lit(1)))).otherwise(0)
    rest = goal_words - epochs * F.col("__source_size")
    taken = epochs * F.col("__size") + F.greatest(F.lit(0), F.least(F.col("__size"), rest - ahead_words))
    return rows.withColumn("__taken", taken.cast("long"))


def digest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Contract columns: doc_id, size, source_size, target, taken."""
    m = mix(spark, docs)
    return m.select(F.col("__id").alias("doc_id"), F.col("__size").alias("size"), F.col("__source_size").alias("source_size"),
                    F.col("__target").alias("target"), F.col("__taken").alias("taken"))


def mixed_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The mix itself: the documents that give any words, with their size and the words taken.

    Added columns (replacing columns of these names): mix_size, mix_source_size, mix_target, mix_taken.
    """
    added = {"mix_size": "__size", "mix_source_size": "__source_size", "mix_target": "__target", "mix_taken": "__taken"}
    m = mix(spark, docs, everything=True)
    keep = [F.col("__row").getField(n).alias(n) for n in docs.columns if n.lower() not in added]
    return m.where("__taken > 0").select(*keep, *[F.col(v).alias(k) for k, v in added.items()])


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, md5(COALESCE(CAST(doc_id AS VARCHAR), '')) AS k,
         COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
t AS (SELECT source, SUM(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][1 + (ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w,
             source_size * 3.0::DOUBLE AS cap FROM t),
p AS (SELECT *, SUM(source_size::DOUBLE) OVER () AS total, SUM(w) OVER () AS ws,
             COALESCE(SUM(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cap0,
             COALESCE(SUM(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w0
      FROM w),
c AS (SELECT *, cap * (ws - w0) < (total - cap0) * w AS capped FROM p),
g AS (SELECT source, source_size,
             CASE WHEN capped THEN cap ELSE LEAST(cap, (total - COALESCE(SUM(cap) FILTER (capped) OVER (), 0)) * w
                  / (ws - COALESCE(SUM(w) FILTER (capped) OVER (), 0))) END AS target
      FROM c),
r AS (SELECT d.doc_id, d.size, g.source_size, g.target, floor(g.target + 0.5)::BIGINT AS goal,
             COALESCE(SUM(d.size) OVER (PARTITION BY d.source ORDER BY k, d.doc_id, d.size
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size > 0 THEN goal // source_size ELSE 0 END * size
        + GREATEST(0, LEAST(size, goal - (CASE WHEN source_size > 0 THEN goal // source_size ELSE 0 END) * source_size - ahead)))::BIGINT AS taken
FROM r
"""
