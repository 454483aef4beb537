"""Helpers shared by the operators: saved intermediates, text batches, components."""

from __future__ import annotations

import gc
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pumpline.session import ship_package, work_path

#: White space between words: space and the ASCII controls 9 to 13 (the class of every word contract).
WORD = r"[^\x20\x09-\x0D]+"

#: Rows of one Arrow batch that goes to Python.  Texts are long, so the default
#: of 10,000 rows would put tens of megabytes (or far more) into each batch.
BATCH_ROWS = 256


def ready(spark: SparkSession) -> None:
    """Ship the package to the executors and keep Arrow batches of texts small."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def save(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back: one evaluation, no lineage.

    A lost executor costs nothing that was saved, unlike a local checkpoint.
    """
    path = work_path(spark, f"llm-{name}")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.saved_path = path
    return out


def discard(spark: SparkSession, *saved: DataFrame) -> None:
    """Delete tables of ``save`` that nothing reads any more, and let Spark clean up the shuffles of what wrote them.

    Shuffle files go when the driver's garbage collector has found their plans.
    """
    for df in saved:
        path = spark._jvm.org.apache.hadoop.fs.Path(df.saved_path)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    gc.collect()
    spark._jvm.System.gc()


def names(df: DataFrame) -> list[Column]:
    """All columns of ``df`` by exact name (names may hold dots)."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Column names like ``wanted`` that ``df`` does not have, whatever their case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def numbered(spark: SparkSession, df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` saved with a row number, and the number's column.

    What is read back has the same number in every later scan.  A number taken
    from the scan itself would not: how files are split follows the executors
    that are there at that moment.
    """
    (rid,) = fresh(df, "row_number")
    return save(spark, df.select(F.monotonically_increasing_id().alias(rid), *names(df)), name), rid


def crc_mod(col: Column, m: int) -> Column:
    """crc32 of the value as text, modulo ``m``; a null value counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(col.cast("string"), F.lit(""))), F.lit(m))


def chunks(items: Iterable, weight, most: int) -> Iterator[list]:
    """Consecutive items in lists whose total weight is about ``most`` at most.

    A single item above ``most`` makes a list of its own: it is never cut.
    """
    out, total = [], 0
    for x in items:
        w = weight(x)
        if out and total + w > most:
            yield out
            out, total = [], 0
        out.append(x)
        total += w
    if out:
        yield out


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """Connected components of the undirected ``edges`` (a, b; long): rows (node, root).

    Contraction: every node hooks to the neighbour (or itself) that is first in a
    hashed order, the hooks are followed one step further, and the edges are
    rewritten to the hooks.  Hashed order makes monotone chains short, so the
    number of rounds is logarithmic in the size of a component, whatever its
    shape.  ``root`` is some node of the component (the same for all its nodes),
    not the smallest one.  Every join reads two saved tables, so a hub's rows
    can be split by the adaptive skew join; minima are combined before the shuffle.

    Self-links are ignored; no edges give no rows.
    """
    e = save(spark, edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
             .where("a < b").distinct(), "edges")
    roots = None
    while True:
        if e.isEmpty():
            break
        both = e.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            e.select(F.col("b").alias("node"), F.col("a").alias("other")))
        order = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("v"))
        hook = save(spark, both.groupBy("node").agg(F.min(order("other")).alias("o"))
                    .select("node", F.least(order("node"), F.col("o"))["v"].alias("hook")), "hook")
        nxt = hook.select(F.col("node").alias("hook"), F.col("hook").alias("far"))
        hook = save(spark, hook.join(nxt, "hook", "left")
                    .select("node", F.coalesce("far", "hook").alias("hook")), "hook2")
        if roots is None:
            roots = hook.select("node", F.col("hook").alias("root"))
        else:
            roots = save(spark, roots.join(hook.select(F.col("node").alias("root"), "hook"), "root", "left")
                         .select("node", F.coalesce("hook", "root").alias("root")), "roots")
        ha = hook.select(F.col("node").alias("a"), F.col("hook").alias("ra"))
        hb = hook.select(F.col("node").alias("b"), F.col("hook").alias("rb"))
        e = save(spark, e.join(ha, "a").join(hb, "b").where("ra <> rb")
                 .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges")
    if roots is None:
        return spark.createDataFrame([], "node long, root long")
    return roots


def hash_sample(df: DataFrame, column: str, most: int) -> DataFrame:
    """One row (the smallest) for each of the ``most`` smallest hashes of ``column``: a bounded sample without copies.

    The hashes are found first (8 bytes each), so no task sends more than that.
    """
    h = F.xxhash64(column)
    first = [r[0] for r in df.select(h.alias("h")).distinct().orderBy("h").limit(most).collect()]
    rows = df.withColumn("__h", h).where(F.col("__h").isin(first) if first else F.lit(False))
    return rows.groupBy("__h").agg(F.min(F.struct(*names(df))).alias("__r")).orderBy("__h").select("__r.*")
