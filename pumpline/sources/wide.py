"""Wide-column (key/family/qualifier/value) view of readings.

The serving table of the original pipeline is a key/value store whose row key
is the text of the timestamp.  Here the table is a cell-level Parquet dataset
``(row_key, family, qualifier, value, version)`` partitioned by the date part
of the key; pivoting it gives the typed relational view.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pumpline import config as C

# source column of each (family, qualifier) cell
CELL_SOURCES = {("status", "real"): "machine_status", ("status", "pred"): "pred",
                ("wave", "s04"): "s04", ("wave", "s10"): "s10"}
CELL_KEY_COLS = ["row_key", "family", "qualifier"]


def cell_name(family: str, qualifier: str) -> str:
    return f"{family}:{qualifier}"


def unpivot_cells(df: DataFrame, key_col: Column, version_col: str,
                  cells=C.WIDE_CELLS) -> DataFrame:
    """One row -> one cell per non-null mapped column (a NULL is an absent cell)."""
    arr = F.array(*[
        F.struct(F.lit(f).alias("family"), F.lit(q).alias("qualifier"),
                 F.col(CELL_SOURCES[(f, q)]).cast("string").alias("value"))
        for f, q in cells])
    return (df.select(key_col.alias("row_key"), F.col(version_col).cast("long").alias("version"),
                      F.inline(arr))
              .filter(F.col("value").isNotNull())
              .select("row_key", "family", "qualifier", "value", "version"))


def pivot_cells(cells: DataFrame, cells_wanted=C.WIDE_CELLS) -> DataFrame:
    """Cells -> one text row per key; each cell takes its newest version.

    A conditional ``max_by`` per cell is one hash aggregate with a map-side
    partial step, so a key that is written many times is combined before the
    shuffle.
    """
    name = F.concat_ws(":", "family", "qualifier")
    aggs = [F.max_by(F.col("value"), F.when(name == cell_name(f, q), F.col("version"))).alias(q)
            for f, q in cells_wanted]
    return cells.groupBy("row_key").agg(*aggs)


def mapped_view(cells: DataFrame) -> DataFrame:
    """Typed relational mapping: key, wave:s04, wave:s10, status:pred as FLOAT.

    ``status:real`` is not mapped; an absent or unparseable cell is NULL.
    """
    t = pivot_cells(cells, (("wave", "s04"), ("wave", "s10"), ("status", "pred")))
    return t.select("row_key", *[F.expr(f"try_cast({c} as float)").alias(c) for c in ("s04", "s10", "pred")])


def latest_row(cells: DataFrame, cells_wanted=C.WIDE_CELLS) -> DataFrame:
    """Newest row by key (reverse scan, limit 1).

    The largest key comes first, from the key column alone (a map-side maximum,
    answered by the newest date partition where the table has them); only that
    key's cells are then read and pivoted.
    """
    key = cells.agg(F.max("row_key")).first()[0]
    return pivot_cells(cells.where(F.col("row_key") == F.lit(key)), cells_wanted)


def decode_key(key_bytes) -> Column:
    """Bytes -> text, dropping invalid UTF-8 sequences instead of failing."""
    c = F.col(key_bytes) if isinstance(key_bytes, str) else key_bytes
    return F.regexp_replace(F.make_valid_utf8(c.cast("string")), "�", "")


# --- keyed upsert: committed batches, merged when read ------------------------------
#
# <root>/cells/batch=<id>/dt=<date>/   the cells of one batch, last put per key
# <root>/base/gen=<n>/dt=<date>/       merged batches (compaction), each cell with the batch that put it
# <root>/commits/<kind>-<id>/          one row: that folder is complete; a base's row lists the batches in it
#
# A writer never touches what is committed.  A run that dies leaves an uncommitted
# folder, which no reader looks at and which the retry replaces.

CELL_SCHEMA = "row_key string, family string, qualifier string, value string, version long"
COMMIT_SCHEMA = "kind string, id long, merged array<long>"


def _commits(spark: SparkSession, root: str) -> DataFrame | None:
    """Committed folders; None if the table has none yet.  Any other failure is raised."""
    try:
        return spark.read.schema(COMMIT_SCHEMA).parquet(f"{root}/commits/*")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _commit(spark: SparkSession, root: str, kind: str, number: int, merged: list[int] | None = None) -> None:
    (spark.createDataFrame([(kind, number, merged)], COMMIT_SCHEMA).coalesce(1)
     .write.mode("overwrite").parquet(f"{root}/commits/{kind}-{number}"))


def _state(spark: SparkSession, root: str) -> tuple[int | None, set[int], set[int]]:
    """The newest base's number, the batches in it, and the committed batches that are not."""
    done = _commits(spark, root)
    rows = [] if done is None else done.collect()  # one small row for each batch
    base = max((r for r in rows if r["kind"] == "base"), key=lambda r: r["id"], default=None)
    merged = set(base["merged"]) if base else set()
    return base["id"] if base else None, merged, {r["id"] for r in rows if r["kind"] == "batch"} - merged


def committed(spark: SparkSession, root: str) -> set[int]:
    """The batches that the table holds."""
    _, merged, newer = _state(spark, root.rstrip("/"))
    return merged | newer


def is_committed(spark: SparkSession, root: str, batch_id: int) -> bool:
    return int(batch_id) in committed(spark, root)


def _write_cells(cells: DataFrame, path: str, part_col: str) -> None:
    """Range-partitioned by (date, key): files per date follow the date's volume, their
    number the adaptive shuffle."""
    (cells.repartitionByRange(part_col, "row_key").sortWithinPartitions(part_col, "row_key")
     .write.mode("overwrite").partitionBy(part_col).parquet(path))


def upsert_cells(spark: SparkSession, root: str, batch: DataFrame, batch_id: int, part_col: str = "dt") -> None:
    """Keyed upsert: a put on an existing cell replaces it (last put wins).

    Within a batch, puts are ordered by version; across batches, a larger batch id
    wins, in whatever order the batches arrive.  A batch is written once, whatever
    the table's size: nothing is read or rewritten (``read_cells`` merges,
    ``compact_cells`` keeps that cheap).  A batch id that is committed is not
    written again, so a replayed batch changes nothing; one that arrives late, also
    after a compaction of younger ones, takes its place among them.
    """
    root = root.rstrip("/")
    if is_committed(spark, root, batch_id):
        return
    put = F.max(F.struct("version", "value")).alias("_w")
    cells = (batch.groupBy(*CELL_KEY_COLS).agg(put)
             .select(*CELL_KEY_COLS, F.col("_w.value").alias("value"), F.col("_w.version").alias("version"))
             .withColumn(part_col, F.substring("row_key", 1, 10)))
    _write_cells(cells, f"{root}/cells/batch={int(batch_id)}", part_col)
    _commit(spark, root, "batch", int(batch_id))


def _merged(spark: SparkSession, root: str, dates: list[str] | None, part_col: str) -> tuple[DataFrame | None, set[int], int | None]:
    """(cells with the batch that put them, the batches they come from, the newest base)."""
    base, merged, newer = _state(spark, root)
    parts, schema = [], f"{CELL_SCHEMA}, batch long, {part_col} string"
    if base is not None:
        parts.append(spark.read.schema(schema).parquet(f"{root}/base/gen={base}"))
    if newer:
        parts.append(spark.read.schema(schema).option("basePath", f"{root}/cells")
                     .parquet(*[f"{root}/cells/batch={b}" for b in sorted(newer)]))
    if not parts:
        return None, set(), base
    cells = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    if dates is not None:
        cells = cells.where(F.col(part_col).isin(dates))
    newest = F.max(F.struct("batch", "version", "value")).alias("_w")
    cells = (cells.groupBy(*CELL_KEY_COLS).agg(newest)
             .select(*CELL_KEY_COLS, F.col("_w.value").alias("value"), F.col("_w.version").alias("version"), F.col("_w.batch").alias("batch")))
    return cells, merged | newer, base


def read_cells(spark: SparkSession, root: str, dates: list[str] | None = None, part_col: str = "dt") -> DataFrame:
    """The table: per cell the put of the newest batch.  ``dates`` reads only those date partitions."""
    cells, _, _ = _merged(spark, root.rstrip("/"), dates, part_col)
    return spark.createDataFrame([], CELL_SCHEMA) if cells is None else cells.drop("batch")


def compact_cells(spark: SparkSession, root: str, part_col: str = "dt", least: int = 1) -> bool:
    """Merge all committed batches into a new base, if at least ``least`` are not in one yet.

    Readers switch to the base when it is committed.  Its cells keep the number of
    their batch, and its commit lists the batches, so an older batch that arrives
    later is still read and loses only to younger puts.
    """
    root = root.rstrip("/")
    if len(_state(spark, root)[2]) < max(1, least):
        return False
    cells, inside, base = _merged(spark, root, None, part_col)
    number = 1 if base is None else base + 1
    _write_cells(cells.withColumn(part_col, F.substring("row_key", 1, 10)), f"{root}/base/gen={number}", part_col)
    _commit(spark, root, "base", number, sorted(inside))
    return True
