"""Polling source: a stream over the keyed table whose offset is the last row key it has seen.

Each poll asks for the table's newest key and reads the cells of the keys after the
last one.  A poll that finds no newer key reads nothing, so the same key is never
delivered twice, also after a restart from the checkpoint.  A key that is written
later but sorts before the last one is not delivered, nor is a later put on a key
that was (the batch view is there for those).  Rows without a key are not polled.

The newest key comes from the footers of the newest date's files; a poll reads only
files of the dates between the two keys, one task for each file, batch by batch.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import dataset, fs, parquet
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from pumpline.sources import wide

# The reader's part of this module goes to Spark's source process by value: that one
# does not get the files shipped to the executors.  So it names nothing else of the package.

CELLS = pa.schema([("row_key", pa.string()), ("family", pa.string()), ("qualifier", pa.string()), ("value", pa.string()),
                   ("version", pa.int64()), ("batch", pa.int64())])
DATE_LETTERS = 10  # of the row key; names its partition


@dataclass
class KeyRange(InputPartition):
    path: str
    after: str
    upto: str
    batch: int | None  # None: the file says it


class PolledCells(DataSource):
    """Options: ``root`` (a table of ``wide.upsert_cells``), ``after`` (start behind this key)."""

    @classmethod
    def name(cls) -> str:
        return "pumpline_poll"

    def schema(self) -> str:
        return "row_key string, family string, qualifier string, value string, version long, batch long"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return PollReader(self.options["root"].rstrip("/"), self.options.get("after", ""))


class PollReader(DataSourceStreamReader):
    def __init__(self, root: str, after: str):
        self.root, self.after, self.last = root, after, after

    def initialOffset(self) -> dict:
        return {"key": self.after}

    def latestOffset(self) -> dict:
        files, root = _open(self.root)
        self.last = max(self.last, _newest_key(files, root))
        return {"key": self.last}

    def partitions(self, start: dict, end: dict) -> list[KeyRange]:
        files, root = _open(self.root)
        after, upto = start["key"], end["key"]
        if upto <= after:
            return []
        return [KeyRange(f, after, upto, batch) for folder, batch in _folders(files, root)
                for date, path in _dates(files, folder) if after[:DATE_LETTERS] <= date <= upto[:DATE_LETTERS]
                for f in _data_files(files, path)]

    def read(self, part: KeyRange) -> Iterator[pa.RecordBatch]:
        files, _ = _open(self.root)
        key = pc.field("row_key")
        names = [n for n in CELLS.names if n != "batch" or part.batch is None]
        found = dataset.dataset(part.path, filesystem=files, format="parquet")
        for rows in found.to_batches(columns=names, filter=(key > part.after) & (key <= part.upto), batch_size=10_000):
            if part.batch is not None:
                rows = rows.append_column("batch", pa.array([part.batch] * rows.num_rows, pa.int64()))
            if rows.num_rows:
                yield rows.cast(CELLS)


def _open(root: str) -> tuple[fs.FileSystem, str]:
    if "://" in root or root.startswith("file:"):
        return fs.FileSystem.from_uri(root)
    return fs.LocalFileSystem(), root


def _list(files: fs.FileSystem, folder: str) -> list[fs.FileInfo]:
    return files.get_file_info(fs.FileSelector(folder, allow_not_found=True))


def _folders(files: fs.FileSystem, root: str) -> list[tuple[str, int | None]]:
    """Committed folders (the newest base, and the batches that are not in it) with their batch."""
    rows = [r for c in _list(files, f"{root}/commits") for f in _data_files(files, c.path)
            for r in parquet.read_table(f, filesystem=files).to_pylist()]
    base = max((r for r in rows if r["kind"] == "base"), key=lambda r: r["id"], default=None)
    inside = set(base["merged"]) if base else set()
    newer = sorted({r["id"] for r in rows if r["kind"] == "batch"} - inside)
    return ([(f"{root}/base/gen={base['id']}", None)] if base else []) + [(f"{root}/cells/batch={b}", b) for b in newer]


def _dates(files: fs.FileSystem, folder: str) -> list[tuple[str, str]]:
    named = [(i.base_name.partition("=")[2], i.path) for i in _list(files, folder) if i.base_name.startswith("dt=")]
    return [(unquote(d), path) for d, path in named if d != "__HIVE_DEFAULT_PARTITION__"]


def _data_files(files: fs.FileSystem, folder: str) -> list[str]:
    return sorted(i.path for i in _list(files, folder) if i.base_name.endswith(".parquet") and i.base_name[0] not in "._")


def _newest_key(files: fs.FileSystem, root: str) -> str:
    dates = [(d, path) for folder, _ in _folders(files, root) for d, path in _dates(files, folder)]
    top = max((d for d, _ in dates), default=None)
    keys = [_largest(files, f) for d, path in dates if d == top for f in _data_files(files, path)]
    return max((k for k in keys if k is not None), default="")


def _largest(files: fs.FileSystem, path: str) -> str | None:
    """A file's largest key, from its footer, or from the key column if the footer does not say."""
    with files.open_input_file(path) as f:
        pf = parquet.ParquetFile(f)
        at = pf.schema_arrow.get_field_index("row_key")
        stats = [pf.metadata.row_group(g).column(at).statistics for g in range(pf.num_row_groups)]
        if all(s is not None and s.has_min_max for s in stats):
            return max((s.max for s in stats), default=None)
        tops = [pc.max(b.column(0)).as_py() for b in pf.iter_batches(columns=["row_key"])]
        return max((t for t in tops if t is not None), default=None)


def poll_cells(spark: SparkSession, root: str, after: str = "") -> DataFrame:
    """The stream of cells; ``batch`` is the upsert they come from (see ``polled_rows``)."""
    here = sys.modules[__name__]
    cloudpickle.register_pickle_by_value(here)
    try:
        spark.dataSource.register(PolledCells)
    finally:
        cloudpickle.unregister_pickle_by_value(here)
    return spark.readStream.format(PolledCells.name()).option("root", root).option("after", after).load()


def polled_rows(cells: DataFrame) -> DataFrame:
    """One poll's cells as typed rows: per cell the put of the newest batch."""
    newest = F.max(F.struct("batch", "version", "value")).alias("_w")
    put = cells.groupBy(*wide.CELL_KEY_COLS).agg(newest)
    return wide.mapped_view(put.select(*wide.CELL_KEY_COLS, F.col("_w.value").alias("value"), F.col("_w.version").alias("version")))


def poll_sink(out: str):
    """foreachBatch body: the rows of each poll in a folder of its own, so a repeated poll replaces what it left."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        polled_rows(batch).write.mode("overwrite").parquet(f"{out}/poll={batch_id}")
    return sink
