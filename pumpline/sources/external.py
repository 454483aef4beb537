"""Writer for an outside key/value store: rows go out in calls of bounded size and count when the whole job has ended well.

``ChunkedPuts`` is a Spark data source.  Each task opens its own connection (Spark
tasks share none), sends its rows in chunks and closes it; what it sent is only
staged under a name of its own.  When all tasks have succeeded, the driver publishes
the staged parts of those tasks in one step; a failed, lost or repeated task leaves
parts that nobody publishes, and a failed job publishes nothing.

A store is reached through a class with ``open(options, part)`` (on executors: an
object with ``put(rows)``, ``close()`` and ``undo()``), ``publish(options, parts)``
and ``discard(options, run)`` (on the driver: the parts named ``<run>-...``, also those of
tasks that were stopped and could report nothing; what they put later must go too).  ``FileStore`` keeps chunks as files
in any file system that pyarrow opens.
"""

from __future__ import annotations

import contextlib
import importlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from pumpline.config import DEFAULT_PARAMS


class FileStore:
    """Chunks as JSON lines under ``<root>/parts/<part>/``; ``<root>/published/`` names the parts that count."""

    def __init__(self, options: dict, part: str):
        self.fs, root = _files(options["root"])
        self.folder, self.sent = f"{root}/parts/{part}", 0
        self.stopped = f"{root}/stopped/{part.partition('-')[0]}"
        self.fs.create_dir(self.folder)

    @classmethod
    def open(cls, options: dict, part: str) -> FileStore:
        return cls(options, part)

    def put(self, rows: list[dict]) -> None:
        with self.fs.open_output_stream(f"{self.folder}/chunk-{self.sent:06d}.json") as f:
            f.write("".join(json.dumps(r) + "\n" for r in rows).encode())
        self.sent += 1
        # a task that outlives its failed job removes what came after ``discard``
        if self.fs.get_file_info(self.stopped).type.name != "NotFound":
            raise RuntimeError("the job has failed")

    def close(self) -> None:
        pass

    def undo(self) -> None:
        with contextlib.suppress(FileNotFoundError):  # discarded already
            self.fs.delete_dir(self.folder)

    @staticmethod
    def publish(options: dict, parts: list[str]) -> None:
        fs, root = _files(options["root"])
        fs.create_dir(f"{root}/published")
        fs.create_dir(f"{root}/parts")
        with fs.open_output_stream(f"{root}/published/{uuid.uuid4().hex}.json") as f:  # one file: all parts at once
            f.write("".join(json.dumps({"part": p}) + "\n" for p in parts).encode())

    @staticmethod
    def discard(options: dict, run: str) -> None:
        from pyarrow.fs import FileSelector

        fs, root = _files(options["root"])
        fs.create_dir(f"{root}/stopped")
        with fs.open_output_stream(f"{root}/stopped/{run}"):  # before the parts are listed
            pass
        for f in fs.get_file_info(FileSelector(f"{root}/parts", allow_not_found=True)):
            if f.base_name.startswith(f"{run}-"):
                with contextlib.suppress(FileNotFoundError):
                    fs.delete_dir(f.path)


def _files(root: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (fs.LocalFileSystem(), root)


@dataclass
class Sent(WriterCommitMessage):
    part: str
    rows: int
    calls: int


class ChunkedPuts(DataSource):
    """Options: ``store`` (``module:Class``), ``chunk`` (rows of one call) and whatever the store needs."""

    @classmethod
    def name(cls) -> str:
        return "pumpline_puts"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return ChunkedWriter(dict(self.options))


class ChunkedWriter(DataSourceWriter):
    def __init__(self, options: dict):
        self.options, self.run = options, uuid.uuid4().hex

    def _store(self):
        module, _, name = self.options["store"].partition(":")
        return getattr(importlib.import_module(module), name)

    def write(self, rows: Iterator) -> Sent:
        part, size = f"{self.run}-{uuid.uuid4().hex}", int(self.options.get("chunk", DEFAULT_PARAMS.put_rows))
        link, chunk, n, calls = self._store().open(self.options, part), [], 0, 0
        try:
            for r in rows:
                chunk.append(r.asDict(recursive=True))
                n += 1
                if len(chunk) == size:
                    link.put(chunk)
                    chunk, calls = [], calls + 1
            if chunk:
                link.put(chunk)
                calls += 1
        except BaseException:
            link.undo()
            raise
        finally:
            link.close()
        return Sent(part, n, calls)

    def commit(self, messages: list[Sent | None]) -> None:
        self._store().publish(self.options, [m.part for m in messages if m and m.rows])

    def abort(self, messages: list[Sent | None]) -> None:
        self._store().discard(self.options, self.run)


def put_rows(df: DataFrame, chunk: int = DEFAULT_PARAMS.put_rows, store: str = "pumpline.sources.external:FileStore", **options: str) -> None:
    """Send ``df`` to a store, ``chunk`` rows a call."""
    df.sparkSession.dataSource.register(ChunkedPuts)
    df.write.format(ChunkedPuts.name()).mode("append").options(store=store, chunk=str(chunk), **options).save()


def put_cells(cells: DataFrame, root: str, chunk: int = DEFAULT_PARAMS.put_rows) -> None:
    """One put per row key, with its newest cells by ``family:qualifier``."""
    newest = cells.groupBy("row_key", "family", "qualifier").agg(F.max_by("value", F.struct("version", "value")).alias("value"))
    cell = F.struct(F.concat_ws(":", "family", "qualifier").alias("column"), "value")
    put_rows(newest.groupBy("row_key").agg(F.sort_array(F.collect_list(cell)).alias("cells")), chunk, root=root)


def stored_cells(spark: SparkSession, root: str) -> DataFrame:
    """What the published parts hold: (row_key, family, qualifier, value)."""
    known = spark.read.schema("part string").json(f"{root}/published")
    rows = (spark.read.schema("row_key string, cells array<struct<column:string,value:string>>").option("recursiveFileLookup", "true").json(f"{root}/parts")
            .withColumn("part", F.regexp_extract(F.input_file_name(), r"/parts/([^/]+)/", 1)))
    each = rows.join(known, "part", "left_semi").select("row_key", F.explode("cells").alias("c"))
    name = F.split("c.column", ":", 2)
    return each.select("row_key", name[0].alias("family"), name[1].alias("qualifier"), F.col("c.value").alias("value"))
