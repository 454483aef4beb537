"""Text files in one folder for each key.

Spark's own writer opens each file through Hadoop.  On a local (or mounted) file system
without Hadoop's native library that starts three processes for a folder: ``chmod`` for the
folder, for the file and for its checksums.  With a short file in each of many folders they
take nearly all of the time.  ``FolderText`` is a Spark data source for that case: its tasks
write the same folders, files and checksum files directly.  Elsewhere Spark's writer is used.

Each task writes below a folder of its own.  When all have succeeded, the driver joins
their folders and puts the result in place by one rename; a failed, lost or repeated task leaves
nothing in it, and after a failed job what was there before is untouched.
"""

from __future__ import annotations

import os
import re
import shutil
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from pumpline.session import ship_package

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
ESCAPED = re.compile(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""")


def folder_name(key: str, value: str | None) -> str:
    """Folder of a key's value, as Spark names it."""
    return f"{key}={ESCAPED.sub(lambda m: f'%{ord(m[0]):02X}', value) if value else NO_VALUE}"


def local_path(spark: SparkSession, path: str) -> str | None:
    """``path`` in the local file system, None if it is in another one."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toUri()
    return os.path.realpath(uri.getPath()) if uri.getScheme() == "file" else None


class CheckedFile:
    """A file and, beside it, the checksums by which Hadoop's local file system checks it when read."""

    CHUNK = 512

    def __init__(self, folder: str, name: str):
        self.data, self.sums, self.rest = open(f"{folder}/{name}", "xb"), open(f"{folder}/.{name}.crc", "xb"), b""
        self.sums.write(b"crc\0" + struct.pack(">i", self.CHUNK))

    def write(self, data: bytes) -> None:
        self.data.write(data)
        data = self.rest + data
        whole = len(data) - len(data) % self.CHUNK
        self.sums.write(b"".join(self._sum(data[i:i + self.CHUNK]) for i in range(0, whole, self.CHUNK)))
        self.rest = data[whole:]

    def close(self) -> None:
        if self.rest:
            self.sums.write(self._sum(self.rest))
        self.data.close()
        self.sums.close()

    @staticmethod
    def _sum(chunk: bytes) -> bytes:
        return struct.pack(">I", zlib.crc32(chunk))


@dataclass
class Written(WriterCommitMessage):
    folder: str


class FolderText(DataSource):
    """Options: ``stage`` (an existing local folder), ``run`` (ends the files' names) and ``key``.  Rows
    are (value of the key as text, line in bytes), those of one key in succession."""

    @classmethod
    def name(cls) -> str:
        return "pumpline_folders"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return FolderWriter(dict(self.options))


class FolderWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.stage, self.run, self.key = options["stage"], options["run"], options["key"]

    def write(self, batches: Iterator) -> Written:
        name, own = f"part-{TaskContext.get().partitionId():05d}-{self.run}.c000.txt", f"{self.stage}/{uuid.uuid4().hex}"
        os.mkdir(own)
        folder, file = None, None
        try:
            for b in batches:
                rows = zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)
                for value, lines in groupby(rows, lambda r: r[0] or None):
                    if file is None or folder != folder_name(self.key, value):
                        if file:
                            file.close()
                        folder = folder_name(self.key, value)
                        os.mkdir(f"{own}/{folder}")
                        file = CheckedFile(f"{own}/{folder}", name)
                    file.write(b"".join(part for _, line in lines for part in (line or b"", b"\n")))
        finally:
            if file:
                file.close()
        return Written(own)

    def commit(self, messages: list[Written | None]) -> None:
        out = f"{self.stage}/out"
        os.mkdir(out)
        for m in messages:
            for folder in os.listdir(m.folder) if m else ():
                try:
                    os.rename(f"{m.folder}/{folder}", f"{out}/{folder}")
                except OSError:  # a key over several tasks: the folder is there already
                    for name in os.listdir(f"{m.folder}/{folder}"):
                        os.rename(f"{m.folder}/{folder}/{name}", f"{out}/{folder}/{name}")
        CheckedFile(out, "_SUCCESS").close()

    def abort(self, messages: list[Written | None]) -> None:
        pass  # the stage goes with the call that made it


def write_text_folders(df: DataFrame, key: str, line: str, path: str) -> None:
    """Write the text ``line`` of each row into a folder for each ``key``, replacing what is in ``path``.

    Within a partition the rows of a key must follow each other; they are written in their order.
    """
    spark, local = df.sparkSession, local_path(df.sparkSession, path)
    if local is None:
        df.select(key, line).write.mode("overwrite").partitionBy(key).text(path)
        return
    ship_package(spark)
    spark.dataSource.register(FolderText)
    run = str(uuid.uuid4())
    stage = f"{os.path.dirname(local)}/_{os.path.basename(local)}-{run}"
    os.makedirs(stage)
    try:
        (df.select(F.col(key).cast("string").alias("value"), F.col(line).cast("binary").alias("line"))
           .write.format(FolderText.name()).mode("overwrite").options(stage=stage, run=run, key=key).save())
        _remove(local)
        os.rename(f"{stage}/out", local)
    finally:
        _remove(stage)


def read_text_folders(spark: SparkSession, path: str, key: str) -> DataFrame:
    """(``key`` as text, value) of each line of the folders.

    The key is read from the file's path.  Spark's partition discovery would look up each folder
    in a linked list of all of them: its time on the driver grows with the square of their number.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(path).select("value", F.col("_metadata.file_path").alias("file"))
    name = F.regexp_extract("file", f"/{key}=([^/]*)/[^/]*$", 1)
    plain = lambda c: F.url_decode(F.regexp_replace(c, r"\+", "%2B"))
    # escaped once in the folder's name and once in the address of the file
    return lines.select(F.when(name != NO_VALUE, plain(plain(name))).alias(key), "value")


def _remove(folder: str) -> None:
    """Remove a folder; a task that outlives its job no longer finds it and ends."""
    if os.path.lexists(folder):
        gone = f"{os.path.dirname(folder)}/_{uuid.uuid4().hex}"
        os.rename(folder, gone)
        shutil.rmtree(gone)
