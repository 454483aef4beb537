"""Text in a folder for each key, written without Spark's own writer on a local file system."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from pumpline.operators import eventlog
from pumpline.session import work_path
from pumpline.sources import folders


def _own(spark, name):
    """A path alone in its folder."""
    return f"{work_path(spark, name).replace('file:', '')}/export"


def _text(path):
    return b"".join(open(f, "rb").read() for f in sorted(glob.glob(f"{path}/part-*")))


def _processes():
    return next(int(ln.split()[1]) for ln in open("/proc/stat") if ln.startswith("processes "))


def test_export_starts_no_process_for_a_folder(spark):
    n = 3000
    lines = spark.range(n).select(F.col("id").alias("device_id"), F.lit(1).cast("long").alias("line_no"), F.lit("x").alias("line"))
    eventlog.write_export(lines.limit(10), work_path(spark, "tf_warm"))
    path, before = work_path(spark, "tf_many"), _processes()
    eventlog.write_export(lines, path)
    assert _processes() - before < n
    assert spark.read.text(path).select("device_id").distinct().count() == n


def test_folders_files_and_lines_are_those_of_sparks_writer(spark):
    keys = ["a", "", None, "x/y", "a b", "50%", "k=v", "q?#*", "{z}", "[1]^", "c:\\d", "'\"", "泵", "1\n2", "..", "%2F"]
    rows = [(k, n, t) for k in keys for n, t in ((1, "first"), (2, None), (3, ""), (4, "日志 " * 500), (5, "two\nlines"))]
    df = spark.createDataFrame(rows, "k string, n int, line string").repartition(1).sortWithinPartitions("k", "n")
    ours, theirs = _own(spark, "tf_names"), _own(spark, "tf_names_spark")
    folders.write_text_folders(df, "k", "line", ours)
    (df.withColumn("k", F.when(F.col("k") != "", F.col("k"))).repartition(1).sortWithinPartitions("k", "n")
       .select("k", "line").write.partitionBy("k").text(theirs))
    assert sorted(os.listdir(ours)) == sorted(os.listdir(theirs))
    own = [f for f in os.listdir(ours) if f.startswith("k=") and f != f"k={folders.NO_VALUE}"]
    assert len(own) == len(keys) - 2
    for f in own:
        assert _text(f"{ours}/{f}") == _text(f"{theirs}/{f}")
        for sums in (glob.glob(f"{p}/{f}/.part-*.crc") for p in (ours, theirs)):
            assert len(sums) == 1
        assert open(glob.glob(f"{ours}/{f}/.part-*.crc")[0], "rb").read() == open(glob.glob(f"{theirs}/{f}/.part-*.crc")[0], "rb").read()
    assert sorted(_text(f"{ours}/k={folders.NO_VALUE}").split(b"\n")) == sorted(_text(f"{theirs}/k={folders.NO_VALUE}").split(b"\n"))


def test_a_key_over_several_tasks_keeps_its_order(spark):
    df = spark.range(1000).select(F.lit(7).alias("device_id"), (F.col("id") + 1).alias("line_no"), F.col("id").cast("string").alias("line"))
    path = _own(spark, "tf_split")
    folders.write_text_folders(df.repartitionByRange(4, "device_id", "line_no").sortWithinPartitions("device_id", "line_no"), "device_id", "line", path)
    assert len(glob.glob(f"{path}/device_id=7/part-*")) == 4
    assert _text(f"{path}/device_id=7").decode().split() == [str(i) for i in range(1000)]
    assert sorted(os.listdir(os.path.dirname(path))) == ["export"]
    assert {"_SUCCESS", "device_id=7"} < set(os.listdir(path))


def test_damaged_text_is_noticed(spark):
    path = _own(spark, "tf_damage")
    folders.write_text_folders(spark.createDataFrame([(1, "x" * 2000)], "device_id long, line string"), "device_id", "line", path)
    assert spark.read.text(path).count() == 1
    with open(glob.glob(f"{path}/device_id=1/part-*")[0], "r+b") as f:
        f.seek(1000)
        f.write(b"y")
    with pytest.raises(Exception, match="(?i)checksum"):
        spark.read.text(path).collect()


def test_failed_write_keeps_what_was_there(spark):
    path = _own(spark, "tf_fail")
    good = spark.range(5).select(F.col("id").alias("device_id"), F.lit("old").alias("line"))
    folders.write_text_folders(good, "device_id", "line", path)
    bad = spark.range(0, 50, 1, 4).select(F.col("id").alias("device_id"), F.when(F.col("id") == 49, F.raise_error(F.lit("no line"))).otherwise(F.lit("new")).alias("line"))
    with pytest.raises(Exception, match="no line"):
        folders.write_text_folders(bad, "device_id", "line", path)
    assert sorted(r[0] for r in spark.read.text(path).collect()) == ["old"] * 5
    assert os.listdir(os.path.dirname(path)) == ["export"]
    folders.write_text_folders(good.filter("device_id < 2").withColumn("line", F.lit("new")), "device_id", "line", path)
    assert sorted((r.device_id, r.value) for r in spark.read.text(path).collect()) == [(0, "new"), (1, "new")]


def test_other_file_systems_take_sparks_writer(spark, monkeypatch):
    path = _own(spark, "tf_other")
    monkeypatch.setattr(folders, "local_path", lambda *_: None)
    folders.write_text_folders(spark.createDataFrame([(1, "x"), (2, "y")], "device_id long, line string"), "device_id", "line", path)
    assert sorted((r.device_id, r.value) for r in spark.read.text(path).collect()) == [(1, "x"), (2, "y")]


def test_folders_are_read_with_their_keys(spark):
    keys = ["a", None, "x/y", "a b", "a+b", "50%", "k=v", "q?#*", "{z}", "[1]^", "泵", "1\n2", "..", "%2F", "-7"]
    path = _own(spark, "tf_read")
    rows = [(k, f"{n} {i}") for n, k in enumerate(keys) for i in range(3)]
    folders.write_text_folders(spark.createDataFrame(rows, "k string, line string").repartition(1).sortWithinPartitions("k"), "k", "line", path)
    assert sorted(map(repr, folders.read_text_folders(spark, path, "k").collect())) == sorted(f"Row(k={k!r}, value={v!r})" for k, v in rows)
    folders.write_text_folders(spark.createDataFrame([], "k string, line string"), "k", "line", path)
    assert folders.read_text_folders(spark, path, "k").collect() == []


def test_export_is_read_without_partition_discovery(spark):
    """Discovery looks up each folder in a linked list of all folders."""
    from pumpline.plans import catalog
    from tests.conftest import SF_SMALL

    df = catalog.q_log_export_files(spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" in plan and "_metadata" in df._jdf.queryExecution().analyzed().toString()
    relation = df._jdf.queryExecution().optimizedPlan().collectLeaves().head().relation()
    assert relation.partitionSchema().isEmpty()
    assert df.count() > 0 and df.filter("device_id IS NULL OR line IS NULL").count() == 0
