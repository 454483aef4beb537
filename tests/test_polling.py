"""Polling by row key, the supervisor, bucketed joins, training parts."""

import pytest
from pyspark.sql import functions as F

from pumpline.config import DEFAULT_PARAMS as D
from pumpline.operators import ml, monitor
from pumpline.session import work_path
from pumpline.sources import files, polling, wide
from pumpline.streaming import supervisor


def _put(spark, *rows):
    return spark.createDataFrame([(k, *n.split(":"), v, i) for k, n, v, i in rows], wide.CELL_SCHEMA)


def _poll(spark, table, out, ck):
    (polling.poll_cells(spark, table).writeStream.foreachBatch(polling.poll_sink(out)).option("checkpointLocation", ck)
     .trigger(availableNow=True).start().awaitTermination())
    return sorted((r.row_key, r.s04, r.s10, r.pred) for r in spark.read.parquet(out).collect())


def test_poll_goes_on_behind_the_last_key(spark):
    table, out, ck = work_path(spark, "tp_table"), work_path(spark, "tp_out"), work_path(spark, "tp_ck")
    a, b, c = "2024-01-01 00:00:00.000000", "2024-01-01 00:00:00.000001", "2024-02-01 00:00:00.000000"
    wide.upsert_cells(spark, table, _put(spark, (a, "wave:s04", "1", 1), (a, "status:pred", "bad", 1), (None, "wave:s04", "7", 1)), 1)
    assert _poll(spark, table, out, ck) == [(a, 1.0, None, None)]
    assert len(_poll(spark, table, out, ck)) == 1  # the same key again: nothing
    # a late key, an overwrite of a polled one, and new ones put twice
    wide.upsert_cells(spark, table, _put(spark, ("2023-12-31 00:00:00.000000", "wave:s04", "5", 2), (a, "wave:s04", "6", 2), (b, "wave:s04", "2", 2)), 2)
    wide.upsert_cells(spark, table, _put(spark, (b, "wave:s04", "3", 0), (c, "wave:s10", "4", 3)), 3)
    assert _poll(spark, table, out, ck) == [(a, 1.0, None, None), (b, 3.0, None, None), (c, None, 4.0, None)]
    wide.compact_cells(spark, table)
    assert len(_poll(spark, table, out, ck)) == 3


def test_poll_of_a_table_that_is_not_there_yet(spark):
    table, out, ck = work_path(spark, "tn_table"), work_path(spark, "tn_out"), work_path(spark, "tn_ck")
    q = (polling.poll_cells(spark, table).writeStream.foreachBatch(polling.poll_sink(out)).option("checkpointLocation", ck)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert q.exception() is None
    wide.upsert_cells(spark, table, _put(spark, ("2024-01-01 00:00:00.000000", "wave:s04", "1", 1)), 1)
    assert len(_poll(spark, table, out, ck)) == 1


def test_supervisor_raises_after_failures_in_a_row(spark):
    src, ck, status = work_path(spark, "sv_src"), work_path(spark, "sv_ck"), work_path(spark, "sv_status")
    spark.range(3).write.parquet(src)
    tries = []

    def sink(batch, batch_id):
        tries.append(batch_id)
        raise OSError("no store")

    def start():
        return (spark.readStream.schema("id long").parquet(src).writeStream.foreachBatch(sink).option("checkpointLocation", ck)
                .trigger(availableNow=True).start())

    with pytest.raises(Exception, match="no store"):
        supervisor.supervise(start, supervisor.status_writer(spark, status, "speed"), retries=2, pause_s=0.0)
    rows = supervisor.status_rows(spark, status)
    assert len(tries) == 3 and [(r.online, r.source) for r in rows.collect()] == [(False, "speed")]
    # a later run of the same feed: its numbers go on, and its first batch is the reconnect
    supervisor.status_writer(spark, status, "speed")(True, None)
    rows = supervisor.status_rows(spark, status)  # the folder has one more file
    assert monitor.reconnect_count(rows).first()["speed_reconnects"] == 1
    assert monitor.source_status(rows).first()["online"]


def test_bucketed_tables_join_without_a_shuffle(spark):
    a = spark.range(1000).select((F.col("id") % 50).alias("device_id"), F.col("id").alias("ts"), F.lit(1).alias("x"))
    tables = []
    for name in ("left", "right"):
        at = work_path(spark, name)
        tables.append(files.write_bucketed(a, f"t_{name}_{at.rsplit('-', 1)[-1]}", at, ["device_id", "ts"], 4))
    joined = tables[0].hint("merge").join(tables[1].withColumnRenamed("x", "y"), ["device_id", "ts"])
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert joined.count() == 1000


def test_training_parts_follow_the_rows(spark):
    p = D.with_(train_partitions=2, train_rows_per_part=100)
    assert [ml.train_parts(spark.range(n), p) for n in (0, 150, 201, 1000)] == [2, 2, 3, 10]
