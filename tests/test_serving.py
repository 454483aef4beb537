"""Outside store, incremental view, capped queue."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pumpline.config import DEFAULT_PARAMS as D
from pumpline.operators import monitor
from pumpline.plans import sequencing as Q
from pumpline.session import work_path
from pumpline.sources import external, wide
from pumpline.streaming import pipelines as S

CELL = wide.CELL_SCHEMA
T0 = datetime(2024, 1, 1)


def _parts(root):
    base = root.removeprefix("file:")
    return {p: sorted(f for f in os.listdir(f"{base}/parts/{p}") if f.startswith("chunk")) for p in os.listdir(f"{base}/parts")}


def test_calls_hold_at_most_the_chunk(spark):
    root = work_path(spark, "t_puts")
    external.put_rows(spark.range(0, 2500, 1, 2).select(F.col("id").cast("string").alias("row_key")), 1000, root=root)
    sizes = []
    for p, files in _parts(root).items():
        sizes.append([sum(1 for _ in open(f"{root.removeprefix('file:')}/parts/{p}/{f}")) for f in files])
    assert sorted(sizes) == [[1000, 250], [1000, 250]]
    published = os.listdir(f"{root.removeprefix('file:')}/published")
    assert len([f for f in published if f.endswith(".json") and not f.startswith(".")]) == 1


def test_a_failed_task_leaves_nothing(spark):
    root = work_path(spark, "t_puts_fail")
    bad = spark.range(0, 3000, 1, 3).select(F.when(F.col("id") == 2999, F.raise_error(F.lit("broken row"))).otherwise(F.col("id").cast("string")).alias("row_key"))
    with pytest.raises(Exception, match="broken row|Python"):
        external.put_rows(bad, 100, root=root)
    base = root.removeprefix("file:")
    assert not os.path.exists(f"{base}/published")
    assert all(not f for f in _parts(root).values())
    external.put_cells(spark.createDataFrame([("2024-01-01 00:00:00.000000", "wave", "s04", v, n) for n, v in ((1, "1"), (2, "2"))], CELL), root)
    assert [tuple(r) for r in external.stored_cells(spark, root).collect()] == [("2024-01-01 00:00:00.000000", "wave", "s04", "2")]


def test_nothing_to_put(spark):
    root = work_path(spark, "t_puts_none")
    external.put_cells(spark.createDataFrame([], CELL), root)
    assert external.stored_cells(spark, root).count() == 0


def _put(spark, *rows):
    """(day, hour, family:qualifier, value, version)"""
    return spark.createDataFrame([(f"2024-01-{d:02d} {h:02d}:00:00.000000", *n.split(":"), v, k) for d, h, n, v, k in rows], CELL)


def test_view_follows_overwrites_replays_and_cuts(spark, monkeypatch):
    table, view = work_path(spark, "t_view_table"), work_path(spark, "t_view")
    batches = [
        [(1, 0, "status:pred", "0.0", 1), (1, 1, "status:pred", "1.0", 2), (2, 0, "wave:s04", "5", 3), (1, 0, "status:pred", "1.0", 4)],
        [(1, 0, "status:pred", "0.5", 5), (2, 0, "status:pred", "0.0", 6), (1, 1, "wave:s10", "2", 7), (3, 0, "status:pred", "bad", 8)],
        [(1, 1, "status:pred", "0.0", 0), (3, 0, "status:pred", "1.0", 9), (3, 1, "status:real", "x", 10)]]
    sink = S.view_sink(table, view, lambda df: df, compact_every=2)
    for i, rows in enumerate(batches):
        if i == 1:  # the run dies after the change is written and before the table has the batch
            real = wide.upsert_cells
            monkeypatch.setattr(wide, "upsert_cells", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("cut")))
            with pytest.raises(RuntimeError, match="cut"):
                sink(_put(spark, *rows), i)
            assert S.read_view(spark, table, view).first()["total"] == 3  # an uncommitted change does not count
            monkeypatch.setattr(wide, "upsert_cells", real)
        sink(_put(spark, *rows), i)
        sink(_put(spark, *rows), i)  # a replay
        got, want = S.read_view(spark, table, view).first(), S.batch_view(spark, table).first()
        assert got.asDict() == want.asDict()


def test_change_reads_only_the_dates_it_touches(spark):
    table = work_path(spark, "t_view_dates")
    wide.upsert_cells(spark, table, _put(spark, *[(d, 0, "status:pred", "0.0", d) for d in range(1, 29)]), 1)
    change = S.view_change(spark, table, _put(spark, (7, 0, "status:pred", "1.0", 99)))
    plan = change._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "dt#" in plan and "2024-01-07" in plan and "2024-01-08" not in plan
    assert change.first().asDict() == {"normal": -1, "anomaly": 1, "unknown": 0, "total": 0}


def _sequential(times, cap, tick_us):
    """Handled tick of each event by playing the consumer tick by tick."""
    order, i = sorted(times), 0
    arrived = [t // tick_us for t in order]
    tick = arrived[0] if arrived else 0
    handled, waiting = [], 0
    while len(handled) < len(order):
        while i < len(order) and arrived[i] <= tick:
            i, waiting = i + 1, waiting + 1
        take = min(cap, waiting)
        handled += [tick] * take
        waiting -= take
        tick += 1
    return handled


@pytest.mark.parametrize("by", [("device_id",), ()])
def test_capped_queue_is_the_sequential_one(spark, by):
    r = random.Random(6)
    p = D.with_(tick_ms=1000, drain_cap=3, bucket_s=5)
    rows = [(d, i, T0 + timedelta(milliseconds=r.randrange(60_000) // (1 + i % 7))) for i, d in enumerate([1] * 250 + [2] * 30 + [None] * 40)]
    df = spark.createDataFrame(rows, "device_id long, event_id long, ts timestamp_ntz")
    got = monitor.drain_ticks(df, p, by).collect()
    us = lambda t: int((t - datetime(1970, 1, 1)).total_seconds() * 1_000_000 + 0.5)
    for key in ({r[0] for r in rows} if by else {"all"}):
        own = sorted((x for x in got if not by or x.device_id == key), key=lambda x: (x.ts, x.event_id))
        assert [x.tick_handled for x in own] == _sequential([us(x.ts) for x in own], 3, 1_000_000)
        assert all(x.queued == x.tick_handled - x.tick_arrived >= 0 for x in own) and any(x.queued for x in own)


def test_running_max_across_buckets(spark):
    rows = [(i % 2, i, T0 + timedelta(seconds=i * 7), float((i * 37) % 101)) for i in range(100)]
    df = spark.createDataFrame(rows, "device_id long, event_id long, ts timestamp_ntz, v double")
    got = {r.event_id: r.m for r in Q.running_max(df, ["device_id"], ["ts", "event_id"], "ts", 60, F.col("v"), "m").collect()}
    best = {}
    for dev, i, _, v in rows:
        best[dev] = max(best.get(dev, v), v)
        assert got[i] == best[dev]
