"""Plan guards: properties of the physical plans that matter at scale.

The plans looked at are those of the returned frame and of every table that the
query writes on the way, so an operator cannot hide behind its saved result.
"""

import re

import pytest
from pyspark.sql.readwriter import DataFrameWriter

from pumpline.plans.catalog import QUERIES
from tests.conftest import SF_SMALL

SKIPPED = re.compile(r"^(Sort \[|Exchange SinglePartition|Project|Filter|Window|WindowGroupLimit|WholeStageCodegen|InputAdapter|AdaptiveSparkPlan)")


@pytest.fixture
def plans_of(spark, monkeypatch):
    def run(name):
        seen = []
        for method in ("parquet", "save", "text", "csv"):
            def wrapped(self, *args, _was=getattr(DataFrameWriter, method), **kw):
                seen.append(_plan(self._df))
                return _was(self, *args, **kw)
            monkeypatch.setattr(DataFrameWriter, method, wrapped)
        seen.append(_plan(QUERIES[name](spark, SF_SMALL)))
        return seen
    return run


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _unpartitioned(line: str) -> bool:
    """A window spec whose first element is a sort key (or the frame) has no partition key."""
    firsts = re.findall(r"windowspecdefinition\(([^,]*)", line)
    return any(f.startswith("specifiedwindowframe") or re.search(r" (ASC|DESC)( NULLS (FIRST|LAST))?\)?$", f)
               for f in firsts)


def _ops(plan: str) -> list[str]:
    return [re.sub(r"^[\s:+*()\d-]*", "", ln) for ln in plan.splitlines()]


def _over_rows(plan: str) -> list[str]:
    """Unpartitioned windows whose input is not an aggregate (a summary of a few rows)."""
    bad, ops = [], _ops(plan)
    for i, op in enumerate(ops):
        if op.startswith("Window [") and _unpartitioned(op):
            below = next((o for o in ops[i + 1:] if o and not SKIPPED.match(o)), "")
            if not re.match(r"(Hash|ObjectHash|Sort)Aggregate", below):
                bad.append(f"{op[:120]} over {below[:60]}")
    return bad


def test_guard_detects_a_window_over_rows(spark):
    from pyspark.sql import Window, functions as F
    rows = spark.range(10)
    over = rows.select("id", F.sum("id").over(Window.orderBy("id")).alias("s"))
    assert _over_rows(_plan(over))
    few = rows.groupBy((F.col("id") % 3).alias("k")).agg(F.sum("id").alias("n")).select("k", F.sum("n").over(Window.orderBy("k")).alias("s"))
    assert not _over_rows(_plan(few))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_window_over_all_rows(plans_of, name):
    for plan in plans_of(name):
        assert not _over_rows(plan), f"{name}: {_over_rows(plan)[0]}"


@pytest.mark.parametrize("name", ["waveform_last80", "waveform_last20", "log_tail"])
def test_top_n_is_cut_before_the_shuffle(plans_of, name):
    plan = plans_of(name)[-1]
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("name, most", [("event_log", 6), ("log_lines", 6), ("log_export_lines", 8), ("waveform_last80", 1), ("latest_row", 1)])
def test_scans_in_the_final_plan(plans_of, name, most):
    assert sum(op.startswith("FileScan") for op in _ops(plans_of(name)[-1])) <= most


def test_scan_pushdown_and_pruning(plans_of):
    plan = plans_of("parquet_scan_pushdown")[-1]
    assert "EqualTo(event_type,error)" in plan and "GreaterThan(value,50.0)" in plan
    assert "props" not in plan.split("ReadSchema:")[1].split("\n")[0]
