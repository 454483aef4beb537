"""Write PLANS.md: per catalogue query, the shuffles, joins, windows and scan
pushdown of its physical plan (AQE initial plan, sf0.001 tables).

usage: python scripts/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pumpline.session import build_session  # noqa: E402

STRIP = re.compile(r"#\d+L?")


def clean(s: str) -> str:
    return STRIP.sub("", s)


def summarize(plan: str) -> dict:
    ex = Counter()
    for m in re.finditer(r"Exchange (hashpartitioning\(([^)]*)\)|rangepartitioning\(([^)]*)\)|SinglePartition|RoundRobinPartitioning\(\d+\))", plan):
        if m.group(2) is not None:
            ex["hash(" + ", ".join(k.strip() for k in clean(m.group(2)).split(",")[:-1]) + ")"] += 1
        elif m.group(3) is not None:
            ex["range(" + ", ".join(k.split(" ")[0] for k in clean(m.group(3)).split(",")[:-1]) + ")"] += 1
        else:
            ex[clean(m.group(1)).split("(")[0]] += 1
    joins = Counter(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)", plan))
    wins = Counter()
    for ln in plan.splitlines():
        m = re.search(r"windowspecdefinition\(([^)]*?)(, specifiedwindowframe|\) AS)", ln)
        if "Window [" in ln and m:
            parts = [p.strip() for p in clean(m.group(1)).split(",")]
            keys = [p for p in parts if not re.search(r" (ASC|DESC)", p)]
            wins["[" + ", ".join(keys) + "]"] += 1
    pushed = sorted({clean(m.group(1)) for m in re.finditer(r"PushedFilters: \[(.*?)\](?:, ReadSchema|$)", plan, re.M)
                     if m.group(1)})
    limits = Counter(re.findall(r"(WindowGroupLimit|TakeOrderedAndProject|CollectLimit)", plan))
    return {"ex": ex, "joins": joins, "wins": wins, "pushed": pushed, "limits": limits}


def fmt(c: Counter) -> str:
    return "; ".join(f"{k} ×{v}" if v > 1 else k for k, v in sorted(c.items())) or "–"


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    from pyspark.sql.readwriter import DataFrameWriter

    from pumpline.plans.catalog import QUERIES

    spark = build_session("local[4]")
    print("# PLANS — physical plan summary per batch query\n")
    print("Generated by `scripts/plan_report.py` from each query's physical plans (initial AQE plans,")
    print("sf0.001 tables): the returned frame's, and those of the tables it writes on the way (rows")
    print("marked with their number).  Broadcast joins in this column may be sort-merge joins at")
    print("scale: the choice is made at run time by AQE from actual sizes.  `_pl_key` is the struct of")
    print("keys and bucket of `plans/sequencing.py`, `_pl_bkt` the bucket.\n")
    print("| query | scans | shuffles (partitioning) | joins | window partition keys | top-N | pushed filters |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    written: list[str] = []
    for method in ("parquet", "csv", "text", "save"):
        def wrapped(self, *args, _was=getattr(DataFrameWriter, method), **kw):
            written.append(plan(self._df))
            return _was(self, *args, **kw)
        setattr(DataFrameWriter, method, wrapped)
    for name, query in sorted(QUERIES.items()):
        written.clear()
        last = plan(query(spark, sf))
        for k, text in enumerate([last, *written]):
            s = summarize(text)
            label = f"`{name}`" if not k else f"— written {k}"
            print(f"| {label} | {text.count('FileScan')} | {fmt(s['ex'])} | {fmt(s['joins'])} | {fmt(s['wins'])} | {fmt(s['limits'])} | "
                  f"{'; '.join(s['pushed'])[:200].replace('|', '/') or '–'} |")


if __name__ == "__main__":
    main()
