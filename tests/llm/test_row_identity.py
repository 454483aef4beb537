"""Rows keep their identity when a table's scan is split differently from one job to the next."""

import pytest

from pumpline.llm import common, op5_simhash, op7_secrets
from pumpline.llm.common import table
from tests.llm.conftest import SF

HEX = "0123456789abcdef0123456789"


@pytest.fixture
def many_files(spark, tmp_path):
    docs = table(spark, SF, "documents")
    own = spark.createDataFrame([(10_000 + i, f"my password = {HEX}{i:02x} here", "en", f"s{i % 4}", 30) for i in range(40)], docs.schema)
    docs.unionByName(own).repartition(12).write.parquet(f"{tmp_path}/docs")
    return spark.read.parquet(f"{tmp_path}/docs")


def results(spark, df):
    return (sorted(r.doc_id for r in op5_simhash.drop_near_copies(spark, df).collect()),
            sorted((r.doc_id, r.text) for r in op7_secrets.redact_live(spark, df).collect()),
            sorted(tuple(r) for r in op7_secrets.digest(spark, df).collect()))


def test_changing_splits(spark, many_files, monkeypatch):
    want = results(spark, many_files)
    assert sum(op7_secrets.MARK in t for _, t in want[1]) >= 40
    plain, n = common.save, [0]

    def save(s, df, name):
        out = plain(s, df, name)
        n[0] += 1
        s.conf.set("spark.sql.leafNodeDefaultParallelism", [1, 12, 5][n[0] % 3])
        s.conf.set("spark.sql.files.minPartitionNum", [1, 12, 5][n[0] % 3])
        return out

    for module in (common, op5_simhash, op7_secrets):
        monkeypatch.setattr(module, "save", save)
    try:
        for _ in range(2):
            assert results(spark, many_files) == want
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
        spark.conf.unset("spark.sql.files.minPartitionNum")


def test_one_owner_with_many_repositories_shows_examples(spark, frame):
    """Distinct repositories decide where all rows have one owner (or none)."""
    for owner in ("s", None):
        rows = [(i, f"see token = {HEX}aa here", f"l{i % 5}", owner, 0) for i in range(20)] + [(50, f"my token = {HEX}bb", "en", owner, 0)]
        got = {r.doc_id: (r.n_live, r.n_shared) for r in op7_secrets.digest(spark, frame(rows)).collect()}
        assert got[0] == (0, 2) and got[50] == (2, 0)
