import hashlib
import re

import duckdb

from pumpline.llm import op8_mix as M
from pumpline.llm.common import table
from tests.llm.conftest import SF


def brute_targets(sizes, weights=(5, 2, 1)):
    """Share by weight, cap at three times the size, share the excess again until nothing is above."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: float(weights[i % 3]) for i, s in enumerate(names)}
    out, free, total = {}, set(names), float(sum(sizes.values()))
    while free:
        left = total - sum(out.values())
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return {**out, **share}
        out.update({s: 3.0 * sizes[s] for s in over})
        free -= over
    return out


def brute(rows):
    d = [(i, s, hashlib.md5(("" if i is None else str(i)).encode()).hexdigest(), len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t, s in rows]
    sizes = {}
    for _, s, _, n in d:
        sizes[s] = sizes.get(s, 0) + n
    goal = brute_targets(sizes)
    out = []
    for s in sizes:
        words = int(goal[s] + 0.5)
        epochs = words // sizes[s] if sizes[s] else 0
        rest = words - epochs * sizes[s]
        for i, _, _, n in sorted((x for x in d if x[1] == s), key=lambda x: (x[2], x[3])):
            out.append((i, n, sizes[s], round(goal[s], 6), epochs * n + max(0, min(n, rest))))
            rest -= n
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in df.collect()), key=repr)


def test_digest_is_brute_force_and_sql(spark):
    docs = table(spark, SF, "documents")
    got = rows_of(M.digest(spark, docs))
    assert got == brute([(r.doc_id, r.text, r.source) for r in docs.collect()])
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    rel = con.sql(M.ORACLE)
    assert sorted(((a, b, c, round(d, 6), e) for a, b, c, d, e in rel.fetchall()), key=repr) == got


def test_taken_words_equal_the_target_and_no_document_exceeds_three_times_its_size(spark):
    got = M.digest(spark, table(spark, SF, "documents")).collect()
    by = {}
    for r in got:
        assert 0 <= r.taken <= 3 * r["size"]
        by.setdefault((r.source_size, r.target), []).append(r.taken)
    assert all(abs(sum(v) - t) <= 0.5 for (_, t), v in by.items())


def test_caps_are_shared_again(spark, frame):
    rows = [(i, "w " * n, None, s, 0) for i, (s, n) in enumerate([("a", 1), ("b", 100), ("c", 1000), ("d", 3), (None, 50), ("ä", 7)])]
    got = rows_of(M.digest(spark, frame(rows)))
    assert got == brute([(r[0], r[1], r[3]) for r in rows])
    assert any(t == 3 * s for _, _, s, t, _ in got)


def test_odd_rows(spark, odd_docs):
    got = rows_of(M.digest(spark, odd_docs))
    assert got == brute([(r.doc_id, r.text, r.source) for r in odd_docs.collect()])
    assert got == rows_of(M.digest(spark, odd_docs.repartition(3)))  # reruns and other layouts agree
    assert M.digest(spark, odd_docs.limit(0)).count() == 0
    wordless = odd_docs.where("doc_id < 4")
    assert [(r["size"], r.taken) for r in M.digest(spark, wordless).collect()] == [(0, 0)] * 3
    mixed = M.mixed_documents(spark, odd_docs)
    assert mixed.columns == [*odd_docs.columns, "mix_size", "mix_source_size", "mix_target", "mix_taken"]
    assert sum(r.mix_taken for r in mixed.collect()) == sum(r[4] for r in got)


def test_no_python_in_the_plan(spark):
    plan = M.digest(spark, table(spark, SF, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
