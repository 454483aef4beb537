import corpus_pipeline
from pumpline.llm import op2_langid, op5_simhash, op7_secrets, op9_decontaminate
from pumpline.llm.common import table
from tests.llm.conftest import SF
from tests.llm.test_mix import brute as brute_mix
from tests.llm.test_simhash import brute_components, brute_fingerprint


def test_stages_follow_brute_force(spark):
    docs = table(spark, SF, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    d = docs
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in d.collect()}
        d = stage(spark, d, SF)
        after = {r.doc_id: r for r in d.collect()}
        if name != "mixing":
            assert d.columns == docs.columns
        if name == "language_id":
            assert set(after) == {i for i, r in before.items() if any(c.isalpha() for c in r.text or "")}
        elif name == "near_dedup":
            comp = brute_components(list(before), [brute_fingerprint(before[i].text) for i in before])
            assert set(after) == {i for i in before if comp[i] == i}
        elif name == "decontaminate":
            items = [r.text for r in table(spark, SF, "benchmark").collect()]
            assert set(after) == {i for i, r in before.items() if not any(t in r.text for t in items)}
        elif name == "secrets":
            assert set(after) == set(before)
            changed = {i for i in after if after[i].text != before[i].text}
            assert all(op7_secrets.MARK in after[i].text for i in changed)
        else:
            want = {i: t for i, _, _, _, t in brute_mix([(i, r.text, r.source) for i, r in before.items()]) if t}
            assert {i: r.mix_taken for i, r in after.items()} == want
    final = {r.doc_id: (r.text, r.mix_taken) for r in corpus_pipeline.run(spark, SF).collect()}
    assert final == {i: (r.text, r.mix_taken) for i, r in after.items()} and set(final) <= set(rows)


def test_odd_rows_through_all_stages(spark, odd_docs):
    for docs in (odd_docs, odd_docs.limit(0)):
        d = docs
        for name, stage in corpus_pipeline.STAGES:
            d = stage(spark, d, SF)
            if name != "mixing":
                assert d.columns == docs.columns
            d.count()


def test_stage_functions_call_the_operators():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontaminate", "secrets", "mixing"]
    assert corpus_pipeline.keep_identified is op2_langid.keep_identified and corpus_pipeline.drop_near_copies is op5_simhash.drop_near_copies
    assert corpus_pipeline.drop_contaminated is op9_decontaminate.drop_contaminated
