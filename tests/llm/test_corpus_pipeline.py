import corpus_pipeline as C
from conftest import SF_SMALL

from llm_helpers import odd
from tripstar.llm import decontaminate, quality, secrets, simhash
from tripstar.llm.common import materialise


def test_stages_do_what_their_operators_decide(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert [n for n, _ in C.STAGES] == ["quality_rules", "simhash_near_dedup", "benchmark_decontamination", "secret_scans", "packing"]
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    after = {}
    current = docs
    for name, stage in C.STAGES:
        before, current = current, materialise(stage(spark, current, SF_SMALL), name)
        after[name] = current
        if name == "quality_rules":
            want = {r.doc_id for r in quality.quality_rules(before, labels).filter("kept").collect()}
        elif name == "simhash_near_dedup":
            want = {r.doc_id for r in simhash.near_duplicates(before).collect() if r.doc_id == r.component_id}
        elif name == "benchmark_decontamination":
            leaks = decontaminate.find_leaks(before, spark.read.parquet(f"{SF_SMALL}/benchmark.parquet"))
            want = {r.doc_id for r in before.collect()} - {r.doc_id for r in leaks.collect()}
        elif name == "secret_scans":
            want = {r.doc_id for r in before.collect()}
            assert all(not secrets.base_spans(r.text.encode(), r.text) for r in current.collect())
        if name != "packing":
            assert current.columns == docs.columns
            assert sorted(r.doc_id for r in current.collect()) == sorted(want)
    pieces = current.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in after["secret_scans"].collect()}
    assert all(r["sum(length)"] == r["max(doc_tokens)"] for r in pieces)
    assert C.run(spark, SF_SMALL).count() == current.count()


def test_stages_take_odd_and_empty_tables(spark):
    for docs in (odd.odd_docs(spark), odd.no_docs(spark)):
        for name, stage in C.STAGES[:-1]:
            docs = materialise(stage(spark, docs, SF_SMALL), f"odd-{name}")
        assert C.STAGES[-1][1](spark, docs, SF_SMALL).count() == 0 or docs.count() > 0
