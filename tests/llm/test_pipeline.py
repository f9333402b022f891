"""The pipeline by stages, and packing, on odd and real rows."""

import itertools

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from orderlake.llm.packing import pack_documents
from orderlake.llm.quality_rules import apply_rules
from orderlake.llm.queries import LLM_QUERIES
from orderlake.llm.simhash import simhash, simhash_components

SMOKE = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_registered():
    assert [f"op{i}" for i in range(1, 14)] == sorted(
        (name.split("_")[0] for name in LLM_QUERIES), key=lambda x: int(x[2:])
    )
    assert {*LLM_QUERIES, "pipeline"} <= set(queries())
    with_sql = {"op4_license_scan", "op6_quality_rules", "op11_source_audit", "op13_hard_negatives"}
    assert with_sql <= set(oracle_sql())


def check_packing(docs, packed, capacity):
    """Pieces cover their documents, bins have no gaps and no conflicts."""
    lengths = [len((r.text or "").split()) + 1 for r in docs]
    assert sum(r.length for r in packed) == sum(lengths)
    assert sum(r.piece == 0 for r in packed) == len(docs)
    facts = {r.doc_id: r for r in docs}
    for _, group in itertools.groupby(sorted(packed, key=lambda r: (r.bin_id, r.bin_offset)), lambda r: r.bin_id):
        pieces, at = list(group), 0
        for piece in pieces:
            assert piece.bin_offset == at
            at += piece.length
        assert at <= capacity
        sources = [s for s in (facts[p.doc_id].source for p in pieces) if s is not None]
        texts = [" ".join((facts[p.doc_id].text or "").lower().split()) for p in pieces]
        assert len(sources) == len(set(sources)) and len(texts) == len(set(texts))


def test_packing_of_real_rows(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet").collect()
    check_packing(docs, LLM_QUERIES["op2_packing"](spark, SMOKE).collect(), 2048)


@pytest.mark.parametrize("shard", [2, 4096])
def test_packing_of_odd_rows(odd_docs, no_docs, shard):
    packed = pack_documents(odd_docs, capacity=64, docs_per_shard=shard).collect()
    docs = [r for r in odd_docs.collect() if r.doc_id is not None]
    known = [r for r in packed if r.doc_id is not None]
    lengths = sum(len((r.text or "").split()) + 1 for r in docs)
    assert sum(r.length for r in known) == lengths
    assert sorted(r.piece for r in packed if r.doc_id is None) == [0, 0]
    assert max(r.length for r in packed) == 64
    assert pack_documents(no_docs).collect() == []
    clusters = pack_documents(odd_docs, docs_per_shard=99, source_col="lang", cluster=F.lit("one"))
    assert clusters.select("bin_id").distinct().count() == odd_docs.count() + 14


def test_stages_on_real_rows(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    names = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, out = docs, corpus_pipeline.written(stage(spark, docs, SMOKE), name)
        assert out.columns == COLUMNS and out.dtypes == docs.dtypes
        ids = {r.doc_id for r in out.collect()}
        if name == "quality_rules":
            assert ids == {r.doc_id for r in apply_rules(before).filter("kept").collect()}
        if name == "simhash_near_dedup":
            classes = {r.component_id for r in simhash_components(before).collect()}
            assert ids == classes
        if name == "personal_data":
            assert ids == {r.doc_id for r in before.collect()}
        assert out.filter("n_chars != length(text)").count() == 0
        names.append(name)
        docs = out
    assert names == ["quality_rules", "quality_classifier", "simhash_near_dedup", "personal_data"]
    check_packing(docs.collect(), corpus_pipeline.packing(spark, docs, SMOKE).collect(), 2048)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMOKE}/labels.parquet").collect()}
    original = spark.read.parquet(f"{SMOKE}/documents.parquet").collect()
    good = [r for r in original if labels.get(r.doc_id) == 1 and len(r.text.split()) >= 20]
    kept = {simhash(r.text.encode()) for r in docs.collect()}
    lost = [r.doc_id for r in good if simhash(r.text.encode()) not in kept]
    assert len(lost) <= 0.1 * len(good)  # personal data changes a few fingerprints


def test_stages_bear_odd_rows(spark, odd_docs):
    docs = odd_docs.select(*COLUMNS, "label", "row")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMOKE)
        assert out.columns == docs.columns
        if name == "simhash_near_dedup":
            kept = out.collect()
            assert len(kept) == len({simhash((r.text or "").encode()) for r in kept})
            assert {r.doc_id for r in kept} == {1, None, 2, 5, 6, 7}
        assert stage(spark, docs.limit(0), SMOKE).collect() == []
    assert corpus_pipeline.packing(spark, docs, SMOKE).count() > 0


def test_whole_run(spark):
    assert corpus_pipeline.run(spark, SMOKE).count() > 0
