"""The pipeline's stages in a row, each against its operator, on the smallest tables."""

import corpus_pipeline
from seqframe.llm import decontam, neardup, quality
from seqframe.llm.common import DOCUMENT_COLUMNS
from tests.conftest import SF_SMALL


def test_pipeline_keeps_what_its_stages_keep(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    good = {r["doc_id"] for r in quality.judge(docs).where("kept").collect()}
    one = docs.where(docs.doc_id.isin(list(good)))
    kept = {r["doc_id"] for r in neardup.near_duplicates(one).where("kept").collect()}
    two = one.where(one.doc_id.isin(list(kept)))
    clean = {r["doc_id"] for r in decontam.find_leaks(two, bench).where("not contaminated").collect()}
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert set(DOCUMENT_COLUMNS) <= set(out.columns)
    rows = out.collect()
    assert {r["doc_id"] for r in rows} <= clean
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    words = sum(len(r["text"].split()) for r in rows)
    left = {r["doc_id"]: len(r["text"].split()) for r in two.collect() if r["doc_id"] in clean}
    assert abs(words - sum(left.values())) <= 20  # less than one word per source is left out


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "near duplicates", "decontamination", "mixing", "sharding"]
    empty = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for i, (_, f) in enumerate(corpus_pipeline.STAGES):
        out = f(spark, empty, SF_SMALL)
        assert out.count() == 0
        assert i == 4 or out.columns == DOCUMENT_COLUMNS
