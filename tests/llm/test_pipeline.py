"""The pipeline's stages on a small corpus and on odd rows."""

from __future__ import annotations

import corpus_pipeline
from gaugeflow.llm import decontamination, near_duplicates

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(900001, None, "en", "s", 0), (900002, "12 !", "en", "s", 4)], docs.schema)
    rows = docs.union(odd)
    kept = [rows]
    for _, stage in corpus_pipeline.STAGES:
        kept.append(stage(spark, kept[-1], SF).persist())
    for table in kept[1:-1]:
        assert table.columns == docs.columns
    ids = [{r.doc_id for r in t.select("doc_id").distinct().collect()} for t in kept]
    assert ids[0] - ids[1] == {900001, 900002}
    classes = near_duplicates.near_duplicates(kept[1]).collect()
    assert ids[2] == {r.class_id for r in classes}
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    bad = decontamination.contamination(kept[2], items).where("contaminated").collect()
    assert ids[3] == ids[2] - {r.doc_id for r in bad}
    assert ids[4] == ids[3] == ids[5]
    assert not kept[4].where("text RLIKE '[0-9a-f]{16}'").count()


def test_empty_corpus(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
