"""Stages of the pipeline, each on its own input."""

from __future__ import annotations

import corpus_pipeline
from parcelflow.llm import decontaminate, mixing
from parcelflow.llm.common import staged, table


def test_stages_take_effect(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, staged(stage(spark, docs, sf_dir), name)
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        assert ids and ids <= {r.doc_id for r in before.select("doc_id").collect()}
        if name != "shard":
            assert docs.columns == columns
        if name == "near_dedup":
            texts = [r.text for r in docs.select("text").collect()]
            assert len(texts) == len(set(texts)) < before.count()
        if name == "decontamination":
            assert decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")).count() == 0
        if name == "mix_sources":
            plan = mixing.mixture_plan(before).collect()
            assert sum(len(r.text.split()) for r in docs.collect()) == sum(r.taken for r in plan)
    assert {r.shard for r in docs.select("shard").collect()} == set(range(8))


def test_run_gives_the_stages_rows(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0


def test_odd_rows_pass_the_stages(spark, odd_docs, sf_dir):
    docs = odd_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, sf_dir), "odd")
    assert docs.count() > 0
