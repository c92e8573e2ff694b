from collections import Counter

import corpus_pipeline
from tableflow.llm.common import staged, table
from tableflow.llm.quality_classifier import classify
from tableflow.llm.quality_rules import quality_rules
from tableflow.llm.simhash import near_duplicates


def test_each_stage_on_its_input(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    columns = docs.columns
    outs = []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, staged(stage(spark, docs, sf_dir), name)
        outs.append((before, docs))
    for before, after in outs[:-1]:
        assert after.columns == columns

    before, after = outs[0]
    good = {r.doc_id for r in classify(before, table(spark, sf_dir, "labels")).collect() if r.predicted}
    assert Counter(after.collect()) == Counter(r for r in before.collect() if r.doc_id in good)
    assert 0 < after.count() < before.count()

    before, after = outs[1]
    kept = {r.doc_id for r in quality_rules(before).where("kept").collect()}
    assert Counter(after.collect()) == Counter(r for r in before.collect() if r.doc_id in kept)

    before, after = outs[2]
    first = {r.component_id for r in near_duplicates(before).collect()}
    assert Counter(after.collect()) == Counter(r for r in before.collect() if r.doc_id in first)
    assert after.count() < before.count()

    before, after = outs[3]
    whole = {(r.doc_id, r.text) for r in before.collect()}
    assert sum((r.doc_id, r.text) not in whole for r in after.collect()) <= before.select("source").distinct().count()
    assert max(Counter(r.doc_id for r in after.collect()).values()) <= 3

    before, after = outs[4]
    assert Counter(r.doc_id for r in after.where("piece = 0").collect()) == Counter(r.doc_id for r in before.collect())


def test_odd_documents_go_through(spark, odd_docs, sf_dir):
    docs = odd_docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
        assert docs.columns == odd_docs.columns


def test_empty(spark, no_docs, sf_dir):
    docs = no_docs
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
        assert docs.count() == 0
