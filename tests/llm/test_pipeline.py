"""The corpus pipeline as a whole, on the given tables and on a table of edge cases."""

import corpus_pipeline
from conftest import SF0001
from test_text_operators import EDGE

from tapewise.llm import jaccard
from tapewise.llm.common import scratch, table
from tapewise.llm.queries import QUERIES


def test_stages_keep_the_columns_and_pack_every_document(spark):
    docs = table(spark, SF0001, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF0001)
        assert kept.columns == docs.columns, name
        path = scratch(spark, "stage")
        kept.write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        assert docs.select("doc_id").exceptAll(before.select("doc_id")).count() == 0
        assert docs.count() > before.count() // 2, name
    assert docs.count() < table(spark, SF0001, "documents").count()
    groups = jaccard.jaccard_components(docs)
    assert groups.groupBy("component_id").count().filter("count > 1").count() == 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF0001)
    assert pieces.select("doc_id").distinct().count() == docs.count()
    assert pieces.count() == corpus_pipeline.run(spark, SF0001).count()


def test_only_leaks_and_copies_go(spark):
    """Of the documents that no stage has a reason to drop, all stay."""
    docs = table(spark, SF0001, "documents")
    leaks = {r.doc_id for r in QUERIES["op1_decontaminate"](spark, SF0001).collect()}
    toxic = {r.doc_id for r in QUERIES["op2_toxicity"](spark, SF0001).collect() if r.predicted == 1}
    cut = {r.doc_id for r in QUERIES["op5_line_dedup"](spark, SF0001).collect() if r.removed_lines}
    copies = {r.doc_id for r in QUERIES["op10_jaccard"](spark, SF0001).collect() if r.component_id != r.doc_id}
    packed = {r.doc_id for r in corpus_pipeline.run(spark, SF0001).select("doc_id").distinct().collect()}
    assert {r.doc_id for r in docs.collect()} - leaks - toxic - cut - copies <= packed


def test_edge_cases_pass_all_stages(spark):
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in EDGE], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF0001)
    assert {None, 1, 2, 3, 4, 14} <= {r.doc_id for r in docs.collect()}
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, SF0001)
    assert none.count() == 0
