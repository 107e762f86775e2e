"""The registered queries: against SQL where there is one, and the pipeline's stages."""

import pytest

import corpus_pipeline
from check_oracles import compare, connect
from fairtally.llm.queries import ORACLES, QUERIES
from frames import no_documents, odd_documents

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    same, n, detail = compare(spark, connect(SF_DIR), name, SF_DIR)
    assert same and n > 0, detail


def test_one_query_for_each_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


def test_stages_keep_the_columns(spark):
    for docs in (odd_documents(spark), no_documents(spark)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, docs, SF_DIR)
            assert after.columns == docs.columns, name
            after.count()
        corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count()


def test_pipeline_drops_copies_and_keeps_clean_text(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    packed = corpus_pipeline.run(spark, SF_DIR)
    kept = {r.doc_id for r in packed.select("doc_id").distinct().collect()}
    assert kept < {r.doc_id for r in docs.collect()}
    judged = QUERIES["op9_quality_rules"](spark, SF_DIR).join(labels.withColumnRenamed("quality", "label"), "doc_id")
    assert judged.where("label = 1 AND NOT kept AND NOT base_failed").count() == 0
    assert packed.groupBy("sequence_id").sum("length").where("`sum(length)` > 1024").count() == 0
