"""The queries with SQL against the second engine, and the pipeline against its stages' promises."""

import pytest

from lakesteward.llm.queries import LLM_ORACLE, LLM_QUERIES
from tests.compare import differences, second_engine


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_matches_sql(spark, sf_dir, name):
    assert differences(spark, second_engine(sf_dir), LLM_QUERIES[name], LLM_ORACLE[name], sf_dir) == ""


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in LLM_QUERIES) == list(range(1, 14))


def test_pipeline(spark, sf_dir):
    import corpus_pipeline
    from lakesteward.llm.tables import table
    from lakesteward.sources.session import scratch_path

    docs = table(spark, sf_dir, "documents")
    columns = docs.columns
    seen = [{r.doc_id for r in docs.select("doc_id").collect()}]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        path = scratch_path(spark, "stage")
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        seen.append({r.doc_id for r in docs.select("doc_id").collect()})
        assert seen[-1] <= seen[-2]
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    good = {r.doc_id for r in LLM_QUERIES["op1_quality"](spark, sf_dir).where("kept").collect()}
    assert seen[1] == good
    leaks = {r.doc_id for r in LLM_QUERIES["op4_decontaminate"](spark, sf_dir).collect()}
    assert seen[3] == seen[2] - leaks
    assert seen[5] == seen[4]
