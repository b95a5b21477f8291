"""Registered queries against their SQL; the pipeline's stages."""

import pytest

import corpus_pipeline
from compare import connect, difference, spark_rows, sql_rows
from newsmart.llm.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", list(SQL))
def test_query_equals_sql(spark, key):
    assert difference(spark_rows(QUERIES[key](spark, SF_DIR)), sql_rows(connect(SF_DIR), SQL[key])) == ""


def test_one_query_per_operator():
    assert sorted(int(key[2:].split("_")[0]) for key in QUERIES if key.startswith("op")) == list(range(1, 14))


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, docs.count()
    junk = spark.createDataFrame([(10_000, "123 456", None, None, 7), (10_001, None, "en", "src1", None)], docs.schema)
    docs = docs.unionByName(junk).unionByName(docs.where("doc_id < 5").selectExpr("doc_id + 20000 AS doc_id", *columns[1:]))
    ids = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        ids[name] = {row.doc_id for row in docs.select("doc_id").collect()}
        assert name == corpus_pipeline.STAGES[-1][0] or docs.columns == columns
    order = [name for name, _ in corpus_pipeline.STAGES]
    assert all(ids[later] <= ids[earlier] for earlier, later in zip(order, order[1:]))
    assert not ids["language_id"] & {10_000, 10_001} and len(ids["language_id"]) == before + 5
    assert not ids["line_dedup"] & set(range(20_000, 20_005))
    assert len(ids["source_mixing"]) < len(ids["near_dedup"])
    assert ids["packing"] == ids["source_mixing"]
