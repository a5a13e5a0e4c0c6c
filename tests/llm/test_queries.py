"""The registered queries and the pipeline on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from feedloom.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_runs_over_its_table(spark, name):
    table = {"op8_neighbours": None, "op9_warc_derivatives": "pages", "op1_benchmark_leaks": None, "op10_packing": None, "op11_ranked": None, "op13_whitening": None}.get(name, "documents")
    found = entry.queries()[name](spark, SF)
    rows = found.count()
    assert rows > 0
    if table:
        assert rows == spark.read.parquet(f"{SF}/{table}.parquet").count() * (2 if table == "pages" else 1)


def test_all_operators_are_registered():
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14))
    assert set(ORACLE) <= set(QUERIES) and "pipeline" in entry.queries()


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.dtypes, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.dtypes == columns and 0 < docs.count() <= before
        before = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == before
    assert corpus_pipeline.run(spark, SF).count() == packed.count()


def test_pipeline_of_no_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
