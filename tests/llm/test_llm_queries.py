"""Registered training-data queries on the shared tables, and the pipeline against the single operators."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

import compare  # noqa: E402
import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from recordlens.llm import jaccard_join, template_decontamination  # noqa: E402
from recordlens.llm.queries import ORACLE, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="shared test tables not present")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, name):
    connection = duckdb.connect()
    for table in compare.TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    assert compare.compare(spark, SF, name, QUERIES[name], ORACLE[name], connection).startswith("ok")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_whole_table(spark, name):
    table, key = ("embeddings", "vec_id") if name.startswith("op2") else ("documents", "doc_id")
    got = QUERIES[name](spark, SF)
    rows = [r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(key).collect()]
    found = [r[0] for r in got.select(key).collect()]
    if name.startswith("op6"):
        assert set(found) <= set(rows)
    else:
        assert sorted(found) == sorted(rows)
    assert entry.queries()[name] is QUERIES[name]


def test_pipeline_keeps_what_its_stages_keep(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = docs
    for name, function in corpus_pipeline.STAGES[:-1]:
        result = corpus_pipeline.stage(function(spark, seen, SF), name)
        assert result.columns == docs.columns and result.exceptAll(seen).isEmpty()
        seen = result
    assert jaccard_join.similar_texts(seen).filter("n_links > 0").isEmpty()
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert template_decontamination.contaminated(seen, items).isEmpty()
    final = corpus_pipeline.run(spark, SF)
    assert sorted(r.doc_id for r in final.select("doc_id").collect()) == sorted(r.doc_id for r in seen.select("doc_id").collect())


def test_pipeline_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, function in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(function(spark, docs, SF), name)
        assert docs.count() == 0
