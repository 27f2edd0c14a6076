"""Queries with SQL against their SQL; the others give a row for each row of their table; the pipeline runs."""

import pytest

import __spark_entry__ as entry
from clientele.llm import ORACLE, QUERIES
from tests.oracle_check import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, con, name):
    assert compare(con, QUERIES[name](spark, FOLDER), ORACLE[name]) is None


def test_all_are_registered():
    names = entry.queries()
    assert {f"op{n}_" for n in range(1, 14)} <= {n[: n.index("_") + 1] for n in names if n.startswith("op")}
    assert "pipeline" in names


def test_pipeline_agrees_with_stage_by_stage_sets(spark):
    import corpus_pipeline as c

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = docs.columns
    kept = [docs.count()]
    for _, stage in c.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == names
        docs = docs.checkpoint() if spark.sparkContext.getCheckpointDir() else docs
        kept.append(docs.count())
    assert kept == sorted(kept, reverse=True) and kept[1] < kept[0] and kept[2] == kept[1] and kept[-1] > 0
    want = {r.doc_id for r in docs.select("doc_id").collect()}
    assert {r.doc_id for r in c.run(spark, FOLDER).collect()} == want
