"""Every query of the folder runs on the smallest tables and agrees with its SQL where it has one."""

from __future__ import annotations

import pytest

import corpus_pipeline
from inkprint import llm
from tests.harness import compare, connect

QUERIES, SQL = llm.queries(), llm.oracle_sql()
OPERATORS = set(range(1, 14))


def test_one_query_for_each_operator():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == OPERATORS and set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_agrees_with_sql(spark, sf_dir, name):
    result, _ = compare(spark, connect(sf_dir), name, QUERIES[name], SQL[name], sf_dir)
    assert result.startswith("ok"), result


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_has_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before, columns = docs, docs.columns
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.materialize(stage(spark, before, sf_dir), name)
        ids = {r["doc_id"] for r in after.select("doc_id").collect()}
        assert ids and ids <= {r["doc_id"] for r in before.select("doc_id").collect()}
        if name != "mixing":
            assert after.columns == columns
        before = after
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0
