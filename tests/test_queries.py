"""Every query with SQL agrees with it on the smallest tables; the entry point runs."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.harness import compare, connect

QUERIES, SQL = entry.queries(), entry.oracle_sql()
SLOW = {"m19_search", "m20_train_meta", "m21_train", "v8_evaluate_stack", "t1_score_messages", "t2_score_stream"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_agrees_with_sql(spark, con, sf_dir, name):
    result, _ = compare(spark, con, name, QUERIES[name], SQL[name], sf_dir)
    assert result.startswith("ok"), result


def test_entry(spark):
    out = entry.entry(spark)
    assert out.columns[0] == "user" and out.count() == 2


def test_every_sql_has_its_query():
    assert set(SQL) <= set(QUERIES) and SLOW <= set(QUERIES)
