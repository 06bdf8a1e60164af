"""Every registered query against its checking SQL, and the contract of the entry module."""

import os

import pytest

import __spark_entry__ as entry
from claimtree.plans.pushdown import plan_text
from claimtree.queries import all_queries
from tests.compare import compare, duck

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
UNWANTED = ["CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "InPandas", "EvalPython"]
SQL = {name: sql for name, (_, sql) in all_queries().items() if sql}
QUERIES = {name: run for name, (run, _) in all_queries().items()}


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    result = QUERIES[name](spark, FOLDER)
    text = plan_text(result)
    assert not [word for word in UNWANTED if word in text]
    if name in SQL:
        assert compare(result, con, SQL[name]) == []
    else:
        assert result.count() > 0


def test_sql_names_are_queries():
    assert SQL.keys() <= QUERIES.keys()


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.count() > 0 and "child_id" in rows.columns
