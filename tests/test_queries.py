"""Registered queries against their SQL on the given tables, and the shape of their plans."""

import re

import pytest

import __spark_entry__ as entry_module
from closebell.plans.oracles import ORACLES
from closebell.plans.queries import QUERIES
from oracle_check import compare, connect

SF = "/root/testdata/sf0.001"
PYTHON = {"sentiment_model", "equity_refused"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    if name not in PYTHON:
        assert not re.search(r"ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas", plan)
    assert compare(df, con, ORACLES[name]) is None


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(ORACLES) <= set(entry_module.oracle_sql())


def test_entry(spark):
    assert entry_module.entry(spark).columns[0] == "run_id"
