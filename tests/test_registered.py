"""Every registered query against its SQL twin, and what its plan may not contain."""

from __future__ import annotations

import os

import compare
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from lakeworks.plans.registry import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "EvalPython", "InPandas", "InArrow", "MapPartitions")


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, con, name):
    df = queries()[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in FORBIDDEN if word in plan]
    assert compare.difference(df, con, oracle_sql()[name]) is None


def test_entry_has_rows(spark):
    assert entry(spark).limit(1).count() == 1


def test_every_query_has_a_twin():
    assert set(QUERIES) <= set(oracle_sql())
