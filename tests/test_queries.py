"""Every registered query with SQL against DuckDB on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from tools.check_oracle import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are absent")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 120


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert [r["year"] for r in sorted(rows)] == list(range(1995, 2002))


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    got = entry.queries()[name](spark, SF_DIR).toPandas()
    assert compare(got, duck.execute(entry.oracle_sql()[name]).df()) is None


@pytest.mark.parametrize("name", ["q_train_decision_tree", "q_evaluate", "q_model_store"])
def test_model_query_runs(spark, name):
    assert entry.queries()[name](spark, SF_DIR).count() > 0


def test_no_plan_crosses_or_collects_rows(spark):
    for name in ("q_default_rate_by_year", "q_score_curve", "q_drift_numeric", "q_pair_background"):
        df = entry.queries()[name](spark, SF_DIR)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_scan_reads_only_what_the_target_needs(spark):
    df = entry.queries()["q_ever_default"](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "l_orderkey" in schema and "l_extendedprice" not in schema and "l_shipdate" not in schema
