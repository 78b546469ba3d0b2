"""Every registered query against its DuckDB oracle on the smallest test scale."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
import oracle_check  # noqa: E402
from wayfarer.plans.oracle import ORACLE_SQL  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle_check.duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, duck, name):
    r = oracle_check.check(spark, duck, SF, name)
    assert r["ok"], r["problems"]


@pytest.mark.parametrize("name", ["hh", "trip_unlinked", "zone_using_join"])
def test_shuffled_zone_join_matches_oracle(spark, duck, name):
    """Zone index over its broadcast limit: the lookup is a shuffled join on the cell."""
    spark.conf.set("wayfarer.spatial.maxBroadcastBytes", "1")
    try:
        df = E.queries()[name](spark, SF)
        plan = df._jdf.queryExecution().executedPlan().toString()
        r = oracle_check.check(spark, duck, SF, name)
    finally:
        spark.conf.unset("wayfarer.spatial.maxBroadcastBytes")
    assert "BroadcastNestedLoopJoin" not in plan
    assert r["ok"], r["problems"]
