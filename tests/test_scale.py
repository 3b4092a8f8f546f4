"""Plans that must not change: pruned and pushed-down scans, partial aggregates, no cross joins."""

import pytest

from annalist.plans import catalogue

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    return catalogue.queries()[name](spark, SF)._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_no_query_has_a_cross_join(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_filters_reach_the_scan(spark):
    text = plan(spark, "ack_confirmed")
    assert "PushedFilters: [IsNotNull(l_linestatus), EqualTo(l_linestatus,F)]" in text and "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_linestatus:string>" in text


@pytest.mark.parametrize("name", ["current_state", "latest_validators", "completeness", "release_parts"])
def test_latest_rows_are_partial_aggregates(spark, name):
    text = plan(spark, name)
    assert "partial_" in text and "Window" not in text
