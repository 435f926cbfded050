"""Plan shapes that have to hold at scale."""

import pytest

from changeloom.queries import QUERIES

SF = "/root/testdata/sf0.001"

BATCH = [name for name in QUERIES if not name.startswith("stream_")]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    # As for tables too large to broadcast.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    found = {name: _plan(QUERIES[name](spark, SF)) for name in BATCH}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    return found


def test_no_cross_or_nested_loop_joins(plans):
    bad = [n for n, p in plans.items() if "CartesianProduct" in p or "NestedLoop" in p]
    assert bad == []


def test_no_python_in_plans(plans):
    bad = [n for n, p in plans.items() if "Python" in p or "InPandas" in p]
    assert bad == []


def test_no_forced_broadcast(plans):
    # The one exception counts what it broadcasts first: at most 2^21 pairs of numbers, else it shuffles.
    assert [n for n, p in plans.items() if "BroadcastExchange" in p] == ["digest_difference"]


def test_windows_over_rows_are_partitioned_by_block(plans):
    for name in ("publish", "retain", "offset_gaps", "counter_rates", "surrogate_key", "cumulative"):
        assert "__block0" in plans[name], name


def test_filters_reach_the_scan(plans):
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plans["recent_rows"]
    assert "In(event_type, [error,view])" in plans["select_topics"]
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string,value:double>" in plans["materialize"]


def test_latest_row_is_aggregated_before_the_shuffle(plans):
    plan = plans["materialize"]
    assert plan.count("max_by") >= 2 and "partial_max_by" in plan
    assert plan.count("Exchange") == 1


def test_percentile_rows_are_filtered_before_their_exchange(plans):
    # The check is a scalar subquery of fixed size, and stands below the join.
    assert "element_at" in plans["exact_percentile"]
