"""Plan properties that matter at scale, checked on the final physical plans."""

import pytest

from helpers import SF_SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")


def _plan(spark, name):
    import __spark_entry__ as E
    df = E.queries()[name](spark, SF_SMALL)
    execution = df._jdf.queryExecution()
    execution.toRdd().count()  # runs this frame's own plan, so adaptive changes show
    plan = execution.executedPlan().toString()
    assert "isFinalPlan=false" not in plan.split("Initial Plan")[0]
    return plan.split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", ["feature_table", "forecast_linear", "drift_decision",
                                  "dag_status", "alert_log", "flagged_predictions",
                                  "deduplicated_orders", "incremental_batch"])
def test_no_cartesian_no_python(spark, name):
    # operators: JN1
    plan = _plan(spark, name)
    for op in FORBIDDEN:
        assert op not in plan, (name, op)


def test_order_aggregate_is_combined_map_side(spark):
    # operators: AG1
    # AG1: partial aggregate below the shuffle, so hot zones collapse per task
    # and a plain hash aggregate (fixed-width buffers), no object aggregate
    # that would fall back to sorting beyond 128 groups per task
    plan = _plan(spark, "hourly_zone_agg")
    assert "partial_count" in plan and "partial_max" in plan
    assert plan.index("Exchange hashpartitioning") < plan.index("partial_count")
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
    assert plan.count("Window [") == 1  # totals and modal label in one window pass


def test_scan_pushdown_and_pruning(spark):
    # operators: SRC1, TK2
    plan = _plan(spark, "incremental_batch")
    assert "GreaterThan(ts," in plan  # watermark predicate reaches the Parquet scan
    assert "props" not in plan.split("ReadSchema")[1]  # unused column not read


def test_latest_per_group_uses_group_limit(spark):
    # operators: WN8
    assert "WindowGroupLimit" in _plan(spark, "latest_runs")


def test_lags_share_one_window(spark):
    # operators: WN1, WN2, WN3, WN4, WN5, WN6, WN7
    # all four lags in one Window node; the hour-metadata window is pruned
    # away when its columns are not selected, and present in the full table
    plan = _plan(spark, "lag_features")
    assert plan.count("Window [") == 1
    window = [l for l in plan.split("\n") if "Window [" in l][0]
    assert window.count("lag(order_count") == 4
    assert _plan(spark, "feature_table").count("Window [") == 2
