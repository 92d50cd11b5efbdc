"""Windows with more groups than zones, numbering without a group in one task."""

import pytest
from pyspark.sql import functions as F

from helpers import SF_SMALL, order, orders_df
from zonecast.operators import features as FE
from zonecast.operators import validate as V
from zonecast.plans import catalog as C


@pytest.mark.parametrize("hours", [24, 100, 168, 10**6])
def test_slices_of_any_length_give_the_same_features(spark, cfg, hours):
    # operators: WN1, WN2, WN3, WN4, WN5, WN6, WN7
    zh = C.zone_hours(spark, SF_SMALL).cache()
    want = FE.features_from_zone_hours(zh, cfg.with_(slice_hours=10**7))
    got = FE.features_from_zone_hours(zh, cfg.with_(slice_hours=hours))
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_the_window_stage_has_more_groups_than_zones(spark, cfg):
    # operators: WN1, WN5
    zh = C.zone_hours(spark, SF_SMALL)
    grid = FE.filled_grid(zh, cfg)
    n = grid.count()
    cut = FE.sliced(grid, 168, 24)
    groups = cut.groupBy("zone_id", "_slice").agg(F.count("*").alias("n"), F.count_if(~F.col("_halo")).alias("own"))
    worst = groups.agg(F.count("*"), F.max("n"), F.sum("own")).first()
    assert worst[0] > 30 * len(cfg.zones) and worst[1] == 168 + 24 and worst[2] == n
    plan = FE.lag_rolling_features(grid, cfg)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(zone_id" in plan and "_slice" in plan.split("hashpartitioning(zone_id")[1].split(")")[0]


def test_equal_rows_are_numbered_without_meeting_in_one_task(spark):
    # operators: SNK2, VAL10
    rows = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 10 < 8, F.lit(7)).otherwise(F.col("id") % 5).alias("k"))
    out = V.numbered(rows, "k")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    windows = [x for x in plan.split("\n") if "Window" in x]
    assert all("_task" in x or "_rows" in x for x in windows)  # rows by (key, task), counts by key
    stats = out.groupBy("k").agg(F.count("*").alias("n"), F.min("_n").alias("lo"), F.max("_n").alias("hi"),
                                 F.count_distinct("_n").alias("d")).collect()
    assert len(stats) == 3 and all(r.lo == 1 and r.n == r.hi == r.d for r in stats)
    assert max(r.n for r in stats) == 160_000


def test_error_ids_of_repeats_are_the_same_in_a_retry(spark):
    # operators: SNK2, VAL10
    rows = [order(None), order(None), order(None, zone="Z2"), order("x", t=None)] * 3
    columns = orders_df(spark, rows).columns
    ids = lambda n: sorted(r.error_id for r in V.with_error_id(orders_df(spark, rows).repartition(n), columns).collect())
    assert ids(1) == ids(5) and len(set(ids(3))) == 12
