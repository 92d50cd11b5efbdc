"""AG1-AG4, JN1-JN3, WN1-WN7 (reference intents F3, F4; fixtures G1-G4)."""

import datetime as dt

from pyspark.sql import functions as F

from helpers import SF_MID, order, orders_df, ts
from zonecast.operators import features as FE
from zonecast.operators import validate as V
from zonecast.sources.adapters import raw_orders_from_testdata


def _series(spark, cfg, counts_by_zone, start="2026-01-01 00:00:00"):
    """Clean orders giving the requested hourly counts per zone."""
    rows, base = [], ts(start)
    for z, counts in counts_by_zone.items():
        for h, n in enumerate(counts):
            for i in range(n):
                rows.append(order(f"{z}-{h}-{i}", zone=z, t=base + dt.timedelta(hours=h, minutes=i % 60)))
    return orders_df(spark, rows)


def _by(df, zone):
    return [r for r in df.where(F.col("zone_id") == zone).orderBy("timestamp").collect()]


def test_lags_do_not_leak_across_zones(spark, cfg):
    # operators: WN1, WN2, TK1
    # F3
    feats = FE.build_features(_series(spark, cfg, {"Z1": [10, 20, 30], "Z2": [100, 200, 300]}), cfg)
    z1, z2 = _by(feats, "Z1"), _by(feats, "Z2")
    assert [r.lag_1h for r in z1] == [None, 10.0, 20.0]
    assert [r.lag_1h for r in z2] == [None, 100.0, 200.0]
    assert z1[2].lag_2h == 10.0 and z2[2].lag_2h == 100.0


def test_rolling_mean_needs_full_window(spark, cfg):
    # operators: WN5, WN6, WN7, FN14
    # F4 + G4: mean 20.0 and sample std 10.0 at 03:00, NULL / 0.0 before
    z1 = _by(FE.build_features(_series(spark, cfg, {"Z1": [10, 20, 30, 40]}), cfg), "Z1")
    assert [r.rolling_mean_3h for r in z1] == [None, None, None, 20.0]
    assert [round(r.rolling_std_3h, 9) for r in z1] == [0.0, 0.0, 0.0, 10.0]
    assert all(r.rolling_mean_24h is None for r in z1)


def test_grid_fills_gaps(spark, cfg):
    # operators: AG1, AG3, AG4, JN1, JN2, JN3, FN1, FN12, FN13
    # G1: Z1 at 00 and 02, Z2 at 02 -> 5 zones x 3 hours; 01:00 zero/sunny/no festival
    rows = [order("a", zone="Z1", t="2026-01-01 00:10:00", weather="rainy", festival=True),
            order("b", zone="Z1", t="2026-01-01 02:20:00", weather="cloudy"),
            order("c", zone="Z2", t="2026-01-01 02:30:00", weather="cloudy")]
    g = FE.filled_grid(FE.zone_hour_aggregate(orders_df(spark, rows)), cfg)
    assert g.count() == 15
    assert g.select("zone_id", "timestamp").distinct().count() == 15
    h1 = g.where(F.col("timestamp") == ts("2026-01-01 01:00:00")).collect()
    assert {(r.order_count, r.weather_condition, r.is_festival_day) for r in h1} == {(0, "sunny", False)}
    z3_h0 = g.where((F.col("zone_id") == "Z3") & (F.col("timestamp") == ts("2026-01-01 00:00:00"))).first()
    assert (z3_h0.order_count, z3_h0.weather_condition, z3_h0.is_festival_day) == (0, "rainy", True)


def test_mode_tie_takes_smallest_label(spark, cfg):
    # operators: AG1
    # G2
    rows = [order(f"o{i}", weather=w) for i, w in enumerate(["sunny", "sunny", "rainy", "rainy"])]
    zh = FE.zone_hour_aggregate(orders_df(spark, rows)).first()
    assert zh.weather_condition == "rainy" and zh.order_count == 4


def test_hour_weather_is_mode_of_zone_modes(spark, cfg):
    # operators: AG2, FN13
    # Z1 nine sunny orders, Z2 and Z3 one rainy each -> Z4 gets rainy
    rows = [order(f"a{i}", zone="Z1", weather="sunny") for i in range(9)]
    rows += [order("b", zone="Z2", weather="rainy"), order("c", zone="Z3", weather="rainy")]
    g = FE.filled_grid(FE.zone_hour_aggregate(orders_df(spark, rows)), cfg)
    assert g.where(F.col("zone_id") == "Z4").first().weather_condition == "rainy"


def test_calendar_features(spark, cfg):
    # operators: FN2, FN3, FN4, FN5, FN6, FN8, FN9, FN10
    feats = FE.build_features(orders_df(spark, [order("a", t="2027-01-01 13:30:00")]), cfg)
    r = feats.where(F.col("zone_id") == "Z2").first()
    # 2027-01-01 is a Friday in ISO week 53 of 2026
    assert (r.hour_of_day, r.day_of_week, r.is_weekend, r.month, r.week_of_year) == (13, 4, False, 1, 53)
    assert (r.is_peak_hour, r.zone_id_encoded, r.weather_rainy) == (1, 1, 0)


def test_grid_properties_on_testdata(spark, cfg):
    # operators: AG1, AG3, AG4, JN1, JN2, FN12, VAL10
    clean = V.clean_rows(V.validate(raw_orders_from_testdata(spark, SF_MID, cfg), cfg, dedupe=False))
    feats = FE.build_features(clean, cfg)
    n_hours = feats.select("timestamp").distinct().count()
    assert feats.count() == len(cfg.zones) * n_hours
    assert feats.select("zone_id", "timestamp").distinct().count() == feats.count()
    assert feats.agg(F.sum("order_count")).first()[0] == clean.count()


def test_incremental_equals_full(spark, cfg):
    # operators: WN1, WN2, WN3, WN4, WN5, WN6, WN7
    clean = V.clean_rows(V.validate(raw_orders_from_testdata(spark, SF_MID, cfg), cfg, dedupe=False))
    full = FE.build_features(clean, cfg)
    since = ts("2024-01-20 05:00:00")
    start = full.agg(F.min("timestamp")).first()[0]
    inc = FE.build_features_incremental(clean, cfg, since, start)
    expected = full.where(F.col("timestamp") >= since)
    assert inc.count() == expected.count()
    assert inc.exceptAll(expected).count() == 0
