"""ML7-ML12, AG5-AG10, FN15-FN20, RP (fixtures G8-G14)."""

import datetime as dt

from pyspark.sql import functions as F

from helpers import ts
from zonecast.functions import metrics as M
from zonecast.operators import forecast as FC
from zonecast.operators import monitor as MON
from zonecast.operators import reports as RP


def _feature_rows(spark, cfg, counts, zone="Z1", start="2026-03-02 00:00:00", rainy=0):
    base = ts(start)
    rows = [(zone, base + dt.timedelta(hours=i), n, rainy) for i, n in enumerate(counts)]
    return spark.createDataFrame(rows, "zone_id string, timestamp timestamp_ntz, "
                                       "order_count int, weather_rainy int")


def test_mape_masks_zero_actuals(spark):
    # operators: AG7, FLT9
    # G8
    df = spark.createDataFrame([(0.0, 5.0), (10.0, 9.0), (20.0, 25.0)], "a double, p double")
    assert round(df.agg(M.mape("a", "p")).first()[0], 9) == 17.5
    zero = spark.createDataFrame([(0.0, 5.0)], "a double, p double")
    assert zero.agg(M.mape("a", "p")).first()[0] == 0.0


def test_recursion_feeds_unrounded_prediction(spark, cfg):
    # operators: ML8, ML9, WN9, ST1, ST2, FN15, FN16
    # Scorer lag_1h + 0.004 over counts 10, 20, 30
    feats = _feature_rows(spark, cfg, [10, 20, 30])
    scorer = lambda df: df.withColumn("prediction", F.col("lag_1h") + 0.004)
    out = {r.step: r for r in FC.forecast(feats, scorer, cfg).collect()}
    assert abs(out[1].predicted_raw - 30.004) < 1e-9 and out[1].predicted_order_count == 30.0
    assert abs(out[2].predicted_raw - 30.008) < 1e-9 and out[2].predicted_order_count == 30.01
    # step 2 sees step 1 as lag_1h and inside both means; lag_2h is the last actual
    assert abs(out[2].lag_1h - 30.004) < 1e-9 and out[2].lag_2h == 30.0
    assert abs(out[2].rolling_mean_3h - (20 + 30 + 30.004) / 3) < 1e-9


def test_short_history_fallbacks(spark, cfg):
    # operators: ML9, ML10
    # One row with count 4
    r = [x for x in FC.forecast(_feature_rows(spark, cfg, [4]), FC.linear_scorer(), cfg).collect()
         if x.step == 1][0]
    assert (r.lag_1h, r.lag_2h, r.lag_24h, r.lag_168h) == (4.0, 4.0, 4.0, 4.0)
    assert (r.rolling_mean_3h, r.rolling_mean_24h, r.rolling_std_3h) == (4.0, 4.0, 0.0)
    assert r.weather_rainy == 0  # T16: observed behaviour


def test_weather_carry_option(spark, cfg):
    # operators: ML10, FN8
    feats = _feature_rows(spark, cfg, [4, 5], rainy=1)
    rows = FC.forecast(feats, FC.linear_scorer(), cfg.with_(forecast_weather="carry")).collect()
    assert {r.weather_rainy for r in rows} == {1}


def test_demand_status_tiers(spark, cfg):
    # operators: FN17
    # G11
    df = spark.createDataFrame([(10.0, 15.1), (10.0, 15.0), (10.0, 12.0), (None, 7.6)],
                               "a double, p double")
    from zonecast.functions.columns import demand_status
    got = [r[0] for r in df.select(demand_status("p", "a", cfg)).collect()]
    assert got == ["High Demand (Red)", "Elevated (Amber)", "Normal (Green)", "High Demand (Red)"]


def test_alert_and_flags(spark, cfg):
    # operators: ML11, JN6, JN9, SNK6, FN18
    # Average 10, predictions 15.0 and 15.1 -> one alert; flags every batch
    h = ts("2026-03-02 05:00:00")
    preds = spark.createDataFrame(
        [("Z1", h, 15.0, "NORMAL", ts("2026-03-02 04:00:00")),
         ("Z2", h, 15.1, "NORMAL", ts("2026-03-02 04:00:00")),
         ("Z2", h, 14.0, "NORMAL", ts("2026-03-02 03:00:00"))],
        "zone_id string, forecast_hour timestamp_ntz, predicted_order_count double, "
        "confidence_flag string, generated_at timestamp_ntz")
    avg = spark.createDataFrame([("Z1", 10.0), ("Z2", 10.0)], "zone_id string, avg_orders double")
    latest = preds.where(F.col("generated_at") == ts("2026-03-02 04:00:00"))
    alerts = MON.high_demand(latest, avg, cfg).collect()
    assert [a.zone_id for a in alerts] == ["Z2"]
    assert alerts[0].message == "Predicted demand 15.1 is 1.5x higher than 7-day average (10.0)"
    flagged = MON.flag_predictions(preds, spark.createDataFrame(alerts)).collect()
    assert sorted((r.zone_id, r.confidence_flag) for r in flagged) == [
        ("Z1", "NORMAL"), ("Z2", "HIGH_DEMAND"), ("Z2", "HIGH_DEMAND")]


def test_zero_average_message(spark, cfg):
    # operators: FN18
    df = spark.createDataFrame([("Z1", ts("2026-01-01 00:00:00"), 3.0)],
                               "zone_id string, forecast_hour timestamp_ntz, predicted_order_count double")
    avg = spark.createDataFrame([("Z1", 0.0)], "zone_id string, avg_orders double")
    a = MON.high_demand(df, avg, cfg).first()
    assert a.message == "Predicted demand 3.0 is n/ax higher than 7-day average (0.0)"


def _pairs(spark, n, ape):
    rows = [("Z1", ts("2026-01-01 00:00:00"), 100.0 + ape, 100) for _ in range(n)]
    return spark.createDataFrame(rows, "zone_id string, forecast_hour timestamp_ntz, "
                                       "predicted_order_count double, actual_order_count long")


def test_drift_decision(spark, cfg):
    # operators: ML7, AG7
    # G13
    low = MON.drift_decision(_pairs(spark, 4, 50.0), cfg).first()
    assert low.reason == "Triggered: Low prediction history" and low.trigger
    ok = MON.drift_decision(_pairs(spark, 5, 15.0), cfg, force_daily=False).first()
    assert ok.reason == "Skipped: MAPE within threshold" and not ok.trigger
    daily = MON.drift_decision(_pairs(spark, 5, 15.0), cfg).first()
    assert daily.reason == "Triggered: Scheduled Daily Retrain"
    hi = MON.drift_decision(_pairs(spark, 5, 15.1), cfg).first()
    assert hi.reason == "Triggered: MAPE is 15.10% (> 15%)" and hi.trigger
    none = MON.drift_decision(_pairs(spark, 9, 1.0), cfg, model_exists=False).first()
    assert none.reason == "Triggered: No existing model"


def test_latest_run_per_dag(spark, cfg):
    # operators: WN8, RP5, RP6, FLT8
    # G14 + RP5/RP6
    runs = spark.createDataFrame(
        [("ingest_and_validate", ts("2026-01-01 01:00:00"), "SUCCESS", 5),
         ("ingest_and_validate", ts("2026-01-01 02:00:00"), "FAILED", 0),
         ("model_training", ts("2026-01-01 02:00:00"), "SUCCESS", 9),
         ("model_training", ts("2026-01-02 02:00:00"), "SUCCESS", 11)],
        "dag_name string, run_time timestamp_ntz, status string, rows_processed int")
    latest = {r.dag_name: r for r in RP.latest_runs(runs).collect()}
    assert latest["ingest_and_validate"].status == "FAILED"
    assert latest["model_training"].rows_processed == 11
    status = [r.status for r in RP.dag_status(runs).collect()]
    assert status == ["FAILED", "NO RUNS", "SUCCESS", "NO RUNS"]
    f = RP.failed_runs(runs).first()
    assert (f.n_failed, f.failed_dags, f.all_clear) == (1, "ingest_and_validate", False)


def test_seven_day_window_includes_both_ends(spark, cfg):
    # operators: AG5, FLT5
    # 169 hourly rows per zone when the history is long enough
    feats = _feature_rows(spark, cfg, [1] * 200)
    assert feats.where(F.col("timestamp") >= ts("2026-03-02 00:00:00") +
                       dt.timedelta(hours=199 - 168)).count() == 169
    avg = MON.seven_day_avg(feats).first()
    assert avg.avg_orders == 1.0


def test_longer_horizon_keeps_recursion(spark, cfg):
    # operators: ML8, ST1, ST2
    feats = _feature_rows(spark, cfg, [10, 20, 30])
    scorer = lambda df: df.withColumn("prediction", F.col("lag_1h") + 0.004)
    out = {r.step: r for r in FC.forecast(feats, scorer, cfg, horizon=3).collect()}
    assert abs(out[3].predicted_raw - 30.012) < 1e-9 and out[3].predicted_order_count == 30.01
    assert out[3].lag_2h == out[2].lag_1h and out[3].forecast_hour == ts("2026-03-02 05:00:00")


def test_clip_maps_negative_and_nan_to_zero(spark):
    # operators: FN15
    from zonecast.functions.columns import clip_at_zero
    df = spark.createDataFrame([(-1.5,), (float("nan"),), (2.5,), (None,)], "p double")
    assert [r[0] for r in df.select(clip_at_zero("p")).collect()] == [0.0, 0.0, 2.5, None]


def test_seasonal_naive_scorer_predicts_last_week(spark, cfg):
    # operators: ML12, WN10
    # ML12 as a scorer: the forecast for T+1 is the count 168 hours before it
    feats = _feature_rows(spark, cfg, list(range(200)))
    out = {r.step: r for r in FC.forecast(feats, FC.seasonal_naive_scorer(), cfg).collect()}
    assert out[1].predicted_order_count == float(200 - 168)
    assert out[2].predicted_order_count == float(201 - 168)


def test_timestamp_text_round_trip(spark):
    # operators: FN21, FN22
    # FN21 / FN22
    from zonecast.functions import calendar as cal
    df = spark.createDataFrame([("2026-03-02 05:06:07",), ("not a time",)], "t string")
    got = [r[0] for r in df.select(cal.to_text(cal.from_text("t"))).collect()]
    assert got == ["2026-03-02 05:06:07", None]


def test_jdbc_tables_need_configured_url(spark):
    # operators: SRC2
    from zonecast.sources.store import JdbcTables
    import pytest
    with pytest.raises(RuntimeError):
        JdbcTables(spark).read_table("raw_orders")
