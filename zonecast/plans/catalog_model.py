"""Registered queries: evaluation, forecast and monitoring (§2.5, §2.9)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from zonecast.config import FEATURE_COLUMNS
from zonecast.functions import columns as colf
from zonecast.operators import forecast as FC
from zonecast.operators import metrics as MET
from zonecast.operators import monitor as MON
from zonecast.plans import oracle as O
from zonecast.plans.catalog import CFG, _FEAT, clean, r6, register
from zonecast.plans.catalog import features

# Columns rounded to 6 places on both sides (float sums, engine-dependent bits).
ROUNDED = {"rolling_mean_3h", "rolling_mean_24h", "rolling_std_3h", "mape", "rmse", "mae",
           "avg_orders", "avg_7d", "ratio", "baseline_mape"}


def _sel(cols) -> list:
    return [r6(c) if c in ROUNDED else F.col(c) for c in cols]


def _sql_sel(cols) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" if c in ROUNDED else
                     ('"timestamp"' if c == "timestamp" else c) for c in cols)


def _h(expr: str, k: int) -> str:
    """DuckDB: expr shifted by k hours."""
    if k == 0:
        return expr
    return f"({expr} {'+' if k > 0 else '-'} INTERVAL '{abs(k)} hours')"


_CUT = f"TIMESTAMP '{CFG.split_date:%Y-%m-%d %H:%M:%S}'"
_HIST = "hist AS (SELECT * FROM features WHERE lag_168h IS NOT NULL)"
_VALROWS = f"val AS (SELECT * FROM hist WHERE \"timestamp\" >= {_CUT})"
_MAPE = ("coalesce(avg(CASE WHEN {a} > 0 THEN abs({a} - {p}) / {a} END) * 100.0, 0.0)")
_RMSE = "sqrt(avg(power({a} - {p}, 2)))"
_MAE = "avg(abs({a} - {p}))"


def _metrics_sql(a: str, p: str) -> str:
    return (f"{_MAPE.format(a=a, p=p)} AS mape, {_RMSE.format(a=a, p=p)} AS rmse, "
            f"{_MAE.format(a=a, p=p)} AS mae, count(*) AS n_rows")


# ---- split and metrics (FLT1-FLT3, AG7-AG12, ML3-ML5, ML12) ---------------------------

@register("training_split_counts", O.with_ctes(*_FEAT, _HIST, body=f"""
SELECT count(*) FILTER (WHERE "timestamp" < {_CUT}) AS train_rows,
       count(*) FILTER (WHERE "timestamp" >= {_CUT}) AS val_rows FROM hist"""))
def q_training_split_counts(spark, sf_dir):
    """FLT1, FLT2, AG11."""
    return MET.split_counts(features(spark, sf_dir), CFG)


@register("seasonal_naive_metrics", O.with_ctes(*_FEAT, _HIST, _VALROWS, body=f"""
SELECT round(mape, 6) AS mape, round(rmse, 6) AS rmse, round(mae, 6) AS mae, n_rows
FROM (SELECT {_metrics_sql("order_count", "lag_168h")} FROM val)"""))
def q_seasonal_naive_metrics(spark, sf_dir):
    """AG7-AG10, FLT9, ML12: baseline metrics on the validation part."""
    m = MET.seasonal_naive_metrics(features(spark, sf_dir), CFG)
    return m.select(*_sel(["mape", "rmse", "mae", "n_rows"]))


@register("seasonal_naive_by_zone", O.with_ctes(*_FEAT, _HIST, _VALROWS, body=f"""
SELECT zone_id, round(mape, 6) AS mape, round(rmse, 6) AS rmse, round(mae, 6) AS mae, n_rows
FROM (SELECT zone_id, {_metrics_sql("order_count", "lag_168h")} FROM val GROUP BY zone_id)"""))
def q_seasonal_naive_by_zone(spark, sf_dir):
    """AG12: the same metrics per zone."""
    m = MET.seasonal_naive_metrics(features(spark, sf_dir), CFG, by=["zone_id"])
    return m.select("zone_id", *_sel(["mape", "rmse", "mae", "n_rows"]))


_LIN = "greatest(0.5 * lag_1h + 0.3 * lag_24h + 0.2 * lag_168h, 0.0)"


@register("promotion_decision", O.with_ctes(*_FEAT, _HIST, _VALROWS, body=f"""
SELECT round(mape, 6) AS mape, round(rmse, 6) AS rmse, round(mae, 6) AS mae, n_rows,
       round(baseline_mape, 6) AS baseline_mape, mape < baseline_mape AS promoted
FROM (SELECT {_metrics_sql("order_count", _LIN)},
             {_MAPE.format(a="order_count", p="lag_168h")} AS baseline_mape FROM val)"""))
def q_promotion_decision(spark, sf_dir):
    """ML3-ML5: candidate (linear scorer, clipped) vs seasonal naive on the
    validation part; promoted iff strictly better MAPE."""
    _, val = MET.split(features(spark, sf_dir), CFG)
    scored = FC.linear_scorer()(val).withColumn("prediction", colf.clip_at_zero("prediction"))
    out = MET.evaluate(scored, baseline="lag_168h")  # one pass, both models
    return out.select(*_sel(["mape", "rmse", "mae", "n_rows", "baseline_mape"]),
                      (F.col("mape") < F.col("baseline_mape")).alias("promoted"))


@register("quality_gate", O.with_ctes(*_FEAT, _HIST, _VALROWS, body=f"""
SELECT round(mape, 6) AS mape, n_rows, n_rows > 0 AND mape < 20.0 AS passes
FROM (SELECT {_MAPE.format(a="order_count", p=_LIN)} AS mape, count(*) AS n_rows
      FROM val WHERE order_count >= (SELECT quantile_disc(order_count, 0.9) FROM val))"""))
def q_quality_gate(spark, sf_dir):
    """FLT3 + the end-to-end gate: candidate MAPE < 20 on validation rows
    with at least a minimum of orders, and there are such rows. The original's
    minimum (15) suits its own volume; here it is the busiest tenth's."""
    feats = features(spark, sf_dir)
    least = MET.split(feats, CFG)[1].agg(
        F.expr("percentile_disc(0.9) WITHIN GROUP (ORDER BY order_count)").alias("q")).first()["q"]
    rows = MET.quality_rows(feats, replace(CFG, quality_min_orders=int(least or 0)))
    scored = FC.linear_scorer()(rows).withColumn("prediction", colf.clip_at_zero("prediction"))
    m = MET.evaluate(scored)
    return m.select(r6("mape"), "n_rows", ((F.col("n_rows") > 0) & (F.col("mape") < 20.0)).alias("passes"))


# ---- forecast (ML8-ML10, WN9, ST1, ST2, FN15, FN16) ------------------------------------

def _step_sql(src: str, s: int) -> str:
    fh = _h("t", s)
    lag = {k: f"max(n) FILTER (WHERE \"timestamp\" = {_h('t', s - k)})" for k in CFG.lag_hours}
    lag_cols = ",\n      ".join(
        f"{lag[k]} AS lag_{k}h" if k == 1 else f"coalesce({lag[k]}, {lag[1]}) AS lag_{k}h"
        for k in CFG.lag_hours)
    in3 = f"\"timestamp\" >= {_h(fh, -3)} AND \"timestamp\" < {fh}"
    in24 = f"\"timestamp\" >= {_h(fh, -24)} AND \"timestamp\" < {fh}"
    return f"""
step{s} AS (
  SELECT *, {_LIN} AS predicted_raw FROM (
    SELECT zone_id, {fh} AS forecast_hour, {s} AS step,
      {lag_cols},
      avg(n) FILTER (WHERE {in3}) AS rolling_mean_3h,
      avg(n) FILTER (WHERE {in24}) AS rolling_mean_24h,
      coalesce(stddev_samp(n) FILTER (WHERE {in3}), 0.0) AS rolling_std_3h
    FROM {src}, last_t GROUP BY zone_id, t))"""


def _forecast_sql() -> list[str]:
    peaks = ", ".join(str(h) for h in CFG.peak_hours)
    fest = ", ".join(f"DATE '{d.isoformat()}'" for d in CFG.festival_dates)
    parts = [
        'last_t AS (SELECT max("timestamp") AS t FROM features)',
        f"""series0 AS (SELECT zone_id, "timestamp", CAST(order_count AS DOUBLE) AS n
  FROM features, last_t WHERE "timestamp" > {_h("t", -(max(max(CFG.lag_hours), 24) + CFG.horizon))})""",
    ]
    src = "series0"
    for s in range(1, CFG.horizon + 1):
        parts.append(_step_sql(src, s).strip("\n"))
        parts.append(f"""series{s} AS (SELECT * FROM {src} UNION ALL
  SELECT zone_id, forecast_hour AS "timestamp", predicted_raw AS n FROM step{s})""")
        src = f"series{s}"
    union = " UNION ALL ".join(f"SELECT * FROM step{s}" for s in range(1, CFG.horizon + 1))
    parts.append(f"""forecast AS (
  SELECT zone_id, forecast_hour, step,
    CAST(hour(forecast_hour) AS INTEGER) AS hour_of_day,
    CAST(isodow(forecast_hour) - 1 AS INTEGER) AS day_of_week,
    isodow(forecast_hour) >= 6 AS is_weekend,
    CAST(month(forecast_hour) AS INTEGER) AS month,
    CAST(week(forecast_hour) AS INTEGER) AS week_of_year,
    lag_1h, lag_2h, lag_24h, lag_168h, rolling_mean_3h, rolling_mean_24h, rolling_std_3h,
    CAST(forecast_hour AS DATE) IN ({fest}) AS is_festival_day,
    0 AS weather_rainy,
    CAST(hour(forecast_hour) IN ({peaks}) AS INTEGER) AS is_peak_hour,
    {O._zone_case("zone_id", CFG)} AS zone_id_encoded,
    predicted_raw, round(predicted_raw, 2) AS predicted_order_count
  FROM ({union}))""")
    return parts


_FORECAST = _FEAT + tuple(_forecast_sql())
FORECAST_OUT = ("zone_id", "forecast_hour", "step", *FEATURE_COLUMNS, "predicted_order_count")


def linear_forecast(spark, sf_dir):
    return FC.forecast(features(spark, sf_dir), FC.linear_scorer(), CFG)


@register("forecast_linear", O.with_ctes(*_FORECAST, body=f"""
SELECT {_sql_sel(FORECAST_OUT)} FROM forecast"""))
def q_forecast_linear(spark, sf_dir):
    """ML8-ML10, WN9, ST1, ST2, FN15, FN16: two recursive steps for all
    zones with a linear scorer; step 2 sees step 1's unrounded value."""
    return linear_forecast(spark, sf_dir).select(*_sel(FORECAST_OUT))


# ---- monitoring (AG5, AG6, FLT5, FLT6, JN4, JN6, JN9, ML7, ML11, SNK6) -----------------

_AVG7 = """avg7 AS (
  SELECT zone_id, avg(order_count) AS avg_orders FROM features
  WHERE "timestamp" >= (SELECT max("timestamp") FROM features) - INTERVAL 7 DAY
  GROUP BY zone_id)"""


@register("seven_day_avg", O.with_ctes(*_FEAT, _AVG7, body="""
SELECT zone_id, round(avg_orders, 6) AS avg_orders FROM avg7"""))
def q_seven_day_avg(spark, sf_dir):
    """FLT5, AG5."""
    return MON.seven_day_avg(features(spark, sf_dir)).select("zone_id", r6("avg_orders"))


_ACTUAL = """actual AS (
  SELECT zone_id, date_trunc('hour', "timestamp") AS hour_timestamp, count(*) AS order_count
  FROM clean GROUP BY 1, 2)"""


@register("actual_hourly", O.with_ctes(*_FEAT[:2], _ACTUAL, body="SELECT * FROM actual"))
def q_actual_hourly(spark, sf_dir):
    """AG6: orders per zone and hour."""
    return MON.actual_hourly(clean(spark, sf_dir))


_BACKTEST = f"""backtest AS (
  SELECT zone_id, "timestamp" + INTERVAL '{max(CFG.lag_hours)} hours' AS forecast_hour,
         round(CAST(order_count AS DOUBLE), 2) AS predicted_order_count,
         'NORMAL' AS confidence_flag,
         "timestamp" + INTERVAL '{max(CFG.lag_hours)} hours' - to_hours(s.step) AS generated_at,
         CAST(s.step AS INTEGER) AS step
  FROM features, (SELECT unnest(range(1, {CFG.horizon + 1})) AS step) s
  WHERE "timestamp" + INTERVAL '{max(CFG.lag_hours)} hours' - to_hours(s.step)
        <= (SELECT max("timestamp") FROM features))"""
BACKTEST_COLS = ("zone_id", "forecast_hour", "predicted_order_count", "confidence_flag",
                 "generated_at", "step")


def backtest(spark, sf_dir):
    return FC.backtest_predictions(features(spark, sf_dir), CFG)


@register("backtest_predictions", O.with_ctes(*_FEAT, _BACKTEST, body=f"""
SELECT {", ".join(BACKTEST_COLS)} FROM backtest"""))
def q_backtest_predictions(spark, sf_dir):
    """The predictions log (SNK4 rows of every hourly run) replayed with the
    seasonal-naive scorer; input of the drift and report queries."""
    return backtest(spark, sf_dir).select(*BACKTEST_COLS)


_PAIRS = """pairs AS (
  SELECT p.zone_id, p.forecast_hour, p.predicted_order_count, a.order_count AS actual_order_count
  FROM backtest p JOIN actual a
    ON p.zone_id = a.zone_id AND p.forecast_hour = a.hour_timestamp
  WHERE p.forecast_hour >= (SELECT max("timestamp") FROM features) - INTERVAL '24 hours')"""


def _as_of(spark, sf_dir):
    return features(spark, sf_dir).agg(F.max("timestamp")).scalar()


def pairs(spark, sf_dir):
    return MON.drift_pairs(backtest(spark, sf_dir), clean(spark, sf_dir),
                           _as_of(spark, sf_dir), CFG)


@register("drift_pairs", O.with_ctes(*_FEAT, _BACKTEST, _ACTUAL, _PAIRS, body="""
SELECT zone_id, forecast_hour, predicted_order_count, actual_order_count FROM pairs"""))
def q_drift_pairs(spark, sf_dir):
    """JN4, FLT6: predictions of the last 24 h (as of the last hour) with actuals."""
    return pairs(spark, sf_dir)


@register("drift_decision", O.with_ctes(*_FEAT, _BACKTEST, _ACTUAL, _PAIRS, body=f"""
SELECT n_pairs, round(mape, 6) AS mape,
       reason LIKE 'Triggered%' AS trigger, reason
FROM (SELECT n_pairs, mape,
        CASE WHEN n_pairs < {CFG.drift_min_pairs} THEN 'Triggered: Low prediction history'
             WHEN mape > {CFG.drift_mape_threshold}
               THEN 'Triggered: MAPE is ' || printf('%.2f', mape) || '% (> {CFG.drift_mape_threshold:g}%)'
             ELSE 'Triggered: Scheduled Daily Retrain' END AS reason
      FROM (SELECT count(*) AS n_pairs,
                   {_MAPE.format(a="actual_order_count", p="predicted_order_count")} AS mape
            FROM pairs))"""))
def q_drift_decision(spark, sf_dir):
    """ML7, AG7: retrain trigger and its reason."""
    d = MON.drift_decision(pairs(spark, sf_dir), CFG)
    return d.select("n_pairs", r6("mape"), "trigger", "reason")


def _msg_sql(p: str, a: str) -> str:
    return (f"'Predicted demand ' || printf('%.1f', {p}) || ' is ' || "
            f"coalesce(printf('%.1f', {p} / nullif({a}, 0)), 'n/a') || "
            f"'x higher than 7-day average (' || printf('%.1f', {a}) || ')'")


# Two linear forecasts seldom exceed 1.5 x the week's mean; 0.9 x gives the
# registered queries rows on both sides of the rule.
ALERT_CFG = replace(CFG, high_demand_factor=0.9)

_ALERTS = f"""latest_fc AS (SELECT zone_id, forecast_hour, predicted_order_count FROM forecast),
alerts_now AS (
  SELECT zone_id, forecast_hour, predicted_order_count, avg_7d,
         predicted_order_count / nullif(avg_7d, 0) AS ratio, 'HIGH_DEMAND' AS alert_type,
         {_msg_sql("predicted_order_count", "avg_7d")} AS message
  FROM (SELECT f.*, coalesce(a.avg_orders, {CFG.fallback_avg}) AS avg_7d
        FROM latest_fc f LEFT JOIN avg7 a ON f.zone_id = a.zone_id)
  WHERE predicted_order_count > avg_7d * {ALERT_CFG.high_demand_factor})"""
ALERT_COLS = ("zone_id", "forecast_hour", "predicted_order_count", "avg_7d", "ratio",
              "alert_type", "message")


def alerts_now(spark, sf_dir):
    preds = linear_forecast(spark, sf_dir).select(
        "zone_id", "forecast_hour", "predicted_order_count")
    return MON.high_demand(preds, MON.seven_day_avg(features(spark, sf_dir)), ALERT_CFG)


@register("high_demand_alerts", O.with_ctes(*_FORECAST, _AVG7, _ALERTS, body=f"""
SELECT {_sql_sel(ALERT_COLS)} FROM alerts_now"""))
def q_high_demand_alerts(spark, sf_dir):
    """ML11, JN6, FN18: forecasts above a factor of the zone's 7-day average."""
    return alerts_now(spark, sf_dir).select(*_sel(ALERT_COLS))


_BT_ALERTS = f"""bt_latest AS (
  SELECT * FROM backtest WHERE generated_at = (SELECT max(generated_at) FROM backtest)),
bt_alerts AS (
  SELECT DISTINCT l.zone_id, l.forecast_hour FROM bt_latest l LEFT JOIN avg7 a USING (zone_id)
  WHERE l.predicted_order_count > coalesce(a.avg_orders, {CFG.fallback_avg}) * {CFG.high_demand_factor})"""


@register("flagged_predictions", O.with_ctes(*_FEAT, _BACKTEST, _AVG7, _BT_ALERTS, body="""
SELECT b.zone_id, b.forecast_hour, b.predicted_order_count,
       CASE WHEN x.zone_id IS NOT NULL THEN 'HIGH_DEMAND' ELSE b.confidence_flag END
         AS confidence_flag,
       b.generated_at, b.step
FROM backtest b LEFT JOIN bt_alerts x
  ON b.zone_id = x.zone_id AND b.forecast_hour = x.forecast_hour"""))
def q_flagged_predictions(spark, sf_dir):
    """SNK6, JN9: alerts of the newest batch flag every stored row with the
    same zone and hour, older batches included (T21)."""
    from zonecast.operators.reports import latest_batch  # noqa: PLC0415
    bt = backtest(spark, sf_dir)
    latest = latest_batch(bt)
    alerts = MON.high_demand(latest, MON.seven_day_avg(features(spark, sf_dir)), CFG)
    return MON.flag_predictions(bt, alerts).select(*BACKTEST_COLS)
