"""Registered queries: reports (RP1-RP7) and exploratory aggregates (AG13-AG18)."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonecast.config import DAG_NAMES
from zonecast.operators import explore as EX
from zonecast.operators import monitor as MON
from zonecast.operators import reports as RP
from zonecast.plans import oracle as O
from zonecast.plans.catalog import CFG, _FEAT, _VAL, clean, r6, raw, register
from zonecast.plans.catalog import features
from zonecast.plans.catalog_jobs import _WM, _at, operated_store
from zonecast.plans.catalog_model import (_AVG7, _BACKTEST, _LIN, _MAPE, _RMSE, _MAE,
                                          _msg_sql, backtest)

_NZ = len(CFG.zones)


def _hours_between_sql(a: str, b: str) -> str:
    return f"CAST((epoch({a}) - epoch({b})) / 3600 AS BIGINT)"


# ---- predictions log reports (RP1, RP2, AG20, TK7, TK8, FLT4, FLT7, JN5, FN17) --------

_LATEST = """latest AS (
  SELECT zone_id, forecast_hour, predicted_order_count, confidence_flag, generated_at
  FROM backtest WHERE generated_at = (SELECT max(generated_at) FROM backtest))"""


@register("latest_batch", O.with_ctes(*_FEAT, _BACKTEST, _LATEST, body="""
SELECT *, strftime(generated_at, '%Y-%m-%d %H:%M:%S') AS last_updated
FROM latest ORDER BY zone_id, forecast_hour"""))
def q_latest_batch(spark, sf_dir):
    """RP1, FLT4, TK8, FN21: the newest prediction batch by zone and hour."""
    return RP.latest_batch(backtest(spark, sf_dir))


@register("forecast_hours", O.with_ctes(*_FEAT, _BACKTEST, _LATEST, body="""
SELECT DISTINCT forecast_hour FROM latest ORDER BY forecast_hour LIMIT 2"""))
def q_forecast_hours(spark, sf_dir):
    """AG20, TK7: the two earliest forecast hours of the newest batch."""
    return RP.forecast_hours(backtest(spark, sf_dir), 2)


@register("demand_status", O.with_ctes(*_FEAT, _BACKTEST, _LATEST, _AVG7, body=f"""
SELECT l.zone_id, l.forecast_hour, l.predicted_order_count,
       round(a.avg_orders, 6) AS avg_orders,
       round(coalesce(a.avg_orders, {CFG.fallback_avg}), 6) AS avg_used,
       CASE WHEN l.predicted_order_count > coalesce(a.avg_orders, {CFG.fallback_avg}) * {CFG.high_demand_factor}
              THEN 'High Demand (Red)'
            WHEN l.predicted_order_count > coalesce(a.avg_orders, {CFG.fallback_avg}) * {CFG.amber_factor}
              THEN 'Elevated (Amber)'
            ELSE 'Normal (Green)' END AS status
FROM latest l LEFT JOIN avg7 a ON l.zone_id = a.zone_id
WHERE l.forecast_hour = (SELECT min(forecast_hour) FROM latest)"""))
def q_demand_status(spark, sf_dir):
    """RP2, FLT7, JN5, FN17: first forecast hour vs the 7-day zone average."""
    out = RP.demand_status(backtest(spark, sf_dir), MON.seven_day_avg(features(spark, sf_dir)),
                           CFG)
    return out.select("zone_id", "forecast_hour", "predicted_order_count",
                      r6("avg_orders"), r6("avg_used"), "status")


# ---- alerts log (RP3, TK3) ----------------------------------------------------------------

_ALERT_LOG = f"""week_avg AS (
  SELECT zone_id, "timestamp" AS generated_at,
         avg(order_count) OVER (PARTITION BY zone_id ORDER BY "timestamp"
                                RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW) AS avg_orders
  FROM features),
alert_log AS (
  SELECT zone_id, forecast_hour, 'HIGH_DEMAND' AS alert_type,
         {_msg_sql("predicted_order_count", "a")} AS message,
         generated_at + INTERVAL 30 MINUTE AS created_at
  FROM (SELECT b.*, coalesce(w.avg_orders, {CFG.fallback_avg}) AS a
        FROM backtest b LEFT JOIN week_avg w
          ON b.zone_id = w.zone_id AND b.generated_at = w.generated_at)
  WHERE predicted_order_count > a * {CFG.high_demand_factor})"""


def alert_log(spark, sf_dir):
    return RP.alert_history(backtest(spark, sf_dir), features(spark, sf_dir), CFG)


@register("alert_log", O.with_ctes(*_FEAT, _BACKTEST, _ALERT_LOG, body="""
SELECT zone_id, forecast_hour, alert_type, message, created_at FROM alert_log"""))
def q_alert_log(spark, sf_dir):
    """ML11 per hourly batch (7-day average as of the batch, RANGE frame),
    FN18 messages: the alerts log (SNK5 rows)."""
    return alert_log(spark, sf_dir)


@register("recent_alerts", O.with_ctes(*_FEAT, _BACKTEST, _ALERT_LOG, body="""
SELECT zone_id, message, created_at FROM alert_log
ORDER BY created_at DESC, zone_id, message LIMIT 5"""))
def q_recent_alerts(spark, sf_dir):
    """RP3, TK3: five newest alerts."""
    return RP.recent_alerts(alert_log(spark, sf_dir), 5)


# ---- model runs log (RP4, TK5, TK6, FN19, FN20, ML5) ---------------------------------------

_RUNS = f"""hist AS (SELECT * FROM features WHERE lag_168h IS NOT NULL),
daily AS (
  SELECT CAST("timestamp" AS DATE) AS day,
         {_MAPE.format(a="order_count", p=_LIN)} AS mape,
         {_RMSE.format(a="order_count", p=_LIN)} AS rmse,
         {_MAE.format(a="order_count", p=_LIN)} AS mae,
         count(*) AS n_rows,
         {_MAPE.format(a="order_count", p="lag_168h")} AS baseline_mape
  FROM hist GROUP BY 1),
model_runs AS (
  SELECT 'run_' || strftime(day, '%Y%m%d') AS run_id,
         CAST(day AS TIMESTAMP) + INTERVAL 26 HOUR AS "timestamp",
         CAST(greatest({_hours_between_sql("CAST(day AS TIMESTAMP)", "(SELECT min(\"timestamp\") FROM hist)")}, 0) * {_NZ} AS INTEGER) AS train_rows,
         CAST(n_rows AS INTEGER) AS val_rows, mape, rmse, mae,
         'models/run_' || strftime(day, '%Y%m%d') AS model_path,
         mape < baseline_mape AS promoted, baseline_mape
  FROM daily)"""

RUN_COLS = ("run_id", "timestamp", "train_rows", "val_rows", "mape", "rmse", "mae",
            "model_path", "promoted", "baseline_mape")


def model_runs(spark, sf_dir):
    return RP.model_run_history(features(spark, sf_dir), CFG)


def _r(cols, rounded=("mape", "rmse", "mae", "baseline_mape", "mape_delta")):
    return [r6(c) if c in rounded else F.col(c) for c in cols]


def _rs(cols, rounded=("mape", "rmse", "mae", "baseline_mape", "mape_delta")):
    return ", ".join(f"round({c}, 6) AS {c}" if c in rounded else
                     ('"timestamp"' if c == "timestamp" else c) for c in cols)


@register("model_runs_log", O.with_ctes(*_FEAT, _RUNS, body=f"""
SELECT {_rs(RUN_COLS)} FROM model_runs"""))
def q_model_runs_log(spark, sf_dir):
    """ML3-ML5 replayed daily: candidate vs seasonal naive, promotion (SNK7 rows)."""
    return model_runs(spark, sf_dir).select(*_r(RUN_COLS))


REPORT_COLS = ("run_id", "timestamp", "train_rows", "val_rows", "mape", "rmse", "mae",
               "promoted", "baseline_mape", "mape_delta")


@register("model_runs_report", O.with_ctes(*_FEAT, _RUNS, body=f"""
SELECT {_rs(REPORT_COLS)} FROM (
  SELECT run_id, "timestamp", train_rows, val_rows, mape, rmse, mae, promoted,
         coalesce(baseline_mape, {CFG.fallback_baseline_mape}) AS baseline_mape,
         mape - coalesce(baseline_mape, {CFG.fallback_baseline_mape}) AS mape_delta
  FROM model_runs ORDER BY "timestamp" DESC, run_id DESC LIMIT 10)"""))
def q_model_runs_report(spark, sf_dir):
    """RP4, TK5, FN19, FN20: ten newest runs, defaulted baseline and delta."""
    return RP.model_runs_report(model_runs(spark, sf_dir), CFG, 10).select(*_r(REPORT_COLS))


@register("model_trend", O.with_ctes(*_FEAT, _RUNS, body="""
SELECT "timestamp", round(mape, 6) AS mape, round(rmse, 6) AS rmse, round(mae, 6) AS mae
FROM model_runs ORDER BY "timestamp\""""))
def q_model_trend(spark, sf_dir):
    """TK6: training history oldest first."""
    return RP.model_trend(model_runs(spark, sf_dir)).select(
        "timestamp", *_r(["mape", "rmse", "mae"]))


# ---- pipeline runs log (RP5-RP7, WN8, FLT8, TK4, SNK8-SNK10) --------------------------------

def _run_sql(dag: int, minutes: int, rows: str, status: str = "SUCCESS") -> str:
    return (f"SELECT '{DAG_NAMES[dag]}' AS dag_name, TIMESTAMP '{_at(minutes):%Y-%m-%d %H:%M:%S}' AS run_time, "
            f"'{status}' AS status, CAST({rows} AS INTEGER) AS rows_processed")


def _grid_sql(where: str) -> str:
    return (f"(SELECT ({_hours_between_sql('max(h)', 'min(h)')} + 1) * {_NZ} FROM "
            f"(SELECT date_trunc('hour', \"timestamp\") AS h FROM clean WHERE {where}))")


_EARLY = f"\"timestamp\" <= {_WM}"
_PRUNS = "pipeline_runs AS (" + " UNION ALL ".join((
    _run_sql(3, 0, "0", "FAILED"),
    _run_sql(0, 10, f"(SELECT count(*) FROM clean WHERE {_EARLY})"),
    _run_sql(1, 20, _grid_sql(_EARLY)), _run_sql(3, 30, f"{_NZ * CFG.horizon}"),
    _run_sql(0, 40, f"(SELECT count(*) FROM clean WHERE NOT {_EARLY})"),
    _run_sql(0, 50, "0"), _run_sql(1, 60, _grid_sql("true")),
    _run_sql(3, 70, f"{_NZ * CFG.horizon}"), _run_sql(3, 70, f"{_NZ * CFG.horizon}"),
    _run_sql(3, 90, "0", "FAILED"))) + """),
latest_runs AS (
  SELECT dag_name, run_time, status, rows_processed FROM (
    SELECT *, row_number() OVER (PARTITION BY dag_name ORDER BY run_time DESC, status DESC) AS rn
    FROM pipeline_runs) WHERE rn = 1)"""
_PR = _VAL + (_PRUNS,)


def pipeline_runs(spark, sf_dir):
    return operated_store(spark, sf_dir).read_table("pipeline_runs").drop("run_id")


@register("job_runs_log", O.with_ctes(*_PR, body="SELECT *, true AS has_id FROM pipeline_runs"))
def q_job_runs_log(spark, sf_dir):
    """SNK8-SNK10: what the jobs logged: rows, an empty ingest, failures."""
    runs = operated_store(spark, sf_dir).read_table("pipeline_runs")
    return runs.withColumn("has_id", F.col("run_id").isNotNull()).drop("run_id")


@register("latest_runs", O.with_ctes(*_PR, body="SELECT * FROM latest_runs"))
def q_latest_runs(spark, sf_dir):
    """WN8 (DISTINCT ON): newest run per DAG."""
    return RP.latest_runs(pipeline_runs(spark, sf_dir))


_DAGS = ", ".join(f"('{n}', {i})" for i, n in enumerate(DAG_NAMES))


@register("dag_status", O.with_ctes(*_PR, body=f"""
SELECT CAST(d.display_order AS INTEGER) AS display_order, d.dag_name, l.run_time,
       coalesce(l.status, 'NO RUNS') AS status, coalesce(l.rows_processed, 0) AS rows_processed
FROM (VALUES {_DAGS}) d(dag_name, display_order)
LEFT JOIN latest_runs l ON d.dag_name = l.dag_name ORDER BY display_order"""))
def q_dag_status(spark, sf_dir):
    """RP5: latest status per DAG in display order, NO RUNS when missing."""
    return RP.dag_status(pipeline_runs(spark, sf_dir))


@register("failed_runs", O.with_ctes(*_PR, body="""
SELECT count(*) AS n_failed,
       coalesce(string_agg(dag_name, ', ' ORDER BY dag_name), '') AS failed_dags,
       count(*) = 0 AS all_clear
FROM latest_runs WHERE status = 'FAILED'"""))
def q_failed_runs(spark, sf_dir):
    """RP6, FLT8: DAGs whose latest run failed, or all clear."""
    return RP.failed_runs(pipeline_runs(spark, sf_dir))


@register("run_log", O.with_ctes(*_PR, body="""
SELECT dag_name, run_time, status, rows_processed FROM pipeline_runs
ORDER BY run_time DESC, dag_name LIMIT 20"""))
def q_run_log(spark, sf_dir):
    """RP7, TK4: twenty newest runs."""
    return RP.run_log(pipeline_runs(spark, sf_dir), 20)


# ---- exploratory aggregates (AG13-AG18, FN7) -----------------------------------------------

@register("eda_hour_weekend", O.with_ctes(*_VAL, body="""
SELECT CAST(hour("timestamp") AS INTEGER) AS hour, is_weekend, count(*) AS order_count
FROM clean WHERE is_weekend IS NOT NULL GROUP BY 1, 2"""))
def q_eda_hour_weekend(spark, sf_dir):
    """AG13."""
    return EX.orders_by_hour_weekend(clean(spark, sf_dir))


@register("eda_zone_counts", O.with_ctes(*_VAL, body="""
SELECT zone_id, count(*) AS order_count FROM clean WHERE zone_id IS NOT NULL
GROUP BY zone_id ORDER BY order_count DESC, zone_id"""))
def q_eda_zone_counts(spark, sf_dir):
    """AG14."""
    return EX.orders_by_zone(clean(spark, sf_dir))


@register("eda_day_name", O.with_ctes(*_VAL, body="""
SELECT dayname("timestamp") AS day_name, count(*) AS order_count FROM clean GROUP BY 1"""))
def q_eda_day_name(spark, sf_dir):
    """FN7."""
    return EX.orders_by_day_name(clean(spark, sf_dir))


_COND = """cond AS (
  SELECT date_trunc('hour', "timestamp") AS hour_timestamp, weather_condition, is_festival_day,
         count(*) AS order_count
  FROM clean WHERE weather_condition IS NOT NULL AND is_festival_day IS NOT NULL
  GROUP BY 1, 2, 3)"""


@register("eda_hourly_conditions", O.with_ctes(*_VAL, _COND, body="SELECT * FROM cond"))
def q_eda_hourly_conditions(spark, sf_dir):
    """AG15."""
    return EX.hourly_conditions(clean(spark, sf_dir))


@register("eda_weather_avg", O.with_ctes(*_VAL, _COND, body="""
SELECT weather_condition, round(avg(order_count), 6) AS avg_hourly_orders FROM cond GROUP BY 1"""))
def q_eda_weather_avg(spark, sf_dir):
    """AG16."""
    return EX.weather_avg(clean(spark, sf_dir)).select(
        "weather_condition", r6("avg_hourly_orders"))


@register("eda_festival_avg", O.with_ctes(*_VAL, _COND, body="""
SELECT is_festival_day, round(avg(order_count), 6) AS avg_hourly_orders FROM cond GROUP BY 1"""))
def q_eda_festival_avg(spark, sf_dir):
    """AG17."""
    return EX.festival_avg(clean(spark, sf_dir)).select(
        "is_festival_day", r6("avg_hourly_orders"))


@register("dataset_summary", O.with_ctes(O.raw_cte(CFG), body="""
SELECT count(*) AS total_rows, min("timestamp") AS min_timestamp, max("timestamp") AS max_timestamp,
       round(avg(order_value), 6) AS avg_order_value, round(avg(items_count), 6) AS avg_items_count,
       round(avg(delivery_time_mins), 6) AS avg_delivery_time_mins FROM raw"""))
def q_dataset_summary(spark, sf_dir):
    """AG18: summary statistics of the raw order set."""
    return EX.dataset_summary(raw(spark, sf_dir)).select(
        "total_rows", "min_timestamp", "max_timestamp", r6("avg_order_value"),
        r6("avg_items_count"), r6("avg_delivery_time_mins"))


@register("dataset_zone_counts", O.with_ctes(O.raw_cte(CFG), body="""
SELECT zone_id, count(*) AS order_count FROM raw WHERE zone_id IS NOT NULL GROUP BY 1"""))
def q_dataset_zone_counts(spark, sf_dir):
    """AG18 (orders per zone of the raw set, invalid labels included)."""
    return EX.orders_per_zone_summary(raw(spark, sf_dir))
