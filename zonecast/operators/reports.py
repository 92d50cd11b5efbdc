"""Dashboard data: RP1-RP7 and the logs they read.

FLT4, FLT7, FLT8, TK3-TK8, WN8, AG20, JN5, FN17, FN19-FN21.

The reports read four append-only logs (predictions, alerts, model_runs,
pipeline_runs). The jobs in ``zonecast.plans.jobs`` write them; the run-log
reports read what the jobs wrote. Daily model evaluations and per-batch
alerts are also computed from the feature table on the original schedule
(``*_history`` below), so those reports grow with the data.
Every top-k has a tie-breaker (the original has none).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonecast.config import ALERT_TYPE_HIGH_DEMAND, DAG_NAMES, NO_RUNS, RUN_FAILED, Config
from zonecast.functions import calendar as cal
from zonecast.functions import columns as colf
from zonecast.operators import metrics as MET
from zonecast.operators.forecast import linear_scorer


# ---- replayed logs -----------------------------------------------------------------

def rolling_week_avg(features: DataFrame) -> DataFrame:
    """7-day zone average as of every hour (RANGE frame, both ends included)."""
    secs = F.unix_seconds(F.col("timestamp").cast("timestamp"))
    w = Window.partitionBy("zone_id").orderBy(secs).rangeBetween(-7 * 24 * 3600, 0)
    return features.select("zone_id", F.col("timestamp").alias("generated_at"),
                           F.avg("order_count").over(w).alias("avg_orders"))


def alert_history(predictions: DataFrame, features: DataFrame, cfg: Config) -> DataFrame:
    """The alerts log: each batch's predictions against the 7-day average
    as of the batch hour (ML11 per batch); created 30 minutes after it."""
    avg = rolling_week_avg(features)
    j = predictions.join(avg, ["zone_id", "generated_at"], "left")
    a = F.coalesce(F.col("avg_orders"), F.lit(cfg.fallback_avg))
    return (j.where(F.col("predicted_order_count") > a * cfg.high_demand_factor)
            .select("zone_id", "forecast_hour",
                    F.lit(ALERT_TYPE_HIGH_DEMAND).alias("alert_type"),
                    colf.alert_message("predicted_order_count", a).alias("message"),
                    (F.col("generated_at") + F.expr("INTERVAL 30 MINUTES")).alias("created_at")))


def _hours_between(a: Column, b: Column) -> Column:
    return ((F.unix_seconds(a.cast("timestamp")) - F.unix_seconds(b.cast("timestamp")))
            / 3600).cast("long")


def model_run_history(features: DataFrame, cfg: Config, scorer=None) -> DataFrame:
    """The model_runs log replayed as daily runs (ML3-ML5 per day).

    Run for day d at d+1 02:00: the candidate scorer (clipped at 0, ML3)
    and the seasonal-naive baseline are evaluated on day d's rows with
    history (ML4, AG10); promoted iff candidate MAPE < baseline MAPE
    (strict, ML5); train_rows = rows with history before d, which on the
    dense grid is zones x hours since the first hour with history.
    """
    scorer = scorer or linear_scorer()
    hist = MET.with_history(features)
    first = hist.agg(F.min("timestamp")).scalar()
    scored = scorer(hist.withColumn("day", F.to_date("timestamp"))).withColumn(
        "prediction", colf.clip_at_zero("prediction"))
    daily = MET.evaluate(scored, by=["day"], baseline="lag_168h")
    start = F.col("day").cast("timestamp_ntz")
    train_rows = F.greatest(_hours_between(start, first), F.lit(0)) * len(cfg.zones)
    stamp = F.date_format("day", "yyyyMMdd")
    return daily.select(
        F.concat(F.lit("run_"), stamp).alias("run_id"),
        (start + F.expr("INTERVAL 26 HOURS")).alias("timestamp"),
        train_rows.cast("int").alias("train_rows"),
        F.col("n_rows").cast("int").alias("val_rows"),
        "mape", "rmse", "mae",
        F.concat(F.lit("models/run_"), stamp).alias("model_path"),
        (F.col("mape") < F.col("baseline_mape")).alias("promoted"),
        "baseline_mape")


# ---- reports -----------------------------------------------------------------------

def latest_batch(predictions: DataFrame) -> DataFrame:
    """RP1 / FLT4 / TK8: rows of the newest batch, by zone and hour."""
    newest = predictions.agg(F.max("generated_at")).scalar()
    return (predictions.where(F.col("generated_at") == newest)
            .select("zone_id", "forecast_hour", "predicted_order_count",
                    "confidence_flag", "generated_at",
                    cal.to_text("generated_at").alias("last_updated"))  # FN21
            .orderBy("zone_id", "forecast_hour"))


def forecast_hours(predictions: DataFrame, k: int = 2) -> DataFrame:
    """AG20 / TK7: the k earliest distinct forecast hours of the newest batch."""
    newest = predictions.agg(F.max("generated_at")).scalar()
    return (predictions.where(F.col("generated_at") == newest).select("forecast_hour").distinct()
            .orderBy("forecast_hour").limit(k))


def demand_status(predictions: DataFrame, averages: DataFrame, cfg: Config,
                  hour_rank: int = 1) -> DataFrame:
    """RP2 / FLT7 / JN5 / FN17: one forecast hour of the newest batch with
    the zone's 7-day average and a three-tier status (T30: both the raw
    average and the defaulted one are exposed)."""
    batch = latest_batch(predictions).drop("last_updated")
    hours = forecast_hours(predictions, hour_rank)
    chosen = hours.agg(F.max("forecast_hour")).scalar()
    sel = batch.where(F.col("forecast_hour") == chosen)
    j = sel.join(averages, "zone_id", "left")
    return j.select(
        "zone_id", "forecast_hour", "predicted_order_count", "avg_orders",
        F.coalesce("avg_orders", F.lit(cfg.fallback_avg)).alias("avg_used"),
        colf.demand_status("predicted_order_count", "avg_orders", cfg).alias("status"))


def recent_alerts(alerts: DataFrame, k: int = 5) -> DataFrame:
    """RP3 / TK3."""
    return (alerts.select("zone_id", "message", "created_at")
            .orderBy(F.desc("created_at"), "zone_id", "message").limit(k))


def model_runs_report(runs: DataFrame, cfg: Config, k: int | None = 10) -> DataFrame:
    """RP4 / TK5 / FN19 / FN20: newest first with defaulted baseline and delta."""
    out = runs.select(
        "run_id", "timestamp", "train_rows", "val_rows", "mape", "rmse", "mae", "promoted",
        colf.baseline_or_default("baseline_mape", cfg).alias("baseline_mape"))
    out = out.withColumn("mape_delta", colf.metric_delta("mape", "baseline_mape"))
    out = out.orderBy(F.desc("timestamp"), F.desc("run_id"))
    return out.limit(k) if k else out


def model_trend(runs: DataFrame) -> DataFrame:
    """TK6: training history oldest first."""
    return runs.select("timestamp", "mape", "rmse", "mae").orderBy("timestamp")


def latest_runs(runs: DataFrame) -> DataFrame:
    """WN8 (DISTINCT ON): newest run per DAG, via row_number = 1."""
    w = Window.partitionBy("dag_name").orderBy(F.desc("run_time"), F.desc("status"))
    return (runs.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
            .select("dag_name", "run_time", "status", "rows_processed"))


def dag_status(runs: DataFrame, dag_names=DAG_NAMES) -> DataFrame:
    """RP5: latest status for each known DAG, in display order; NO RUNS if none."""
    spark = runs.sparkSession
    names = spark.createDataFrame([(n, i) for i, n in enumerate(dag_names)],
                                  "dag_name string, display_order int")
    j = names.join(latest_runs(runs), "dag_name", "left")
    return j.select("display_order", "dag_name", "run_time",
                    F.coalesce("status", F.lit(NO_RUNS)).alias("status"),
                    F.coalesce("rows_processed", F.lit(0)).alias("rows_processed")).orderBy("display_order")


def failed_runs(runs: DataFrame) -> DataFrame:
    """RP6 / FLT8: one row: how many DAGs' latest run failed, which, all clear."""
    latest = latest_runs(runs)
    failed = latest.where(F.col("status") == RUN_FAILED)
    return failed.agg(
        F.count(F.lit(1)).alias("n_failed"),
        F.array_join(F.sort_array(F.collect_list("dag_name")), ", ").alias("failed_dags"),
    ).withColumn("all_clear", F.col("n_failed") == 0)


def run_log(runs: DataFrame, k: int = 20) -> DataFrame:
    """RP7 / TK4: the k newest runs."""
    return (runs.select("dag_name", "run_time", "status", "rows_processed")
            .orderBy(F.desc("run_time"), "dag_name").limit(k))
