"""Monitoring: actual counts, drift trigger, 7-day averages, alerts, flags.

AG5, AG6, FLT5, FLT6, JN4, JN6, JN9, ML7, ML11, SNK6, FN18.
The per-prediction look-up of the original (one SQL query per row) is one
aggregate over the last week joined to the predictions by zone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.config import (ALERT_TYPE_HIGH_DEMAND, FLAG_HIGH_DEMAND, TRIGGER_ERROR,
                             TRIGGER_LOW_HISTORY, TRIGGER_MAPE, TRIGGER_NO_MODEL,
                             TRIGGER_SCHEDULED, Config)
from zonecast.functions import calendar as cal
from zonecast.functions import columns as colf
from zonecast.functions import metrics as M
from zonecast.sources.schemas import TIME_INDEX


def _lit_ts(t) -> Column:
    return t if isinstance(t, Column) else F.lit(t).cast("timestamp_ntz")


def actual_hourly(clean: DataFrame) -> DataFrame:
    """AG6: orders per zone and hour (only hours that had orders)."""
    return (clean.groupBy("zone_id", cal.floor_hour("timestamp").alias("hour_timestamp"))
            .agg(F.count(F.lit(1)).alias("order_count")))


def drift_pairs(predictions: DataFrame, clean: DataFrame, as_of: Column | dt.datetime,
                cfg: Config) -> DataFrame:
    """JN4 + FLT6: predictions of the last look-back window paired with actuals.

    Inner join: hours without orders drop out; every horizon and re-run of
    an hour counts (T25). The predictions side is filtered before the join.
    """
    since = cal.hours_before(_lit_ts(as_of), cfg.drift_lookback_hours)
    p = predictions.where(F.col("forecast_hour") >= since)
    if cfg.date_partition_col in clean.columns:  # read the window's partitions only
        clean = clean.where(F.col(cfg.date_partition_col) >= F.to_date(since))
    if TIME_INDEX in clean.columns:  # and of those only the row groups of its hours
        clean = clean.where(F.col(TIME_INDEX) >= F.unix_micros(since.cast("timestamp")))
    a = actual_hourly(clean.where(F.col("timestamp") >= since))
    return (p.join(a, (p.zone_id == a.zone_id) & (p.forecast_hour == a.hour_timestamp))
            .select(p.zone_id, p.forecast_hour, p.predicted_order_count,
                    a.order_count.alias("actual_order_count")))


DRIFT_REASONS = {
    "no_model": TRIGGER_NO_MODEL,
    "error": TRIGGER_ERROR,
    "low_history": TRIGGER_LOW_HISTORY,
    "scheduled": TRIGGER_SCHEDULED,
    "skipped": "Skipped: MAPE within threshold",  # ours: the documented 15 % rule
}


def drift_decision(pairs: DataFrame, cfg: Config, model_exists: bool = True,
                   force_daily: bool = True) -> DataFrame:
    """ML7: one row (n_pairs, mape, trigger, reason).

    ``force_daily=True`` reproduces the original, which always retrains
    (T26); ``False`` applies the documented 15 % rule.
    """
    stats = pairs.agg(F.count(F.lit(1)).alias("n_pairs"),
                      M.mape("actual_order_count", "predicted_order_count").alias("mape"))
    n, m = F.col("n_pairs"), F.col("mape")
    over = m > cfg.drift_mape_threshold
    reason = (F.when(F.lit(not model_exists), F.lit(DRIFT_REASONS["no_model"]))
              .when(n < cfg.drift_min_pairs, F.lit(DRIFT_REASONS["low_history"]))
              .when(over, F.format_string(
                  TRIGGER_MAPE.replace("%", "%%").replace("{}", "%s"),
                  colf.fixed_decimals(m, 2), F.lit(f"{cfg.drift_mape_threshold:g}")))
              .otherwise(F.lit(DRIFT_REASONS["scheduled" if force_daily else "skipped"])))
    trigger = reason != F.lit(DRIFT_REASONS["skipped"])
    return stats.withColumns({"trigger": trigger, "reason": reason})


def seven_day_avg(features: DataFrame) -> DataFrame:
    """AG5 + FLT5: zone mean of order_count from MAX(timestamp) - 7 days on.

    Both ends included (up to 169 hourly rows per zone, T24); the MAX is
    over all zones, an uncorrelated scalar subquery.
    """
    last = features.agg(F.max("timestamp")).scalar()
    since = last - F.make_dt_interval(F.lit(7))
    return (features.where(F.col("timestamp") >= since)
            .groupBy("zone_id").agg(F.avg("order_count").alias("avg_orders")))


def high_demand(predictions: DataFrame, averages: DataFrame, cfg: Config) -> DataFrame:
    """ML11 + JN6: predictions above factor x 7-day zone average.

    The averages have one row per zone (bounded by the zone list); the
    rounded prediction is compared (T19); a missing average is 5.0.
    """
    j = predictions.join(averages, "zone_id", "left")
    avg = F.coalesce(F.col("avg_orders"), F.lit(cfg.fallback_avg))
    return (j.withColumn("avg_7d", avg)
            .where(F.col("predicted_order_count") > F.col("avg_7d") * cfg.high_demand_factor)
            .select("zone_id", "forecast_hour", "predicted_order_count", "avg_7d",
                    F.try_divide("predicted_order_count", "avg_7d").alias("ratio"),
                    F.lit(ALERT_TYPE_HIGH_DEMAND).alias("alert_type"),
                    colf.alert_message("predicted_order_count", "avg_7d").alias("message")))


def flag_predictions(predictions: DataFrame, alerts: DataFrame) -> DataFrame:
    """SNK6 / JN9: HIGH_DEMAND on every stored row with an alerted (zone, hour).

    Older batches with the same zone and hour are flagged too (T21). The
    alert keys are de-duplicated before the left join, so no row multiplies.
    """
    keys = (alerts.select("zone_id", "forecast_hour").distinct()
            .withColumn("_alerted", F.lit(True)))
    j = predictions.join(keys, ["zone_id", "forecast_hour"], "left")
    return (j.withColumn("confidence_flag",
                         F.when(F.col("_alerted"), F.lit(FLAG_HIGH_DEMAND))
                         .otherwise(F.col("confidence_flag")))
            .drop("_alerted")
            .select(*predictions.columns))
