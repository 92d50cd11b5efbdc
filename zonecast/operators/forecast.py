"""Recursive multi-step forecast (ML8-ML10, WN9, ST1, ST2, FN15, FN16).

The original walks each zone's history row by row. Here every step is one
grouped aggregate over all zones at once: because the feature grid is
dense, "the k-th row from the end" is "the hour T + step - k", so each
model input is a conditional aggregate keyed on hour offsets from the
last stored hour T (a scalar subquery, never collected). Step s+1 reads
the history plus the unrounded predictions of steps <= s (T17), appended
with ``unionByName``. Only the last ``max lag + horizon`` rows per zone
are kept (WN9), checkpointed once, so the recursion never re-plans the
feature build.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonecast.config import FEATURE_COLUMNS, FLAG_NORMAL, Config
from zonecast.functions import calendar as cal
from zonecast.functions import columns as colf
from zonecast.session import materialize as write_and_read

Scorer = Callable[[DataFrame], DataFrame]

FORECAST_COLUMNS = ("zone_id", "forecast_hour", "step", *FEATURE_COLUMNS)


def linear_scorer(w1: float = 0.5, w24: float = 0.3, w168: float = 0.2) -> Scorer:
    """A deterministic, SQL-checkable scorer over the lag inputs."""
    def score(df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", F.lit(w1) * F.col("lag_1h")
                             + F.lit(w24) * F.col("lag_24h")
                             + F.lit(w168) * F.col("lag_168h"))
    return score


def seasonal_naive_scorer() -> Scorer:
    """ML12 as a scorer."""
    return lambda df: df.withColumn("prediction", F.col("lag_168h"))


def _at(series_ts: Column, fh: Column, hours_back: int) -> Column:
    return series_ts == cal.hours_before(fh, hours_back)


def step_inputs(series: DataFrame, fh: Column, cfg: Config,
                weather: DataFrame | None = None) -> DataFrame:
    """ML9 + ML10: one model-input row per zone for forecast hour ``fh``.

    series: zone_id, timestamp, n (double) = actual or predicted counts.
    Lags fall back to lag_1h when the history is shorter (ML9); the means
    use what exists of the last 3 / 24 hours; the std of fewer than two
    values is 0.0.
    """
    ts, n = F.col("timestamp"), F.col("n")
    lag1 = F.max(F.when(_at(ts, fh, 1), n))
    lags = {"lag_1h": lag1}
    for k in cfg.lag_hours:
        if k != 1:
            lags[f"lag_{k}h"] = F.coalesce(F.max(F.when(_at(ts, fh, k), n)), lag1)
    in3 = (ts >= cal.hours_before(fh, 3)) & (ts < fh)
    in24 = (ts >= cal.hours_before(fh, 24)) & (ts < fh)
    aggs = [v.alias(k) for k, v in lags.items()] + [
        F.avg(F.when(in3, n)).alias("rolling_mean_3h"),
        F.avg(F.when(in24, n)).alias("rolling_mean_24h"),
        colf.std_or_zero(F.stddev_samp(F.when(in3, n))).alias("rolling_std_3h"),
    ]
    rows = series.groupBy("zone_id").agg(*aggs).withColumn("forecast_hour", fh)
    if weather is not None:
        rows = rows.join(weather, "zone_id", "left")
    else:
        rows = rows.withColumn("weather_rainy", F.lit(0))
    f = F.col("forecast_hour")
    return rows.select(
        "zone_id", "forecast_hour",
        cal.hour_of_day(f).alias("hour_of_day"),
        cal.day_of_week(f).alias("day_of_week"),
        cal.is_weekend(f).alias("is_weekend"),
        cal.month(f).alias("month"),
        cal.iso_week(f).alias("week_of_year"),
        *[F.col(f"lag_{k}h") for k in cfg.lag_hours],
        "rolling_mean_3h", "rolling_mean_24h", "rolling_std_3h",
        cal.is_calendar_day(f, cfg.festival_dates).alias("is_festival_day"),
        F.coalesce(F.col("weather_rainy"), F.lit(0)).cast("int").alias("weather_rainy"),
        colf.peak_hour_flag(cal.hour_of_day(f), cfg).alias("is_peak_hour"),
        colf.zone_code("zone_id", cfg).alias("zone_id_encoded"),
    )


def forecast(features: DataFrame, scorer: Scorer, cfg: Config,
             horizon: int | None = None, materialize: bool = True) -> DataFrame:
    """ML8: forecasts for T+1 .. T+horizon, T = last hour in ``features``.

    Returns the model inputs of every step plus ``predicted_raw`` (clipped
    at 0, unrounded, fed back) and ``predicted_order_count`` (2 decimals).
    """
    horizon = horizon or cfg.horizon
    reach = max(max(cfg.lag_hours), 24) + horizon
    # WN9: the last `reach` rows per zone. On the dense grid these are the
    # last `reach` hours; row_number <= k lets Spark apply a map-side
    # WindowGroupLimit, so each task forwards at most k rows per zone.
    w = Window.partitionBy("zone_id").orderBy(F.desc("timestamp"))
    recent = (features.select("zone_id", "timestamp", "order_count", "weather_rainy")
              .withColumn("_rn", F.row_number().over(w))
              .where(F.col("_rn") <= reach).drop("_rn"))
    if materialize:
        # Cut the lineage once: every step (and T itself) then reads this
        # small frame (zones x reach rows) instead of re-planning the feature
        # build; written once under the shared spark.checkpoint.dir. T is then
        # one value read from that table, a literal in every step's plan.
        recent = write_and_read(recent, "forecast-history")
        t = recent.agg(F.max("timestamp")).first()[0]
        if t is None:
            raise ValueError("no feature rows to forecast from")
        last = F.lit(t).cast("timestamp_ntz")
    else:
        last = recent.agg(F.max("timestamp")).scalar()
    series = recent.select("zone_id", "timestamp", F.col("order_count").cast("double").alias("n"))
    weather = None
    if cfg.forecast_weather == "carry":
        weather = (recent.where(F.col("timestamp") == last)
                   .select("zone_id", "weather_rainy"))
    steps = []
    for s in range(1, horizon + 1):
        fh = cal.hours_after(last, s)
        inputs = step_inputs(series, fh, cfg, weather).withColumn("step", F.lit(s))
        scored = scorer(inputs).withColumn(
            "predicted_raw", colf.clip_at_zero("prediction")).drop("prediction")
        if materialize and s < horizon:
            # keep each step's plan linear in the horizon (one row per zone)
            scored = write_and_read(scored, f"forecast-step{s}")
        steps.append(scored)
        series = series.unionByName(  # ST1: the forecast becomes history
            scored.select("zone_id", F.col("forecast_hour").alias("timestamp"),
                          F.col("predicted_raw").alias("n")))
    out = steps[0]
    for s in steps[1:]:  # ST2
        out = out.unionByName(s)
    return out.withColumn("predicted_order_count", colf.round2("predicted_raw"))


def prediction_rows(forecasts: DataFrame, generated_at: Column) -> DataFrame:
    """SNK4's rows: one batch shares one generated_at literal."""
    return forecasts.select(
        "zone_id", "forecast_hour", "predicted_order_count",
        F.lit(FLAG_NORMAL).alias("confidence_flag"),
        generated_at.cast("timestamp_ntz").alias("generated_at"))


def backtest_predictions(features: DataFrame, cfg: Config,
                         horizon: int | None = None) -> DataFrame:
    """The predictions log replayed with the seasonal-naive model (ML12).

    The hourly job run at hour g (features up to g) writes forecasts for
    g+1 .. g+horizon; with the seasonal-naive scorer the forecast for hour
    t is the count at t - 168 h, so every feature row yields the forecasts
    that use it. Batches are generated up to the last stored hour, so the
    latest batch forecasts T+1 .. T+horizon like a live run. A pure
    projection + explode: no shuffle, linear in the feature table.
    """
    horizon = horizon or cfg.horizon
    week = max(cfg.lag_hours)
    last = features.agg(F.max("timestamp")).scalar()
    t = cal.hours_after("timestamp", week)
    rows = features.select(
        "zone_id", t.alias("forecast_hour"),
        colf.round2(F.col("order_count").cast("double")).alias("predicted_order_count"),
        F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
    gen = F.col("forecast_hour") - F.make_dt_interval(F.lit(0), F.col("step"))
    return (rows.withColumn("generated_at", gen)
            .where(F.col("generated_at") <= last)
            .select("zone_id", "forecast_hour", "predicted_order_count",
                    F.lit(FLAG_NORMAL).alias("confidence_flag"), "generated_at", "step"))
