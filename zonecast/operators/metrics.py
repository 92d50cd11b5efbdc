"""Evaluation operators: split, counts, error metrics, seasonal naive.

AG7-AG12, FLT1-FLT3, ML4, ML12, WN10. All aggregates are declarative
(partial + final), grouped globally or by zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.config import Config
from zonecast.functions import metrics as M


def with_history(features: DataFrame) -> DataFrame:
    """FLT1: rows with a full week of history (lag_168h not NULL)."""
    return features.dropna(subset=["lag_168h"])


def split(features: DataFrame, cfg: Config) -> tuple[DataFrame, DataFrame]:
    """FLT1 + FLT2: train < split date <= validation."""
    h = with_history(features)
    cut = F.lit(cfg.split_date).cast("timestamp_ntz")
    return h.where(F.col("timestamp") < cut), h.where(F.col("timestamp") >= cut)


def split_counts(features: DataFrame, cfg: Config) -> DataFrame:
    """AG11: train and validation row counts in one pass."""
    cut = F.lit(cfg.split_date).cast("timestamp_ntz")
    return with_history(features).agg(
        F.count_if(F.col("timestamp") < cut).alias("train_rows"),
        F.count_if(F.col("timestamp") >= cut).alias("val_rows"))


def quality_rows(features: DataFrame, cfg: Config) -> DataFrame:
    """FLT3: validation rows with at least ``quality_min_orders`` orders."""
    _, val = split(features, cfg)
    return val.where(F.col("order_count") >= cfg.quality_min_orders)


def evaluate(scored: DataFrame, pred: str = "prediction", actual: str = "order_count",
             by: list[str] | None = None, baseline: str | None = None) -> DataFrame:
    """ML4 / AG7-AG9 (+AG12 with ``by``): MAPE, RMSE, MAE and the row count.

    With ``baseline`` (a column of baseline predictions, e.g. lag_168h)
    the baseline MAPE (AG10) comes out of the same single pass.
    """
    aggs = [M.mape(actual, pred).alias("mape"), M.rmse(actual, pred).alias("rmse"),
            M.mae(actual, pred).alias("mae"), F.count(F.lit(1)).alias("n_rows")]
    if baseline:
        aggs.append(M.mape(actual, baseline).alias("baseline_mape"))
    return scored.groupBy(*by).agg(*aggs) if by else scored.agg(*aggs)


def seasonal_naive(df: DataFrame, out: str = "prediction") -> DataFrame:
    """ML12 / WN10: the value one week earlier is the prediction."""
    return df.withColumn(out, F.col("lag_168h"))


def seasonal_naive_metrics(features: DataFrame, cfg: Config,
                           by: list[str] | None = None) -> DataFrame:
    """AG10 (+AG12): baseline metrics on the validation part."""
    _, val = split(features, cfg)
    return evaluate(seasonal_naive(val), by=by)
