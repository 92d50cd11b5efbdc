"""Exploratory aggregates over clean orders (AG13-AG18, FN7).

Group-bys with map-side combine; NULL keys are removed first (T9); means
are over city hours that had orders, not over the grid (T31).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.functions import calendar as cal


def orders_by_hour_weekend(clean: DataFrame) -> DataFrame:
    """AG13: orders per hour of day x the source's weekend flag."""
    return (clean.where(F.col("is_weekend").isNotNull())
            .groupBy(cal.hour_of_day("timestamp").alias("hour"), "is_weekend")
            .agg(F.count(F.lit(1)).alias("order_count")))


def orders_by_zone(clean: DataFrame) -> DataFrame:
    """AG14: orders per zone, most first (ties by zone)."""
    return (clean.where(F.col("zone_id").isNotNull())
            .groupBy("zone_id").agg(F.count(F.lit(1)).alias("order_count"))
            .orderBy(F.desc("order_count"), "zone_id"))


def orders_by_day_name(clean: DataFrame) -> DataFrame:
    """FN7: orders per day name."""
    return (clean.groupBy(cal.day_name("timestamp").alias("day_name"))
            .agg(F.count(F.lit(1)).alias("order_count")))


def hourly_conditions(clean: DataFrame) -> DataFrame:
    """AG15: orders per city hour x weather x festival flag."""
    return (clean.where(F.col("weather_condition").isNotNull()
                        & F.col("is_festival_day").isNotNull())
            .groupBy(cal.floor_hour("timestamp").alias("hour_timestamp"),
                     "weather_condition", "is_festival_day")
            .agg(F.count(F.lit(1)).alias("order_count")))


def weather_avg(clean: DataFrame) -> DataFrame:
    """AG16: mean hourly volume by weather (two-level aggregate)."""
    return (hourly_conditions(clean).groupBy("weather_condition")
            .agg(F.avg("order_count").alias("avg_hourly_orders")))


def festival_avg(clean: DataFrame) -> DataFrame:
    """AG17: mean hourly volume by festival flag."""
    return (hourly_conditions(clean).groupBy("is_festival_day")
            .agg(F.avg("order_count").alias("avg_hourly_orders")))


def dataset_summary(orders: DataFrame) -> DataFrame:
    """AG18: rows, time range and means of value, items, delivery time."""
    return orders.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.min("timestamp").alias("min_timestamp"),
        F.max("timestamp").alias("max_timestamp"),
        F.avg("order_value").alias("avg_order_value"),
        F.avg("items_count").alias("avg_items_count"),
        F.avg("delivery_time_mins").alias("avg_delivery_time_mins"))


def orders_per_zone_summary(orders: DataFrame) -> DataFrame:
    """AG18 (per-zone part): orders per zone including invalid labels."""
    return (orders.where(F.col("zone_id").isNotNull())
            .groupBy("zone_id").agg(F.count(F.lit(1)).alias("order_count")))
