"""Adapter: the driver's ``events`` table seen as ``raw_orders``.

A deterministic projection (FIXTURES.md §3) that produces valid and
invalid orders with every rejection reason, varying weather inside a
zone-hour and festival days. It is a pure projection: no shuffle, the
scan keeps only the five columns used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.config import Config, TEST_CONFIG
from zonecast.sources.schemas import RAW_ORDERS

# Fixed projection parameters of the test-data mapping (FIXTURES.md §3).
NULL_ZONE_MOD = 211
NULL_VALUE_MOD = 307
NEGATIVE_VALUE_MOD = 97
ITEMS_MOD = 23
ZONE_MOD = 6  # gives Z1..Z6; Z6 is outside the valid set on purpose
DELIVERY_BASE = 8
DELIVERY_MOD = 38
WEATHER_BY_EVENT = (("error", "rainy"), ("click", "cloudy"))


def events_as_orders(events: DataFrame, cfg: Config = TEST_CONFIG) -> DataFrame:
    eid = F.col("event_id")
    weather: Column = F.lit("sunny")
    for ev, w in reversed(WEATHER_BY_EVENT):
        weather = F.when(F.col("event_type") == ev, F.lit(w)).otherwise(weather)
    festival = F.to_date("ts").isin([F.lit(d) for d in cfg.festival_dates])
    out = events.select(
        eid.cast("string").alias("order_id"),
        F.when(eid % NULL_ZONE_MOD == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("Z"), (F.col("user_id") % ZONE_MOD + 1).cast("string")))
        .alias("zone_id"),
        F.col("ts").cast("timestamp_ntz").alias("timestamp"),
        F.when(eid % NULL_VALUE_MOD == 0, F.lit(None).cast("double"))
        .when(eid % NEGATIVE_VALUE_MOD == 0, -F.col("value"))
        .otherwise(F.col("value")).cast("double").alias("order_value"),
        (eid % ITEMS_MOD).cast("int").alias("items_count"),
        (F.lit(DELIVERY_BASE) + eid % DELIVERY_MOD).cast("double").alias("delivery_time_mins"),
        (F.weekday("ts") >= 5).alias("is_weekend"),
        weather.alias("weather_condition"),
        festival.alias("is_festival_day"),
    )
    return out.select([F.col(f.name).cast(f.dataType) for f in RAW_ORDERS.fields])


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def raw_orders_from_testdata(spark: SparkSession, sf_dir: str,
                             cfg: Config = TEST_CONFIG) -> DataFrame:
    return events_as_orders(read_events(spark, sf_dir), cfg)
