"""SRC4: declared schemas of the eight stored tables (never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

S, TS, D, I, L, B = (T.StringType(), T.TimestampNTZType(), T.DoubleType(),
                     T.IntegerType(), T.LongType(), T.BooleanType())


def _schema(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


ORDER_FIELDS = (
    ("order_id", S, True),
    ("zone_id", S, True),
    ("timestamp", TS, True),
    ("order_value", D, True),
    ("items_count", I, True),
    ("delivery_time_mins", D, True),
    ("is_weekend", B, True),
    ("weather_condition", S, True),
    ("is_festival_day", B, True),
)

RAW_ORDERS = _schema(*ORDER_FIELDS)

CLEAN_ORDERS = _schema(*ORDER_FIELDS, ("ingested_at", TS, True))

VALIDATION_ERRORS = _schema(
    *ORDER_FIELDS,
    ("error_reason", S, False),
    ("rejected_at", TS, True),
    ("error_id", L, True),
)

FEATURES = _schema(
    ("zone_id", S, False),
    ("timestamp", TS, False),
    ("order_count", I, False),
    ("hour_of_day", I, False),
    ("day_of_week", I, False),
    ("is_weekend", B, False),
    ("month", I, False),
    ("week_of_year", I, False),
    ("lag_1h", D, True),
    ("lag_2h", D, True),
    ("lag_24h", D, True),
    ("lag_168h", D, True),
    ("rolling_mean_3h", D, True),
    ("rolling_mean_24h", D, True),
    ("rolling_std_3h", D, True),
    ("is_festival_day", B, False),
    ("weather_rainy", I, False),
    ("is_peak_hour", I, False),
    ("zone_id_encoded", I, True),
)

MODEL_RUNS = _schema(
    ("run_id", S, False),
    ("timestamp", TS, True),
    ("train_rows", I, True),
    ("val_rows", I, True),
    ("mape", D, True),
    ("rmse", D, True),
    ("mae", D, True),
    ("model_path", S, True),
    ("promoted", B, True),
    ("baseline_mape", D, True),
)

PREDICTIONS = _schema(
    ("zone_id", S, True),
    ("forecast_hour", TS, True),
    ("predicted_order_count", D, True),
    ("confidence_flag", S, True),
    ("generated_at", TS, True),
    ("prediction_id", L, True),
)

ALERTS = _schema(
    ("zone_id", S, True),
    ("alert_type", S, True),
    ("message", S, True),
    ("created_at", TS, True),
    ("alert_id", L, True),
)

PIPELINE_RUNS = _schema(
    ("dag_name", S, True),
    ("run_time", TS, True),
    ("status", S, True),
    ("rows_processed", I, True),
    ("run_id", L, True),
)

WATERMARKS = _schema(("source", S, False), ("watermark", TS, True), ("updated_at", TS, True))

# Every order_id ever stored in clean_orders: its primary key over all time,
# by event date, with the batch that stored it (it counts once committed).
ORDER_KEYS = _schema(("order_id", S, False), ("batch", S, False))

# Bloom summaries of order_keys, by event date and batch (see keys.py).
KEY_SUMMARIES = _schema(("batch", S, False), ("blocks", L, False), ("block", L, False),
                        ("bits", T.ArrayType(L), False))

# Mergeable counts of orders (AG1 before its last step): the base of all
# ingests up to a commit, and the delta that each later batch added.
ZONE_HOUR_COUNTS = _schema(("zone_id", S, False), ("timestamp", TS, False), ("weather_condition", S, True),
                           ("n", L, False), ("rows", L, False), ("fest", B, True))

SCHEMAS: dict[str, T.StructType] = {
    "raw_orders": RAW_ORDERS,
    "clean_orders": CLEAN_ORDERS,
    "validation_errors": VALIDATION_ERRORS,
    "features": FEATURES,
    "model_runs": MODEL_RUNS,
    "predictions": PREDICTIONS,
    "alerts": ALERTS,
    "pipeline_runs": PIPELINE_RUNS,
    "watermarks": WATERMARKS,
    "order_keys": ORDER_KEYS,
    "key_summaries": KEY_SUMMARIES,
    "zone_hour_counts": ZONE_HOUR_COUNTS,
    "zone_hour_deltas": ZONE_HOUR_COUNTS,
}

# Tables stored with a derived date partition for time pruning (SRC1, SRC5):
# NTZ predicates are pushed but do not skip row groups, a dt predicate does.
DATE_PARTITIONED = {"raw_orders": "timestamp", "clean_orders": "timestamp",
                    "validation_errors": "timestamp", "predictions": "generated_at",
                    "alerts": "created_at"}

# Stored with a BIGINT copy of the time (microseconds, UTC) and clustered by
# (date, this column, time), the original's index on zone and hour (SRC5).
TIME_INDEX = "ts_us"
INDEXED = {"clean_orders": "zone_id"}

# Written with the date partition as a column of their own.
DATED = {"order_keys", "key_summaries"}

# Reloaded by date: a commit names the version that holds each date.
VERSIONED = {"features": "timestamp", "zone_hour_counts": "timestamp"}

# The commits of the ingest job: one a batch, with the oldest event time it
# brought, so that the incremental feature build finds late orders.
INGEST_COMMITS = "seq long, batch string, rows long"
