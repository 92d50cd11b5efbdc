"""Domain constants as one frozen ``Config``.

Everything that the original pipeline hard-codes is a parameter here so
the same plans run on any zone set, calendar or split date.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

# ---------------------------------------------------------------------------
# Fixed values that must equal the original pipeline's for equal results.
#   zones and their ordinal codes: Z1 0, Z2 1, Z3 2, Z4 3, Z5 4
#   peak hours: 12, 13, 14, 19, 20, 21, 22
#   rainy label "rainy", default weather "sunny"
#   lags (hours): 1, 2, 24, 168; rolling windows: mean 3, mean 24, std 3
#   valid items_count range: 1..20 inclusive; order_value must be > 0
#   initial watermark 2026-01-01 00:00:00
#   split date 2026-06-01; minimum training rows 1000
#   boosted trees: 200 iterations, step 0.05, depth 6, seed 42
#   forecast horizon 2 hours
#   high-demand factor 1.5, amber factor 1.2, fallback 7-day average 5.0
#   drift: MAPE threshold 15.0 %, minimum 5 pairs, look-back 24 hours
#   fallback baseline MAPE 28.5
#   festival dates (2026): 01-01, 01-14, 01-26, 02-14, 03-08, 03-25, 04-02,
#     04-10, 04-14, 05-01, 05-10, 06-01, 06-15, 06-20, 06-25
#   required fields, in order: order_id, zone_id, timestamp, order_value,
#     items_count, delivery_time_mins
#   model inputs, in order: hour_of_day, day_of_week, is_weekend, month,
#     week_of_year, lag_1h, lag_2h, lag_24h, lag_168h, rolling_mean_3h,
#     rolling_mean_24h, rolling_std_3h, is_festival_day, weather_rainy,
#     is_peak_hour, zone_id_encoded
#   DAG names, in display order: ingest_and_validate, feature_engineering,
#     model_training, generate_predictions
# ---------------------------------------------------------------------------
ZONES = ("Z1", "Z2", "Z3", "Z4", "Z5")
PEAK_HOURS = (12, 13, 14, 19, 20, 21, 22)
RAINY = "rainy"
DEFAULT_WEATHER = "sunny"
LAG_HOURS = (1, 2, 24, 168)
FESTIVAL_DATES_2026 = (
    "2026-01-01", "2026-01-14", "2026-01-26", "2026-02-14", "2026-03-08",
    "2026-03-25", "2026-04-02", "2026-04-10", "2026-04-14", "2026-05-01",
    "2026-05-10", "2026-06-01", "2026-06-15", "2026-06-20", "2026-06-25",
)
REQUIRED_FIELDS = (
    "order_id", "zone_id", "timestamp", "order_value", "items_count",
    "delivery_time_mins",
)
FEATURE_COLUMNS = (
    "hour_of_day", "day_of_week", "is_weekend", "month", "week_of_year",
    "lag_1h", "lag_2h", "lag_24h", "lag_168h",
    "rolling_mean_3h", "rolling_mean_24h", "rolling_std_3h",
    "is_festival_day", "weather_rainy", "is_peak_hour", "zone_id_encoded",
)
DAG_NAMES = (
    "ingest_and_validate", "feature_engineering", "model_training",
    "generate_predictions",
)

# ---------------------------------------------------------------------------
# Texts and labels the original pipeline writes, which must be
# equal for equal results ("{}" marks where a value is inserted).
# ---------------------------------------------------------------------------
REASON_MISSING = "Missing required field: {}"
REASON_NOT_NUMERIC = "{} is not numeric"
REASON_NOT_INTEGER = "{} is not integer"
REASON_NOT_POSITIVE = "order_value is not positive: {}"
REASON_OUT_OF_RANGE = "items_count out of range [{}, {}]: {}"
REASON_INVALID_ZONE = "Invalid zone_id: {}"
NULL_TEXT = "None"
REASON_SEPARATOR = "; "
REASON_GROUP_SEPARATOR = " | "
FLAG_NORMAL = "NORMAL"
FLAG_HIGH_DEMAND = "HIGH_DEMAND"
ALERT_TYPE_HIGH_DEMAND = "HIGH_DEMAND"
ALERT_MESSAGE = "Predicted demand {} is {}x higher than 7-day average ({})"
STATUS_RED = "High Demand (Red)"
STATUS_AMBER = "Elevated (Amber)"
STATUS_GREEN = "Normal (Green)"
RUN_SUCCESS = "SUCCESS"
RUN_FAILED = "FAILED"
NO_RUNS = "NO RUNS"
TRIGGER_NO_MODEL = "Triggered: No existing model"
TRIGGER_ERROR = "Triggered: Error checking MAPE"
TRIGGER_LOW_HISTORY = "Triggered: Low prediction history"
TRIGGER_MAPE = "Triggered: MAPE is {}% (> {}%)"
TRIGGER_SCHEDULED = "Triggered: Scheduled Daily Retrain"


def _ts(text: str) -> dt.datetime:
    return dt.datetime.strptime(text, "%Y-%m-%d %H:%M:%S")


def _d(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


@dataclass(frozen=True)
class Config:
    zones: tuple[str, ...] = ZONES
    peak_hours: tuple[int, ...] = PEAK_HOURS
    rainy_label: str = RAINY
    default_weather: str = DEFAULT_WEATHER
    lag_hours: tuple[int, ...] = LAG_HOURS
    festival_dates: tuple[dt.date, ...] = tuple(_d(d) for d in FESTIVAL_DATES_2026)
    items_min: int = 1
    items_max: int = 20
    initial_watermark: dt.datetime = _ts("2026-01-01 00:00:00")
    split_date: dt.datetime = _ts("2026-06-01 00:00:00")
    min_train_rows: int = 1000
    max_iter: int = 200
    step_size: float = 0.05
    max_depth: int = 6
    seed: int = 42
    horizon: int = 2
    high_demand_factor: float = 1.5
    amber_factor: float = 1.2
    fallback_avg: float = 5.0
    drift_mape_threshold: float = 15.0
    drift_min_pairs: int = 5
    drift_lookback_hours: int = 24
    fallback_baseline_mape: float = 28.5
    quality_min_orders: int = 15
    # "none": forecast weather_rainy is 0 (observed behaviour, T16);
    # "carry": reuse the zone's last weather_rainy.
    forecast_weather: str = "none"
    # Driver-side scan options.
    date_partition_col: str = "dt"
    # Windows over time work on slices of so many hours and the 168 before each
    # (an eighth more rows).
    slice_hours: int = 8 * 168
    # Row groups of the clustered order files: small enough to be skipped.
    row_group_bytes: int = 16 << 20
    # Store upkeep: reloaded versions kept beside those in use, and the number
    # of ingested batches after which their hour counts are folded together.
    keep_versions: int = 3
    compact_every: int = 24

    @property
    def zone_codes(self) -> dict[str, int]:
        return {z: i for i, z in enumerate(self.zones)}

    def with_(self, **kw) -> "Config":
        return replace(self, **kw)


DEFAULT_CONFIG = Config()

# Configuration for the driver's test tables (events span 2024-01-01..30).
TEST_CONFIG = Config(
    festival_dates=(_d("2024-01-01"), _d("2024-01-14"), _d("2024-01-26")),
    initial_watermark=_ts("2023-12-31 00:00:00"),
    split_date=_ts("2024-01-24 00:00:00"),
)
