"""Reference SQL (DuckDB dialect) for the registered queries.

Each entry recomputes the same result from the driver's tables with plain
SQL, independently of the Spark code: the adapter CTE mirrors the
projection of ``zonecast.sources.adapters``; modes use ``row_number`` with
(count desc, label asc) because DuckDB's ``mode()`` breaks ties otherwise.
"""

from __future__ import annotations

from zonecast.config import Config, TEST_CONFIG


def _q(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _dates(cfg: Config) -> str:
    return ", ".join(f"DATE '{d.isoformat()}'" for d in cfg.festival_dates)


def _ts(t) -> str:
    return f"TIMESTAMP '{t:%Y-%m-%d %H:%M:%S}'"


def _zone_values(cfg: Config) -> str:
    return ", ".join(f"('{z}', {i})" for z, i in cfg.zone_codes.items())


def _zone_case(col: str, cfg: Config) -> str:
    whens = " ".join(f"WHEN '{z}' THEN {i}" for z, i in cfg.zone_codes.items())
    return f"CAST(CASE {col} {whens} END AS INTEGER)"


def raw_cte(cfg: Config = TEST_CONFIG) -> str:
    return f"""
raw AS (
  SELECT CAST(event_id AS VARCHAR) AS order_id,
         CASE WHEN event_id % 211 = 0 THEN NULL
              ELSE 'Z' || CAST(user_id % 6 + 1 AS VARCHAR) END AS zone_id,
         CAST(ts AS TIMESTAMP) AS "timestamp",
         CAST(CASE WHEN event_id % 307 = 0 THEN NULL
                   WHEN event_id % 97 = 0 THEN -value
                   ELSE value END AS DOUBLE) AS order_value,
         CAST(event_id % 23 AS INTEGER) AS items_count,
         CAST(8 + event_id % 38 AS DOUBLE) AS delivery_time_mins,
         isodow(ts) >= 6 AS is_weekend,
         CASE WHEN event_type = 'error' THEN 'rainy'
              WHEN event_type = 'click' THEN 'cloudy' ELSE 'sunny' END AS weather_condition,
         CAST(ts AS DATE) IN ({_dates(cfg)}) AS is_festival_day
  FROM events)"""


def _missing(col: str) -> str:
    return (f"CASE WHEN {col} IS NULL OR trim(CAST({col} AS VARCHAR)) = '' "
            f"THEN 'Missing required field: {col.strip(chr(34))}' END")


def validated_cte(cfg: Config = TEST_CONFIG) -> str:
    miss = ",\n        ".join(_missing(c) for c in (
        "order_id", "zone_id", '"timestamp"', "order_value", "items_count",
        "delivery_time_mins"))
    return f"""
reasons AS (
  SELECT r.*,
    nullif(concat_ws('; ',
        {miss},
        CASE WHEN TRY_CAST(order_value AS DOUBLE) IS NULL OR isnan(TRY_CAST(order_value AS DOUBLE))
             THEN 'order_value is not numeric' END,
        CASE WHEN TRY_CAST(items_count AS INTEGER) IS NULL THEN 'items_count is not integer' END,
        CASE WHEN TRY_CAST(delivery_time_mins AS DOUBLE) IS NULL
               OR isnan(TRY_CAST(delivery_time_mins AS DOUBLE))
             THEN 'delivery_time_mins is not numeric' END), '') AS schema_reason,
    nullif(concat_ws('; ',
        CASE WHEN order_value <= 0
             THEN 'order_value is not positive: ' || CAST(order_value AS VARCHAR) END,
        CASE WHEN items_count < {cfg.items_min} OR items_count > {cfg.items_max}
             THEN 'items_count out of range [{cfg.items_min}, {cfg.items_max}]: '
                  || CAST(items_count AS VARCHAR) END,
        CASE WHEN zone_id IS NULL OR zone_id NOT IN ({_q(cfg.zones)})
             THEN 'Invalid zone_id: ' || coalesce(zone_id, 'None') END), '') AS range_reason
  FROM raw r),
validated AS (
  SELECT *, nullif(concat_ws(' | ', schema_reason, range_reason), '') AS error_reason
  FROM reasons),
clean AS (
  SELECT order_id, zone_id, "timestamp", order_value, items_count, delivery_time_mins,
         coalesce(is_weekend, false) AS is_weekend, weather_condition,
         coalesce(is_festival_day, false) AS is_festival_day
  FROM validated WHERE error_reason IS NULL)"""


def zone_hours_cte() -> str:
    return """
zh_base AS (
  SELECT zone_id, date_trunc('hour', "timestamp") AS hour_ts, order_id,
         is_festival_day, weather_condition
  FROM clean WHERE zone_id IS NOT NULL AND "timestamp" IS NOT NULL),
zh_counts AS (
  SELECT zone_id, hour_ts, CAST(count(order_id) AS INTEGER) AS order_count,
         max(is_festival_day) AS is_festival_day
  FROM zh_base GROUP BY zone_id, hour_ts),
zh_mode AS (
  SELECT zone_id, hour_ts, weather_condition FROM (
    SELECT zone_id, hour_ts, weather_condition,
           row_number() OVER (PARTITION BY zone_id, hour_ts
                              ORDER BY count(*) DESC, weather_condition ASC) AS rn
    FROM zh_base WHERE weather_condition IS NOT NULL
    GROUP BY zone_id, hour_ts, weather_condition) WHERE rn = 1),
zone_hours AS (
  SELECT c.zone_id, c.hour_ts AS "timestamp", c.order_count, c.is_festival_day,
         m.weather_condition
  FROM zh_counts c LEFT JOIN zh_mode m ON c.zone_id = m.zone_id AND c.hour_ts = m.hour_ts)"""


def hour_meta_cte() -> str:
    return """
hm_fest AS (
  SELECT "timestamp", max(is_festival_day) AS hour_festival FROM zone_hours GROUP BY 1),
hm_weather AS (
  SELECT "timestamp", weather_condition AS hour_weather FROM (
    SELECT "timestamp", weather_condition,
           row_number() OVER (PARTITION BY "timestamp"
                              ORDER BY count(*) DESC, weather_condition ASC) AS rn
    FROM zone_hours WHERE weather_condition IS NOT NULL
    GROUP BY "timestamp", weather_condition) WHERE rn = 1),
hour_meta AS (
  SELECT f."timestamp", w.hour_weather, f.hour_festival
  FROM hm_fest f LEFT JOIN hm_weather w ON f."timestamp" = w."timestamp")"""


def grid_cte(cfg: Config = TEST_CONFIG) -> str:
    return f"""
zones AS (SELECT * FROM (VALUES {_zone_values(cfg)}) t(zone_id, zone_id_encoded)),
hours AS (
  SELECT unnest(generate_series((SELECT min("timestamp") FROM zone_hours),
                                (SELECT max("timestamp") FROM zone_hours),
                                INTERVAL 1 HOUR)) AS "timestamp"),
grid AS (SELECT z.zone_id, h."timestamp" FROM zones z CROSS JOIN hours h),
filled AS (
  SELECT g.zone_id, g."timestamp",
         CAST(coalesce(zh.order_count, 0) AS INTEGER) AS order_count,
         coalesce(zh.weather_condition, hm.hour_weather, '{cfg.default_weather}') AS weather_condition,
         coalesce(zh.is_festival_day, hm.hour_festival, false) AS is_festival_day
  FROM grid g
  LEFT JOIN zone_hours zh ON g.zone_id = zh.zone_id AND g."timestamp" = zh."timestamp"
  LEFT JOIN hour_meta hm ON g."timestamp" = hm."timestamp")"""


def features_cte(cfg: Config = TEST_CONFIG) -> str:
    peaks = ", ".join(str(h) for h in cfg.peak_hours)
    lags = ",\n    ".join(
        f"CAST(lag(order_count, {k}) OVER w AS DOUBLE) AS lag_{k}h" for k in cfg.lag_hours)
    return f"""
features AS (
  SELECT zone_id, "timestamp", order_count,
    CAST(hour("timestamp") AS INTEGER) AS hour_of_day,
    CAST(isodow("timestamp") - 1 AS INTEGER) AS day_of_week,
    isodow("timestamp") >= 6 AS is_weekend,
    CAST(month("timestamp") AS INTEGER) AS month,
    CAST(week("timestamp") AS INTEGER) AS week_of_year,
    {lags},
    CASE WHEN count(order_count) OVER w3 = 3 THEN avg(order_count) OVER w3 END AS rolling_mean_3h,
    CASE WHEN count(order_count) OVER w24 = 24 THEN avg(order_count) OVER w24 END AS rolling_mean_24h,
    coalesce(CASE WHEN count(order_count) OVER w3 = 3 THEN stddev_samp(order_count) OVER w3 END,
             0.0) AS rolling_std_3h,
    is_festival_day,
    CAST(coalesce(weather_condition = '{cfg.rainy_label}', false) AS INTEGER) AS weather_rainy,
    CAST(hour("timestamp") IN ({peaks}) AS INTEGER) AS is_peak_hour,
    {_zone_case("zone_id", cfg)} AS zone_id_encoded
  FROM filled
  WINDOW w AS (PARTITION BY zone_id ORDER BY "timestamp"),
         w3 AS (PARTITION BY zone_id ORDER BY "timestamp" ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING),
         w24 AS (PARTITION BY zone_id ORDER BY "timestamp" ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING))"""


def with_ctes(*parts: str, body: str) -> str:
    return "WITH " + ",".join(p.strip("\n") for p in parts) + "\n" + body


def feature_stack(cfg: Config = TEST_CONFIG) -> tuple[str, ...]:
    return (raw_cte(cfg), validated_cte(cfg), zone_hours_cte(), hour_meta_cte(),
            grid_cte(cfg), features_cte(cfg))
