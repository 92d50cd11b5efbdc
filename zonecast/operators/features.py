"""Feature build: zone-hour aggregate -> dense grid -> lags and rollings.

Operators AG1-AG4, JN1-JN3, FN1-FN14, WN1-WN7 (+ the incremental variant).

Plan shape (one lazy plan):
  clean orders --partial agg--> Exchange(zone, hour) --final agg-->  zone-hour rows
  zones (config) x explode(sequence(min hour, max hour)) = grid; bounds are
      scalar subqueries, so no cross join and nothing goes through the driver
  grid LEFT JOIN zone-hour (AQE broadcasts it when its measured size is small)
  Window(partition hour): hour metadata (mode of zone modes) -> fills
  one Window(partition zone and time slice, order hour): 4 lags + 3 rollings
      share one Exchange and one Sort; each slice has copies of the 168 hours
      before it, so there are more groups than zones.
The only stage whose input grows with the order volume is the first one,
and it is a map-side-combined aggregate: a zone holding a third of the
orders is pre-aggregated per task before anything is shuffled. After it the
data is one row per zone and hour.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonecast.config import Config
from zonecast.functions import calendar as cal
from zonecast.functions import columns as colf

FEATURE_ORDER = (
    "zone_id", "timestamp", "order_count", "hour_of_day", "day_of_week",
    "is_weekend", "month", "week_of_year", "lag_1h", "lag_2h", "lag_24h",
    "lag_168h", "rolling_mean_3h", "rolling_mean_24h", "rolling_std_3h",
    "is_festival_day", "weather_rainy", "is_peak_hour", "zone_id_encoded",
)


def zone_hour_partials(clean: DataFrame) -> DataFrame:
    """AG1's first step: orders, rows and any festival per zone, hour and
    weather label. A plain hash aggregate with fixed-width buffers and a
    map-side partial phase (``mode()`` would be an object aggregate that falls
    back to sorting after 128 groups per task), and mergeable: the counts of
    several batches add up. NULL keys are dropped, as pandas group-bys do
    (T9)."""
    return (clean
            .where(F.col("zone_id").isNotNull() & F.col("timestamp").isNotNull())
            .groupBy("zone_id", cal.floor_hour("timestamp").alias("timestamp"),
                     "weather_condition")
            .agg(F.count("order_id").alias("n"),
                 F.count(F.lit(1)).alias("rows"),
                 F.max("is_festival_day").alias("fest")))


def merge_partials(partials: DataFrame) -> DataFrame:
    """Counts of several batches as counts of all their orders."""
    return (partials.groupBy("zone_id", "timestamp", "weather_condition")
            .agg(F.sum("n").alias("n"), F.sum("rows").alias("rows"), F.max("fest").alias("fest")))


def zone_hours_from_partials(per_label: DataFrame) -> DataFrame:
    """AG1's second step, over one row per zone, hour and label: the total,
    the festival flag, and the label with the most orders, ties to the
    smallest label (pandas' sorted modes), picked by row_number. A NULL
    weather counts as an order but is never the mode."""
    ranked = (Window.partitionBy("zone_id", "timestamp")
              .orderBy(F.desc("rows"), F.asc_nulls_last("weather_condition")))
    whole = ranked.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (per_label  # one Window node: same partitioning and order, two frames
            .withColumns({"order_count": F.sum("n").over(whole).cast("int"),
                          "is_festival_day": F.max("fest").over(whole),
                          "_rank": F.row_number().over(ranked)})
            .where(F.col("_rank") == 1)
            .select("zone_id", "timestamp", "order_count", "is_festival_day",
                    "weather_condition"))


def zone_hour_aggregate(clean: DataFrame) -> DataFrame:
    """AG1 (+FN1): per zone and hour: order count, any festival, modal weather."""
    return zone_hours_from_partials(zone_hour_partials(clean))


def hour_metadata(zone_hours: DataFrame) -> DataFrame:
    """AG2: per hour, the mode of the zone modes and any festival."""
    return (zone_hours.groupBy("timestamp")
            .agg(F.mode("weather_condition", True).alias("hour_weather"),
                 F.max("is_festival_day").alias("hour_festival")))


def zones_frame(spark: SparkSession, cfg: Config) -> DataFrame:
    """The zone dimension: a configured list, so its size is bounded."""
    rows = [(z, i) for z, i in cfg.zone_codes.items()]
    return spark.createDataFrame(rows, "zone_id string, zone_id_encoded int")


def hourly_grid(zone_hours: DataFrame, cfg: Config,
                start: dt.datetime | None = None) -> DataFrame:
    """AG3, AG4, JN1: every configured zone for every hour between bounds.

    Bounds are uncorrelated scalar subqueries over the zone-hour rows,
    merged by Catalyst into one aggregate; ``start`` replaces the lower
    bound (incremental builds, where it lies inside the stored grid).
    """
    spark = zone_hours.sparkSession
    if start is None:
        lo = zone_hours.agg(F.min("timestamp")).scalar()
    else:
        lo = F.lit(start).cast("timestamp_ntz")
    hi = zone_hours.agg(F.max("timestamp")).scalar()
    return zones_frame(spark, cfg).select(
        "zone_id",
        F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 HOUR"))).alias("timestamp"))


def filled_grid(zone_hours: DataFrame, cfg: Config,
                start: dt.datetime | None = None) -> DataFrame:
    """JN2, JN3, FN12, FN13: grid with counts, weather and festival filled.

    The hour metadata (AG2) is evaluated as a window over the joined grid
    partitioned by hour rather than as a second aggregate joined back
    (JN3): grid rows without orders carry NULLs, which mode/max skip, so
    the result is the same, and the order aggregate is computed once
    instead of twice.
    """
    grid = hourly_grid(zone_hours, cfg, start)
    joined = grid.join(zone_hours, ["zone_id", "timestamp"], "left")
    per_hour = Window.partitionBy("timestamp")
    return joined.select(
        "zone_id", "timestamp",
        colf.fill_zero("order_count").cast("int").alias("order_count"),
        colf.fill_chain("weather_condition",
                        F.mode("weather_condition", True).over(per_hour),
                        F.lit(cfg.default_weather)).alias("weather_condition"),
        colf.fill_chain("is_festival_day",
                        F.max("is_festival_day").over(per_hour),
                        F.lit(False)).alias("is_festival_day"))


def time_features(df: DataFrame, cfg: Config) -> DataFrame:
    """FN2-FN6, FN8-FN10 on a frame with timestamp, weather_condition, zone_id."""
    ts = F.col("timestamp")
    return df.withColumns({
        "hour_of_day": cal.hour_of_day(ts),
        "day_of_week": cal.day_of_week(ts),
        "is_weekend": cal.is_weekend(ts),
        "month": cal.month(ts),
        "week_of_year": cal.iso_week(ts),
        "weather_rainy": colf.rainy_flag("weather_condition", cfg),
        "is_peak_hour": colf.peak_hour_flag(cal.hour_of_day(ts), cfg),
        "zone_id_encoded": colf.zone_code("zone_id", cfg),
    })


def _full_frame_mean(n: int, w):
    frame = w.rowsBetween(-n, -1)
    c = F.col("order_count")
    return F.when(F.count(c).over(frame) == n, F.avg(c).over(frame))


def sliced(df: DataFrame, reach: int, hours: int) -> DataFrame:
    """Halo partitioning for windows that look back ``reach`` hours: time is
    cut into slices of ``hours``, and each slice also gets copies of the
    ``reach`` hours before it. Adds ``_slice`` and ``_halo``; windows by
    (zone, slice) then see all that they need, and rows with ``_halo`` are
    dropped afterwards. So a window stage has zones x slices groups, however
    few the zones, each of ``reach + hours`` rows at most."""
    hour = F.expr("timestampdiff(HOUR, TIMESTAMP_NTZ'1970-01-01 00:00:00', timestamp)")
    own = F.floor(F.col("_hour") / hours).cast("long")
    last = F.floor((F.col("_hour") + reach) / hours).cast("long")  # the latest slice that looks back to this hour
    return (df.withColumn("_hour", hour)
            .withColumns({"_own": own, "_slice": F.explode(F.sequence(own, last))})
            .withColumn("_halo", F.col("_slice") != F.col("_own")).drop("_hour", "_own"))


def lag_rolling_features(df: DataFrame, cfg: Config) -> DataFrame:
    """WN1-WN7 (+FN14) over a dense (zone, hour) grid.

    ROW frames equal hour offsets because the grid is dense; the ordering
    by (zone, hour) the original sorts for (TK1) is the window's own
    sort, no global ORDER BY. Means need a
    full frame (NULL before, T3); std is the sample std of the previous
    three, 0.0 until three exist (T4). All share one Window node, whose
    groups are slices of a zone's time (``sliced``), not whole zones.
    """
    reach = max(*cfg.lag_hours, 24)
    w = Window.partitionBy("zone_id", "_slice").orderBy("timestamp")
    c = F.col("order_count")
    f3 = w.rowsBetween(-3, -1)
    cols = {f"lag_{k}h": F.lag(c, k).over(w).cast("double") for k in cfg.lag_hours}
    cols["rolling_mean_3h"] = _full_frame_mean(3, w)
    cols["rolling_mean_24h"] = _full_frame_mean(24, w)
    cols["rolling_std_3h"] = colf.std_or_zero(
        F.when(F.count(c).over(f3) == 3, F.stddev_samp(c).over(f3)))
    return sliced(df, reach, cfg.slice_hours).withColumns(cols).where("NOT _halo").drop("_slice", "_halo")


def features_from_zone_hours(zh: DataFrame, cfg: Config,
                             start: dt.datetime | None = None) -> DataFrame:
    """Grid, fills, calendar, lags and rollings from zone-hour rows."""
    grid = filled_grid(zh, cfg, start)
    out = lag_rolling_features(time_features(grid, cfg), cfg)
    return out.select(*FEATURE_ORDER)


def build_features(clean: DataFrame, cfg: Config,
                   start: dt.datetime | None = None) -> DataFrame:
    """The feature table (all of §2.3 features) from clean orders, lazily.

    As one plan the grid bounds are a second (column-pruned) scan of the
    orders; ``build_features_once`` avoids that by writing the small
    zone-hour table first.
    """
    return features_from_zone_hours(zone_hour_aggregate(clean), cfg, start)


def stored_zone_hours(clean: DataFrame) -> DataFrame:
    """AG1 written once to the shared checkpoint folder (zones x hours rows,
    independent of the order volume) and read back."""
    from zonecast.session import materialize  # noqa: PLC0415
    return materialize(zone_hour_aggregate(clean), "zone-hours")


def build_features_once(clean: DataFrame, cfg: Config,
                        start: dt.datetime | None = None) -> DataFrame:
    """Scan and aggregate the orders exactly once: the grid bounds, joins
    and windows read the small written zone-hour table."""
    return features_from_zone_hours(stored_zone_hours(clean), cfg, start)


def build_features_incremental(clean: DataFrame, cfg: Config, since: dt.datetime,
                               history_start: dt.datetime) -> DataFrame:
    """Features for hours >= ``since`` only, reading orders from since - 168 h.

    The longest look-back is the largest lag, so hours before
    ``since - max(lag)`` cannot change a row at or after ``since``.
    ``history_start`` is the first hour of the stored grid; it keeps the
    grid's lower edge where a full rebuild would put it.
    """
    reach = dt.timedelta(hours=max(max(cfg.lag_hours), 24))
    lower = max(history_start, since - reach)
    recent = clean.where(F.col("timestamp") >= F.lit(lower).cast("timestamp_ntz"))
    if cfg.date_partition_col in clean.columns:
        recent = recent.where(F.col(cfg.date_partition_col) >= F.lit(lower.date()))
    out = build_features_once(recent, cfg, start=lower)
    return out.where(F.col("timestamp") >= F.lit(since).cast("timestamp_ntz"))


def features_from_counts(counts: DataFrame, cfg: Config, start: dt.datetime | None = None) -> DataFrame:
    """The feature table from stored hour counts (no order is read); the
    zone-hour rows are written once, as grid bounds, joins and windows read
    them. ``start`` is the grid's first hour."""
    from zonecast.session import materialize  # noqa: PLC0415
    return features_from_zone_hours(materialize(zone_hours_from_partials(counts), "zone-hours"), cfg, start)
