"""Registered queries: incremental ingest/features, boosted trees, streams,
and the ingest/feature jobs themselves on a scratch store."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.functions import calendar as cal
from zonecast.operators import features as FE
from zonecast.operators import forecast as FC
from zonecast.operators import metrics as MET
from zonecast.operators import model as ML
from zonecast.operators import validate as V
from zonecast.plans import oracle as O
from zonecast.plans.catalog import (CFG, FEATURE_SELECT, ORDER_COLS, _FEAT, _VAL, _memo,
                                    clean, features, r6, raw, register)
from zonecast.plans.catalog_model import (_ACTUAL, _AVG7, _FORECAST, _HIST, _VALROWS, ALERT_CFG, _ALERTS,
                                          _metrics_sql)
from zonecast.plans.jobs import ingest_batch, read_new_orders, run_features, run_ingest, run_predictions
from zonecast.session import materialize
from zonecast.sources.adapters import events_as_orders
from zonecast.sources.schemas import RAW_ORDERS, TIME_INDEX
from zonecast.sources.store import Store
from zonecast.streaming import ingest_stream as S

# Fixed parameters of the incremental checks: state as after earlier runs.
WATERMARK = CFG.split_date          # SRC1: rows strictly after it
JOB_AS_OF = dt.datetime(2024, 1, 31, 1, 0)  # the jobs' run time (after the last event)

_WM = f"TIMESTAMP '{WATERMARK:%Y-%m-%d %H:%M:%S}'"


# ---- incremental ingest (SRC1, TK2, AG19, SNK11) ------------------------------------------

@register("incremental_batch", O.with_ctes(O.raw_cte(CFG), body=f"""
SELECT {ORDER_COLS} FROM raw
WHERE "timestamp" > {_WM} OR "timestamp" IS NULL"""))
def q_incremental_batch(spark, sf_dir):
    """SRC1, TK2: every row after the watermark or without an event time. The
    original's cap of 500,000 rows a run is not kept: it would only postpone
    rows that Spark reads in one pruned scan."""
    return read_new_orders(raw(spark, sf_dir), WATERMARK)


@register("batch_watermark", O.with_ctes(*_VAL, body=f"""
SELECT count(*) AS total_rows,
       count(*) FILTER (WHERE error_reason IS NULL) AS clean_rows,
       count(*) FILTER (WHERE error_reason IS NOT NULL) AS rejected_rows,
       max("timestamp") AS watermark
FROM validated WHERE "timestamp" > {_WM}"""))
def q_batch_watermark(spark, sf_dir):
    """AG19, SNK11, VAL12: the batch's counts and new watermark (newest event
    time, rejected rows included)."""
    batch = read_new_orders(raw(spark, sf_dir), WATERMARK)
    v = V.validate(batch, CFG, dedupe=False)
    return v.agg(F.count(F.lit(1)).alias("total_rows"),
                 F.count_if(F.col("error_reason").isNull()).alias("clean_rows"),
                 F.count_if(F.col("error_reason").isNotNull()).alias("rejected_rows"),
                 F.max("timestamp").alias("watermark"))


@register("incremental_features", O.with_ctes(*_FEAT, body=f"""
SELECT {FEATURE_SELECT} FROM features WHERE "timestamp" >= {_WM}"""))
def q_incremental_features(spark, sf_dir):
    """Incremental feature build: hours from the cut-off on, reading orders
    from cut-off - 168 h only; equals the full build on those hours."""
    c = clean(spark, sf_dir)
    start = c.agg(F.min(cal.floor_hour("timestamp"))).first()[0]  # stored-grid start (one value)
    out = FE.build_features_incremental(c, CFG, WATERMARK, start)
    return out.select(*[r6(x) if x == "rolling_std_3h" else F.col(x) for x in FE.FEATURE_ORDER])


# ---- boosted trees (ML1-ML6, ML8 with a learned scorer) -----------------------------------

def _trained(spark, sf_dir):
    feats = materialize(features(spark, sf_dir), "gbt-features")
    model, _tr, val = ML.train(feats, CFG)
    return feats, model, val


@register("gbt_metrics", O.with_ctes(*_FEAT, _HIST, _VALROWS, body=f"""
SELECT (SELECT count(*) FROM hist WHERE "timestamp" < {_WM}) AS train_rows, n_rows AS val_rows,
       round(mape, 6) AS baseline_mape, true AS metrics_finite, true AS gate_consistent
FROM (SELECT {_metrics_sql("order_count", "lag_168h")} FROM val)"""))
def q_gbt_metrics(spark, sf_dir):
    """ML1-ML6, WN10: fit all ``max_iter`` trees on the training part and
    evaluate on validation. Compared exactly: rows, baseline, and that the
    gate is the strict comparison; the trees' own numbers (MLlib's, not the
    original booster's) are held to the baseline by a test."""
    feats, model, val = _trained(spark, sf_dir)
    counts = MET.split_counts(feats, CFG)
    m = ML.evaluate_model(model, val)
    return counts.crossJoin(m).select(  # one row each
        "train_rows", F.col("n_rows").alias("val_rows"), r6("baseline_mape"),
        (F.greatest("mape", "rmse", "mae") < F.lit(float("inf"))).alias("metrics_finite"),
        (F.col("promoted") == (F.col("mape") < F.col("baseline_mape"))).alias("gate_consistent"))


@register("gbt_forecast", O.with_ctes(*_FEAT, body=f"""
SELECT zone_id, t + to_hours(step) AS forecast_hour, CAST(step AS INTEGER) AS step, true AS non_negative
FROM (SELECT DISTINCT zone_id FROM features), (SELECT max("timestamp") AS t FROM features),
     (SELECT unnest(range(1, {CFG.horizon + 1})) AS step)"""))
def q_gbt_forecast(spark, sf_dir):
    """ML8 with the trained model as scorer: T+1, T+2 for every zone. The
    model goes through its artefact life cycle first: saved under a
    time-stamped name (SNK12), pointer moved, located and loaded (SRC6)."""
    feats, model, _val = _trained(spark, sf_dir)
    st = Store(spark, S.scratch(spark, "gbt-store"), CFG)
    model_dir = S.scratch(spark, "gbt-models")
    st.set_model_pointer(ML.save_model(model, model_dir, JOB_AS_OF), JOB_AS_OF)
    loaded, _path = ML.load_latest_model(st, model_dir)
    fc = FC.forecast(feats, ML.gbt_scorer(loaded), CFG)
    return fc.select("zone_id", "forecast_hour", "step",
                     (F.col("predicted_order_count") >= 0).alias("non_negative"))


# ---- streaming (SM1-SM3) ------------------------------------------------------------------

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def _order_stream(spark, sf_dir):
    ev = S.read_stream(spark, sf_dir, EVENTS_SCHEMA, glob="events.parquet")
    return events_as_orders(ev, CFG)


@register("stream_validated", O.with_ctes(*_VAL, body=f"SELECT {ORDER_COLS} FROM clean"))
def q_stream_validated(spark, sf_dir):
    """SM1: file stream -> validation per micro-batch -> clean / quarantine
    files; the drained clean output equals the batch result."""
    base = S.scratch(spark, "stream-validated")
    S.validate_stream(spark, _order_stream(spark, sf_dir), CFG, f"{base}/clean",
                      f"{base}/rejected", f"{base}/_checkpoint")
    return spark.read.parquet(f"{base}/clean").drop("batch")


@register("stream_dedup", O.with_ctes(O.raw_cte(CFG), body=f"""
SELECT {ORDER_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY "timestamp") AS rn FROM raw)
WHERE rn = 1"""))
def q_stream_dedup(spark, sf_dir):
    """SM2: order_id duplicates suppressed within a 1-hour event-time bound."""
    base = S.scratch(spark, "stream-dedup")
    S.drain_append(S.dedupe_stream(_order_stream(spark, sf_dir)), f"{base}/out",
                   f"{base}/_checkpoint")
    return spark.read.parquet(f"{base}/out").drop("batch")


@register("stream_hourly_counts", O.with_ctes(*_VAL, _ACTUAL, body="SELECT * FROM actual"))
def q_stream_hourly_counts(spark, sf_dir):
    """SM3: tumbling 1-hour counts per zone over the validated stream
    (watermark 2 h), drained in update mode; equals AG6."""
    base = S.scratch(spark, "stream-hourly")
    orders = _order_stream(spark, sf_dir)
    clean_stream = V.clean_from_orders(orders, CFG)
    S.drain_update(S.hourly_counts_stream(clean_stream), f"{base}/out", f"{base}/_checkpoint")
    return S.latest_updates(spark.read.parquet(f"{base}/out"), ["zone_id", "hour_timestamp"])


# ---- the jobs themselves on a scratch store (SNK1-SNK3, SNK11, SRC1-SRC5) -----------------

def _ingested_store(spark, sf_dir) -> Store:
    def make() -> Store:
        st = Store(spark, S.scratch(spark, "job-store"), CFG)
        st.append("raw_orders", raw(spark, sf_dir))
        run_ingest(st, CFG, JOB_AS_OF)
        return st
    return _memo(("store", sf_dir), make)


@register("job_ingest_clean", O.with_ctes(*_VAL, body=f"SELECT {ORDER_COLS} FROM clean"))
def q_job_ingest_clean(spark, sf_dir):
    """The ingest job on a fresh date-partitioned store (SRC1 watermark read,
    SRC2 and SRC4 declared reads, SRC5 dt partitions, dedup, VAL1-VAL12, SNK1,
    SNK11); its clean_orders table equals the batch result."""
    st = _ingested_store(spark, sf_dir)
    return st.read_table("clean_orders").drop("ingested_at", CFG.date_partition_col)


@register("job_ingest_rejected", O.with_ctes(*_VAL, body="""
SELECT order_id, zone_id, "timestamp", order_value, items_count, delivery_time_mins,
       coalesce(is_weekend, false) AS is_weekend, weather_condition,
       coalesce(is_festival_day, false) AS is_festival_day, error_reason
FROM validated WHERE error_reason IS NOT NULL"""))
def q_job_ingest_rejected(spark, sf_dir):
    """The ingest job's quarantine table (SNK2, VAL10)."""
    st = _ingested_store(spark, sf_dir)
    return st.read_table("validation_errors").drop(
        "rejected_at", "error_id", CFG.date_partition_col)


@register("job_features", O.with_ctes(*_FEAT, body=f"SELECT {FEATURE_SELECT} FROM features"))
def q_job_features(spark, sf_dir):
    """Ingest, then the feature job (orders scanned once, versioned
    overwrite SNK3, read back through the commit log SRC3); the committed
    version equals the feature table."""
    st = _ingested_store(spark, sf_dir)
    run_features(st, CFG, JOB_AS_OF)
    out = st.read_table("features")
    return out.select(*[r6(x) if x == "rolling_std_3h" else F.col(x) for x in FE.FEATURE_ORDER])


@register("stream_store_clean", O.with_ctes(*_VAL, body=f"SELECT {ORDER_COLS} FROM clean"))
def q_stream_store_clean(spark, sf_dir):
    """SM1 into the store: the order stream runs through the ingest job's
    per-batch step (dedup, VAL1-VAL12, keyed appends SNK1/SNK2); the stored
    clean_orders table equals the batch result."""
    st = Store(spark, S.scratch(spark, "stream-store"), CFG)
    S.ingest_stream_to_store(st, CFG, _order_stream(spark, sf_dir),
                             S.scratch(spark, "stream-store-ckpt"), lambda _b: JOB_AS_OF)
    return st.read_table("clean_orders").drop("ingested_at", CFG.date_partition_col)


# ---- re-sent, late and untimed orders (SNK1, SNK2, SRC1, SM1) -------------------------------

def _resent(orders, late: bool):
    """A second delivery derived from the first: every 7th order again with a
    later time, every 11th without its id, every 13th without its time."""
    n = F.pmod(F.xxhash64("order_id"), F.lit(1001))
    out = orders.withColumn("_n", n).where("_n % 7 = 0 OR _n % 11 = 0 OR _n % 13 = 0")
    shift = F.col("timestamp") + F.expr("INTERVAL 3 DAYS")
    return out.withColumns({
        "timestamp": F.when(F.col("_n") % 13 == 0, F.lit(None)).otherwise(shift if late else F.col("timestamp")),
        "order_id": F.when(F.col("_n") % 11 == 0, F.lit(None)).otherwise(F.col("order_id")),
    }).drop("_n")


def _deliveries(spark, sf_dir):
    """First delivery and second, written, so both sides read the same rows."""
    def make():
        first = materialize(raw(spark, sf_dir), "first-delivery")
        return first, materialize(_resent(first, True), "second-delivery")
    return _memo(("deliveries", sf_dir), make)


_RESENT_CLEAN = f"SELECT {ORDER_COLS} FROM clean"


def _resent_store(spark, sf_dir) -> Store:
    def make() -> Store:
        st = Store(spark, S.scratch(spark, "resent-store"), CFG)
        for k, rows in enumerate(_deliveries(spark, sf_dir)):
            st.append("raw_orders", rows)
            for retry in range(2):  # each batch is run again, as after a lost reply
                run_ingest(st, CFG, JOB_AS_OF + dt.timedelta(hours=2 * k + retry))
        return st
    return _memo(("resent", sf_dir), make)


@register("job_ingest_resent", O.with_ctes(*_VAL, body=_RESENT_CLEAN))
def q_job_ingest_resent(spark, sf_dir):
    """SNK1: re-sent orders (later times, lost ids and times, each batch run
    twice) add nothing to clean_orders, whose key holds over all time."""
    st = _resent_store(spark, sf_dir)
    return st.read_table("clean_orders").drop("ingested_at", CFG.date_partition_col)


def _write_batches(rows, batches: int, path: str) -> int:
    """Orders as the files of ``batches`` micro-batches; returns the number of
    files of each, one a core, so that a micro-batch isn't one task's work."""
    files = rows.sparkSession.sparkContext.defaultParallelism
    rows.repartition(batches * files, "order_id", "timestamp").write.parquet(path)
    return files


@register("stream_ingest_resent", O.with_ctes(*_VAL, body=_RESENT_CLEAN))
def q_stream_ingest_resent(spark, sf_dir):
    """SM1, SM2, SNK1: both deliveries as one and two micro-batches of as many
    files as the cluster has cores, replayed under a second checkpoint."""
    base = S.scratch(spark, "stream-resent")
    for k, rows in enumerate(_deliveries(spark, sf_dir)):
        files_a_batch = _write_batches(rows, 1 + k, f"{base}/src/part={k}")
    st = Store(spark, f"{base}/store", CFG)
    for replay in range(2):
        files = S.read_stream(spark, f"{base}/src", RAW_ORDERS, max_files=files_a_batch)
        S.ingest_stream_to_store(st, CFG, files, f"{base}/ckpt-{replay}",
                                 lambda b: JOB_AS_OF + dt.timedelta(minutes=b))
    return st.read_table("clean_orders").drop("ingested_at", CFG.date_partition_col)


def _is_late():
    late = (F.pmod(F.xxhash64("order_id"), F.lit(5)) == 0) & (F.col("timestamp") > F.lit(WATERMARK))
    return F.coalesce(late, F.lit(False))


def _late(rows):
    return rows.where(_is_late())


@register("stream_late_counts", O.with_ctes(*_VAL, _ACTUAL, body="SELECT * FROM actual"))
def q_stream_late_counts(spark, sf_dir):
    """SM3: the newer half of the orders arrives first, so most of the older
    half is behind the line; counts reconciled with the late rows equal AG6."""
    base = S.scratch(spark, "stream-late")
    rows = materialize(raw(spark, sf_dir), "late-stream").where("timestamp IS NOT NULL")
    newer = F.col("timestamp") >= F.lit(CFG.split_date - dt.timedelta(days=9))
    for k, part in enumerate((rows.where(newer), rows.where(~newer))):
        part.coalesce(1).write.parquet(f"{base}/src/part={k}")
    S.count_with_late_rows(S.read_stream(spark, f"{base}/src", RAW_ORDERS, max_files=1), CFG, base, f"{base}/ckpt")
    return S.reconciled_counts(spark, base).drop("late_count")


@register("job_features_late", O.with_ctes(*_FEAT, body=f"SELECT {FEATURE_SELECT} FROM features"))
def q_job_features_late(spark, sf_dir):
    """Orders that arrive after the features of their hour were stored: the
    incremental job recomputes from the oldest of them and equals the full
    build."""
    st = Store(spark, S.scratch(spark, "late-store"), CFG)
    rows = materialize(raw(spark, sf_dir), "late-orders")
    for k, part in enumerate((rows.where(~_is_late()), _late(rows))):
        as_of = JOB_AS_OF + dt.timedelta(hours=k)
        ingest_batch(st, CFG, part, as_of, since=CFG.initial_watermark)
        run_features(st, CFG, as_of)
    return st.read_table("features").select(
        *[r6(x) if x == "rolling_std_3h" else F.col(x) for x in FE.FEATURE_ORDER])


@register("job_features_reloaded", O.with_ctes(*_FEAT, body="""
SELECT zone_id, count(*) AS n_rows FROM features GROUP BY zone_id"""))
def q_job_features_reloaded(spark, sf_dir):
    """SNK3, SRC3: three reloads, the last with the oldest run time; readers
    get the version committed last."""
    st = Store(spark, S.scratch(spark, "reload-store"), CFG)
    feats = features(spark, sf_dir)
    for k, part in ((0, feats.limit(0)), (0, feats.where("order_count > 0")), (-1, feats)):
        st.overwrite_versioned("features", part, JOB_AS_OF + dt.timedelta(hours=k))
    return st.read_table("features").groupBy("zone_id").agg(F.count("*").alias("n_rows"))


@register("job_features_expired", O.with_ctes(*_FEAT, body="""
SELECT zone_id, count(*) AS n_rows, 3 AS n_versions, 3 AS n_commits FROM features GROUP BY zone_id"""))
def q_job_features_expired(spark, sf_dir):
    """SNK3, SRC3: after 20 reloads, each followed by expiry, readers get the
    newest version and the folder holds the stated number of versions."""
    st = Store(spark, S.scratch(spark, "expiry-store"), CFG)
    feats = features(spark, sf_dir)
    one = feats.where(F.col("zone_id") == CFG.zones[0])
    for k in range(20):
        st.overwrite_versioned("features", feats if k == 19 else one, JOB_AS_OF + dt.timedelta(hours=k))
        st.expire("features", 3)
    versions = [d for d in st.list_dirs(st.path("features")) if d.startswith("v=")]
    return st.read_table("features").groupBy("zone_id").agg(
        F.count("*").alias("n_rows"), F.lit(len(versions)).alias("n_versions"),
        F.lit(len(st.log("features").all())).alias("n_commits"))


@register("job_known_ids", O.with_ctes(*_VAL, body="SELECT order_id FROM clean"))
def q_job_known_ids(spark, sf_dir):
    """SNK1, SRC1: which ids of all raw orders are stored, found through the
    key summaries of several batches, before and after the summaries of all
    dates but the last ones are compacted (an id counts if both say so)."""
    st = _resent_store(spark, sf_dir)
    ids = raw(spark, sf_dir).select("order_id").where("order_id IS NOT NULL").distinct()
    before = materialize(st.known_ids(ids)[0], "known-before")
    st.compact_key_summaries(WATERMARK.date())
    return st.known_ids(ids)[0].join(before, "order_id")


@register("job_hour_counts", O.with_ctes(*_VAL, body="""
SELECT zone_id, date_trunc('hour', "timestamp")::TIMESTAMP AS "timestamp", weather_condition,
       count(order_id) AS n, count(*) AS "rows", max(is_festival_day) AS fest
FROM clean GROUP BY ALL"""))
def q_job_hour_counts(spark, sf_dir):
    """AG1, SNK3: the hour counts of all stored orders, merged from a
    compacted base and the deltas of later (and retried) batches."""
    st = _resent_store(spark, sf_dir)
    ingests = st.log("ingests").all()
    st.compact_zone_hour_counts(JOB_AS_OF, CFG.keep_versions)
    late = _late(raw(spark, sf_dir)).limit(0)  # one more, empty batch after the base
    ingest_batch(st, CFG, late, JOB_AS_OF + dt.timedelta(days=1), since=CFG.initial_watermark)
    return st.zone_hour_counts(ingests[-1]["seq"] + 1)


_SINCE = JOB_AS_OF - dt.timedelta(hours=CFG.drift_lookback_hours)


@register("job_recent_orders", O.with_ctes(*_VAL, body=f"""
SELECT {ORDER_COLS} FROM clean WHERE "timestamp" >= TIMESTAMP '{_SINCE:%Y-%m-%d %H:%M:%S}'"""))
def q_job_recent_orders(spark, sf_dir):
    """SRC5, FLT6: the drift check's look-back window through the time index
    of the clustered order files."""
    st = _ingested_store(spark, sf_dir)
    since = F.lit(_SINCE).cast("timestamp_ntz")
    recent = st.read_indexed("clean_orders").where(
        (F.col(CFG.date_partition_col) >= F.to_date(since)) & (F.col(TIME_INDEX) >= F.unix_micros(since.cast("timestamp"))))
    return recent.drop("ingested_at", TIME_INDEX, CFG.date_partition_col)


# ---- the jobs over several runs, and the logs they write (SNK4-SNK10) ------------------------

def _at(minutes: int) -> dt.datetime:
    return JOB_AS_OF + dt.timedelta(minutes=minutes)


def operated_store(spark, sf_dir) -> Store:
    """Two deliveries through ingest, features and predictions (linear
    scorer), an empty ingest, and two failing prediction runs."""
    def make() -> Store:
        st = Store(spark, S.scratch(spark, "operated-store"), CFG)
        rows = raw(spark, sf_dir)
        early = F.coalesce(F.col("timestamp") <= F.lit(WATERMARK), F.lit(True))
        predict = lambda minutes, scorer: run_predictions(
            st, ALERT_CFG, _at(minutes), f"{st.root}/models", scorer)
        for minutes, scorer in ((0, FC.linear_scorer()), (90, None)):
            if minutes:
                st.append("raw_orders", rows.where(early))
                run_ingest(st, CFG, _at(10))
                run_features(st, CFG, _at(20))
                predict(30, FC.linear_scorer())
                st.append("raw_orders", rows.where(~early))
                run_ingest(st, CFG, _at(40))
                run_ingest(st, CFG, _at(50))
                run_features(st, CFG, _at(60))
                predict(70, FC.linear_scorer())
                predict(70, FC.linear_scorer())  # a retry
            try:  # no features yet; later no model
                predict(minutes, scorer)
            except (ValueError, FileNotFoundError):
                pass
        return st
    return _memo(("operated", sf_dir), make)


_LAST = f"TIMESTAMP '{_at(70):%Y-%m-%d %H:%M:%S}'"


@register("job_predictions", O.with_ctes(*_FORECAST, _AVG7, _ALERTS, body=f"""
SELECT f.zone_id, f.forecast_hour, f.predicted_order_count, {_LAST} AS generated_at,
       CASE WHEN a.zone_id IS NULL THEN 'NORMAL' ELSE 'HIGH_DEMAND' END AS confidence_flag,
       true AS has_id
FROM forecast f LEFT JOIN alerts_now a ON a.zone_id = f.zone_id AND a.forecast_hour = f.forecast_hour"""))
def q_job_predictions(spark, sf_dir):
    """SNK4, SNK6, JN9: the newest stored batch, flags applied on read; a
    retried run adds nothing."""
    p = operated_store(spark, sf_dir).read_predictions().where(F.col("generated_at") == F.lit(_at(70)))
    return p.select("zone_id", "forecast_hour", "predicted_order_count", "generated_at", "confidence_flag",
                    F.col("prediction_id").isNotNull().alias("has_id"))


@register("job_alerts", O.with_ctes(*_FORECAST, _AVG7, _ALERTS, body=f"""
SELECT zone_id, alert_type, message, {_LAST} AS created_at, true AS has_id FROM alerts_now"""))
def q_job_alerts(spark, sf_dir):
    """SNK5: the alerts stored by the newest prediction run."""
    a = operated_store(spark, sf_dir).read_table("alerts").where(F.col("created_at") == F.lit(_at(70)))
    return a.select("zone_id", "alert_type", "message", "created_at", F.col("alert_id").isNotNull().alias("has_id"))


@register("job_flags", O.with_ctes(*_FORECAST, _AVG7, _ALERTS, body=f"""
SELECT zone_id, forecast_hour, 'HIGH_DEMAND' AS flag, {_LAST} AS flagged_at FROM alerts_now"""))
def q_job_flags(spark, sf_dir):
    """SNK6: one stored flag a zone and hour, whatever the retries."""
    return operated_store(spark, sf_dir).read_table("prediction_flags").where(F.col("flagged_at") == F.lit(_at(70)))
