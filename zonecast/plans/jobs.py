"""The four jobs of the original schedule as plain functions.

ingest (hourly) -> features (hourly) -> training (daily) -> predictions
(hourly). Each logs a SUCCESS row with its row count, or a FAILED row with
0 and re-raises (SNK8, SNK9). ``as_of`` replaces NOW() everywhere (T27)
so runs are reproducible. Scheduling, retries and hand-offs belong to the
orchestrator that calls these functions; nothing is passed between them
except the stored tables.
"""

from __future__ import annotations

import datetime as dt
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.config import DAG_NAMES, RUN_FAILED, RUN_SUCCESS, Config
from zonecast.operators import features as FE
from zonecast.operators import forecast as FC
from zonecast.operators import metrics as MET
from zonecast.operators import model as ML
from zonecast.operators import monitor as MON
from zonecast.operators import validate as V
from zonecast.session import materialize
from zonecast.sources.schemas import ORDER_FIELDS, SCHEMAS
from zonecast.sources.store import Store


def log_run(store: Store, dag: str, status: str, rows: int, as_of: dt.datetime) -> None:
    """SNK8 / SNK9: one pipeline_runs row."""
    row = store.spark.createDataFrame([(dag, as_of, status, int(rows), None)],
                                      SCHEMAS["pipeline_runs"])
    store.append("pipeline_runs", row.withColumn("run_id", F.xxhash64("dag_name", "run_time", "status")))


@contextmanager
def _logged(store: Store, dag: str, as_of: dt.datetime):
    box = {"rows": 0}
    try:
        yield box
    except Exception:
        log_run(store, dag, RUN_FAILED, 0, as_of)
        raise
    log_run(store, dag, RUN_SUCCESS, box["rows"], as_of)


def read_new_orders(raw: DataFrame, watermark: dt.datetime, part_col: str | None = "dt") -> DataFrame:
    """SRC1 + TK2: every row after the watermark, and every row without an
    event time (the caller drops those stored already). All of them: the
    batch grows with the backlog, the reading is pruned to its partitions."""
    out = raw
    if part_col and part_col in raw.columns:
        out = out.where((F.col(part_col) >= F.lit(watermark.date())) | F.col(part_col).isNull())
    ts = F.col("timestamp")
    return out.where((ts > F.lit(watermark).cast("timestamp_ntz")) | ts.isNull())


def ingest_batch(store: Store, cfg: Config, batch: DataFrame, as_of: dt.datetime,
                 since: dt.datetime) -> dict:
    """Validate, dedup and append one batch (SNK1, SNK2, VAL1-VAL12).

    The batch is staged once on shared storage with two booleans per row (no
    text); reason text is built for rejected rows only. An order is stored
    once for all time (``order_keys``, found through Bloom summaries); a
    rejected row once per value and repeat (a null-safe hash), so a retried
    batch adds nothing. The hour counts of the stored orders are written as
    the batch's delta, and one commit makes batch, keys and counts count.
    Batches are ingested one at a time (one hourly job). Every raw row
    is either clean, a duplicate of a clean order, or quarantined. ``since``
    bounds the partitions the checks read. Shared by the hourly job and the
    streaming sink.
    """
    order_cols = [c for c, _, _ in ORDER_FIELDS]
    staged = materialize(V.with_flags(batch, cfg), "ingest-batch")
    clean, rejected = V.split_flagged(staged, cfg)
    clean = materialize(V.dedupe_orders(clean), "ingest-clean")
    stamp = F.lit(as_of).cast("timestamp_ntz")
    name = uuid.uuid4().hex
    stored = store.append_new_orders(clean.withColumn("ingested_at", stamp), since, name)
    store.write_delta(FE.zone_hour_partials(stored), name)
    rejected = V.with_error_id(rejected, order_cols).withColumn("rejected_at", stamp)
    store.append("validation_errors", rejected, key=["error_id"], since=since)
    counts = staged.agg(*V.flag_counts()).first().asDict()
    bounds = clean.agg(F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("oldest")).first()
    counts["clean_rows"] = bounds["n"]  # one per order
    store.commit_batch(name, bounds["n"], bounds["oldest"], as_of)
    return counts


def run_ingest(store: Store, cfg: Config, as_of: dt.datetime) -> dict:
    """Job 1: raw_orders -> clean_orders | validation_errors, watermark."""
    with _logged(store, DAG_NAMES[0], as_of) as box:
        wm = store.watermark("raw_orders", cfg.initial_watermark)
        part = cfg.date_partition_col
        batch = read_new_orders(store.read_table("raw_orders"), wm, part)
        batch = batch.drop(part) if part in batch.columns else batch
        # Rows without an event time are read again each run: drop the stored ones.
        stored = store.read_table("validation_errors").where(
            F.col(part).isNull() & F.col("timestamp").isNull()).select("error_id")
        untimed = V.with_error_id(batch.where(F.col("timestamp").isNull()),
                                  [c for c, _, _ in ORDER_FIELDS])
        batch = (batch.where(F.col("timestamp").isNotNull())
                 .unionByName(untimed.join(stored, "error_id", "left_anti").drop("error_id")))
        if batch.isEmpty():  # SNK10: log 0 and stop (T23)
            return {"total_rows": 0, "clean_rows": 0, "rejected_rows": 0, "watermark": wm}
        m = ingest_batch(store, cfg, batch, as_of, since=wm)
        # SNK11: the newest event time of the batch, rejected rows included.
        newest = m["max_timestamp"] or wm
        store.save_watermark("raw_orders", newest, as_of)
        box["rows"] = m["clean_rows"]  # VAL12: rows_processed = clean rows
        return {**m, "watermark": newest}


def _incremental(store: Store, cfg: Config, last: dict, upto: int, ingests: list[dict]):
    """(rows, dates) to replace in the last commit, or None if the grid
    itself must be built again."""
    current = store.read_version("features", last)
    dates = sorted(dt.date.fromisoformat(d) for d in last["parts"])
    lo, hi = dates[0], dates[-1]
    oldest = [c["oldest"].date() for c in ingests if c["seq"] > last["upto"] and c["oldest"] is not None]
    since = min([*oldest, hi])  # the newest day may have been partial
    if since <= lo:
        return None
    first = current.where(F.col("timestamp") < F.lit(lo + dt.timedelta(days=1))).agg(F.min("timestamp")).first()[0]
    midnight = dt.datetime.combine(since, dt.time())
    lower = max(first, midnight - dt.timedelta(hours=max(max(cfg.lag_hours), 24)))
    new = FE.features_from_counts(store.zone_hour_counts(upto, lower), cfg, lower)
    return (new.where(F.col("timestamp") >= F.lit(midnight).cast("timestamp_ntz")),
            {since + dt.timedelta(days=k) for k in range((hi - since).days + 1)})


def run_features(store: Store, cfg: Config, as_of: dt.datetime,
                 incremental: bool = True) -> str:
    """Job 2: hour counts -> features (new committed version, SNK3).

    Merges the counts that ingests have left since the last version; orders
    are not read again. Recomputes from the oldest day that they touch (late
    orders included) and writes those dates only; the other dates stay in the
    versions that hold them. The result equals a full build from
    clean_orders, which ``incremental=False`` does. Old versions expire.
    """
    with _logged(store, DAG_NAMES[1], as_of) as box:
        def build(last):
            ingests = store.log("ingests").all()
            upto = ingests[-1]["seq"] if ingests else 0
            if not incremental or not ingests:
                return FE.build_features_once(store.read_table("clean_orders"), cfg), None, upto
            part = _incremental(store, cfg, last, upto, ingests) if last and last["parts"] else None
            if part is None:
                return FE.features_from_counts(store.zone_hour_counts(upto), cfg), None, upto
            return (*part, upto)

        version = store.reload("features", build, as_of)
        box["rows"] = store.last_commit("features")["rows"]
        store.expire("features", cfg.keep_versions)
        base = store.last_commit("zone_hour_counts")
        if store.last_commit("features")["upto"] - (base["upto"] if base else 0) >= cfg.compact_every:
            store.compact_zone_hour_counts(as_of, cfg.keep_versions)
        return version


def run_training(store: Store, cfg: Config, as_of: dt.datetime, model_dir: str,
                 force_daily: bool = True, max_iter: int | None = None) -> dict:
    """Job 3: drift check (ML7), fit, evaluate, gate, save, log (SNK7, SNK12)."""
    with _logged(store, DAG_NAMES[2], as_of) as box:
        have_model = store.model_pointer() is not None  # a promoted one
        try:
            pairs = MON.drift_pairs(store.read_predictions(), store.read_indexed("clean_orders"),
                                    as_of, cfg)
            decision = MON.drift_decision(pairs, cfg, have_model, force_daily).first().asDict()
        except Exception as e:  # noqa: BLE001 - ML7: a failed check retrains
            decision = {"n_pairs": None, "mape": None, "trigger": True,
                        "reason": MON.DRIFT_REASONS["error"], "error": repr(e)}
        if not decision["trigger"]:
            return {"decision": decision, "trained": False}
        with store.leased("features") as feats:
            if feats.isEmpty():
                raise ValueError("features table is empty; run the feature job first")
            try:
                model, _tr, val = ML.train(feats, cfg, max_iter=max_iter)
            except ML.TrainingSkipped as e:  # ML6: too little data is a skip, not a failure
                return {"decision": decision, "trained": False, "skipped": str(e)}
            counts = MET.split_counts(feats, cfg).first()
            m = ML.evaluate_model(model, val).first().asDict()
        promoted = ML.promote(m["mape"], m["baseline_mape"])
        path = ML.save_model(model, model_dir, as_of)
        if promoted:
            store.set_model_pointer(path, as_of)
        run = store.spark.createDataFrame([(
            f"run_{as_of:%Y%m%d_%H%M%S}", as_of, int(counts["train_rows"]), int(counts["val_rows"]),
            float(m["mape"]), float(m["rmse"]), float(m["mae"]), path, promoted,
            float(m["baseline_mape"]))], SCHEMAS["model_runs"])
        store.append("model_runs", run)
        box["rows"] = int(counts["train_rows"])
        return {"decision": decision, "trained": True, "promoted": promoted, "path": path, **m}


def run_predictions(store: Store, cfg: Config, as_of: dt.datetime, model_dir: str,
                    scorer=None) -> int:
    """Job 4: locate model (SRC6) unless a scorer is given, forecast (ML8),
    append (SNK4), alerts (ML11, SNK5) and flags (SNK6)."""
    with _logged(store, DAG_NAMES[3], as_of) as box:
        if scorer is None:
            scorer = ML.gbt_scorer(ML.load_latest_model(store, model_dir)[0])
        with store.leased("features") as feats:
            if feats.isEmpty():
                raise ValueError("features table is empty; run the feature job first")
            stamp = F.lit(as_of).cast("timestamp_ntz")
            preds = FC.prediction_rows(FC.forecast(feats, scorer, cfg), stamp).withColumn(
                "prediction_id", F.xxhash64("zone_id", "forecast_hour", "generated_at"))
            # Keyed appends: a retried run with the same as_of adds nothing twice;
            # the key holds the run time, so only its partition is checked.
            store.append("predictions", preds, key=["zone_id", "forecast_hour", "generated_at"], since=as_of)
            batch = store.read_table("predictions").where(
                (F.col(cfg.date_partition_col) == F.lit(as_of.date())) & (F.col("generated_at") == stamp))
            alerts = MON.high_demand(batch, MON.seven_day_avg(feats), cfg).withColumn("created_at", stamp)
            alerts = materialize(alerts.withColumn("alert_id", F.xxhash64("zone_id", "created_at", "message")), "alerts")
            store.append("alerts", alerts, key=["zone_id", "created_at", "message"], since=as_of)
            box["rows"] = batch.count()
            store.flag(alerts, as_of)  # rewrites the dates it touches
            return box["rows"]
