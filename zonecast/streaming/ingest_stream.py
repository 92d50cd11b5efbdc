"""Streaming re-aim of the hourly polling ingest (SM1-SM3).

The original polls a high-water mark every hour. Here a file stream of
order files is the source; the stream's checkpoint replaces the stored
watermark (each file is processed once), ``availableNow`` gives the
hourly cadence, and sinks are ``foreachBatch`` writes, so each micro-batch
is an ordinary distributed DataFrame write (idempotent per batch id).

Event-time watermarks need TIMESTAMP, not TIMESTAMP_NTZ, so the stream
works on a zoned copy of the event time (session zone is UTC) and casts
back on output.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.config import DAG_NAMES, RUN_SUCCESS, Config
from zonecast.functions import calendar as cal
from zonecast.operators import validate as V
from zonecast.session import materialize, scratch_path
from zonecast.sources.commits import CommitLog

EVENT_TIME = "event_time"


def read_stream(spark: SparkSession, path: str, schema: T.StructType,
                glob: str | None = None, max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def with_event_time(orders: DataFrame) -> DataFrame:
    return orders.withColumn(EVENT_TIME, F.col("timestamp").cast("timestamp"))


def dedupe_stream(orders: DataFrame, delay: str = "1 hour") -> DataFrame:
    """SM2: primary-key suppression with bounded state: a copy of an order
    arriving within ``delay`` of the newest event time is dropped."""
    return (with_event_time(orders).withWatermark(EVENT_TIME, delay)
            .dropDuplicatesWithinWatermark(["order_id"]).drop(EVENT_TIME))


def hourly_counts_stream(clean: DataFrame, delay: str = "2 hours") -> DataFrame:
    """SM3: tumbling 1-hour order counts per zone with a late-data bound.

    In append mode a window is emitted once the watermark (newest event
    time - ``delay``) passes its end. Spark drops late input against the
    watermark of the previous micro-batch, so the bound takes effect one
    batch after the watermark moves.
    """
    return (with_event_time(clean).withWatermark(EVENT_TIME, delay)
            .groupBy(F.window(EVENT_TIME, "1 hour"), "zone_id")
            .agg(F.count(F.lit(1)).alias("order_count"))
            .select("zone_id", F.col("window.start").cast("timestamp_ntz").alias("hour_timestamp"),
                    "order_count"))


def count_with_late_rows(orders: DataFrame, cfg: Config, base: str, checkpoint: str,
                         delay: dt.timedelta = dt.timedelta(hours=2)) -> None:
    """SM3 with a side path: clean orders of hours that ended ``delay`` before
    the newest event time of earlier batches are late. They are kept in a
    table of their own and counted beside the others, instead of being dropped
    as a windowed aggregate behind a watermark does. Each batch leaves partial
    counts under its id (a replay overwrites them) and, in a commit log, the
    newest event time, so a replayed batch draws the same line."""
    spark = orders.sparkSession
    log = CommitLog(spark, f"{base}/_progress")

    def sink(batch: DataFrame, batch_id: int) -> None:
        progress = log.all()
        seen = [c["newest"] for c in progress if c["batch"] < batch_id and c["newest"] is not None]
        ends = F.col("hour_timestamp") + F.expr("INTERVAL 1 HOUR")
        late = ends <= F.lit(max(seen) - delay).cast("timestamp_ntz") if seen else F.lit(False)
        rows = V.clean_from_orders(batch, cfg).withColumn("hour_timestamp", cal.floor_hour("timestamp"))
        rows = materialize(rows.withColumn("late", late), "late-split")
        counts = rows.groupBy("zone_id", "hour_timestamp", "late").agg(F.count(F.lit(1)).alias("order_count"))
        counts.write.mode("overwrite").parquet(f"{base}/counts/batch={batch_id}")
        rows.where("late").drop("late").write.mode("overwrite").parquet(f"{base}/late/batch={batch_id}")
        newest = rows.agg(F.max("timestamp")).first()[0]
        if all(c["batch"] != batch_id for c in progress):
            log.commit(lambda _last: {"batch": batch_id, "newest": newest})
    _run(orders, sink, checkpoint)


def reconciled_counts(spark: SparkSession, base: str) -> DataFrame:
    """Orders per zone and hour, those that came late included, and how many
    of them did."""
    return (spark.read.parquet(f"{base}/counts").groupBy("zone_id", "hour_timestamp")
            .agg(F.sum("order_count").alias("order_count"),
                 F.sum(F.when(F.col("late"), F.col("order_count")).otherwise(0)).alias("late_count")))


def _run(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str,
         mode: str = "append", timeout_s: int | None = None) -> None:
    q = (df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
         .foreachBatch(sink).trigger(availableNow=True).start())
    q.awaitTermination(timeout_s)
    if q.exception():
        raise q.exception()


def validate_stream(spark: SparkSession, orders: DataFrame, cfg: Config, clean_path: str,
                    rejected_path: str, checkpoint: str) -> None:
    """SM1: each micro-batch is validated and split into clean and rejected
    files; a replayed batch id overwrites its own output directory, so a
    retried batch never duplicates rows."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        flagged = V.with_flags(batch, cfg).persist()
        try:
            clean, rejected = V.split_flagged(flagged, cfg)
            clean.write.mode("overwrite").parquet(f"{clean_path}/batch={batch_id}")
            rejected.write.mode("overwrite").parquet(f"{rejected_path}/batch={batch_id}")
        finally:
            flagged.unpersist()
    _run(orders, sink, checkpoint)


def ingest_stream_to_store(store, cfg: Config, orders: DataFrame, checkpoint: str,
                           as_of_fn: Callable[[int], dt.datetime] | None = None) -> None:
    """SM1 into the store: each micro-batch goes through the ingest job's
    per-batch step (dedup, validation, keyed appends into clean_orders and
    validation_errors), so the feature job reads stream-fed tables. A
    replayed batch adds nothing (keyed appends); the stream checkpoint
    plays the stored watermark's role."""
    from zonecast.plans.jobs import ingest_batch, log_run  # noqa: PLC0415 - jobs is a layer above

    as_of_fn = as_of_fn or (lambda _batch_id: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))

    def sink(batch: DataFrame, batch_id: int) -> None:
        oldest = batch.agg(F.min("timestamp")).first()[0]
        as_of = as_of_fn(batch_id)  # rows without an event time are quarantined too
        counts = ingest_batch(store, cfg, batch, as_of, since=oldest or as_of)
        log_run(store, DAG_NAMES[0], RUN_SUCCESS, counts["clean_rows"], as_of)  # SNK8, VAL12
    _run(orders, sink, checkpoint)


def drain_update(df: DataFrame, out_path: str, checkpoint: str) -> None:
    """Run an aggregate stream to the end of its input in update mode: each
    batch writes only the groups it changed, state older than the watermark
    is dropped, and ``latest_updates`` reads the newest row of each group."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")
    _run(df, sink, checkpoint, mode="update")


def latest_updates(updates: DataFrame, keys: list[str]) -> DataFrame:
    values = [c for c in updates.columns if c not in (*keys, "batch")]
    newest = updates.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("_v"))
    return newest.select(*keys, "_v.*")


def drain_append(df: DataFrame, out_path: str, checkpoint: str) -> None:
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")
    _run(df, sink, checkpoint)


def scratch(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
