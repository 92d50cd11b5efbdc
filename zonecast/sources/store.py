"""Table store on Parquet: sources and sinks of the jobs.

SRC1-SRC6, SNK1-SNK12. Tables live under one root (shared storage on a
cluster). Event tables are partitioned by a derived ``dt`` date, so time
predicates prune whole directories (an NTZ predicate alone is pushed but
skips no row groups). Appends are idempotent through a key anti-join
restricted to the partitions the batch can touch (rows without an event
time are in a partition of their own, which is always read).

Reloaded tables (``VERSIONED``) are written by date into a new version folder;
a numbered commit (``commits.py``) names the version of every date, so a
reload that changes a few dates writes only those, is atomic, and never
touches the version being read. Versions that neither a recent commit nor a
reader's lease names are removed by ``expire``.

An ingested batch writes its keys, key summaries and hour counts under its own
name, and one commit makes all of them count at once; what a failed attempt
left behind is never read. Prediction flags (the original's UPDATE) are an
append-only table, merged into the touched dates of the predictions and
applied on read where that hasn't happened yet.
"""

from __future__ import annotations

import datetime as dt
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.config import FLAG_HIGH_DEMAND, Config
from zonecast.sources import keys as K
from zonecast.sources.commits import CommitLog, Files
from zonecast.sources.schemas import DATE_PARTITIONED, DATED, INDEXED, INGEST_COMMITS, SCHEMAS, TIME_INDEX, VERSIONED

FLAGS = "prediction_flags"
FLAGS_SCHEMA = T.StructType([
    T.StructField("zone_id", T.StringType()),
    T.StructField("forecast_hour", T.TimestampNTZType()),
    T.StructField("flag", T.StringType()),
    T.StructField("flagged_at", T.TimestampNTZType()),
])
ORPHAN_S = 24 * 3600.0  # a version that no commit names may be in the making for so long


class Store:
    def __init__(self, spark: SparkSession, root: str, cfg: Config):
        self.spark, self.root, self.cfg = spark, root.rstrip("/"), cfg

    # ---- paths, existence, commits ----------------------------------------------------
    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    @property
    def files(self) -> Files:
        return Files(self.spark)

    def exists(self, path: str) -> bool:
        return self.files.exists(path)

    def list_dirs(self, path: str) -> list[str]:
        return [name for name, _ in self.files.list(path, dirs=True)]

    def log(self, name: str) -> CommitLog:
        return CommitLog(self.spark, f"{self.path(name)}/_commits")

    def schema(self, name: str) -> T.StructType:
        s = SCHEMAS.get(name) or (FLAGS_SCHEMA if name == FLAGS else None)
        if s is None:
            raise KeyError(name)
        if name in DATE_PARTITIONED or name in DATED:
            s = T.StructType(s.fields + [T.StructField(self.cfg.date_partition_col, T.DateType())])
        return s

    def empty(self, name: str) -> DataFrame:
        """SRC4: an empty table with the declared schema."""
        return self.spark.createDataFrame([], self.schema(name))

    # ---- reads (SRC2, SRC3, SRC5) --------------------------------------------------------
    def read_table(self, name: str) -> DataFrame:
        """Full read with the declared schema; column pruning is Spark's."""
        if name in VERSIONED:
            return self.read_version(name, self.log(name).last())
        if not self.exists(self.path(name)):
            return self.empty(name)
        out = self.spark.read.schema(self.schema(name)).parquet(self.path(name))
        return out.select(*FLAGS_SCHEMA.fieldNames()) if name == FLAGS else out

    def read_indexed(self, name: str) -> DataFrame:
        """SRC5: a table of ``INDEXED`` with its BIGINT time column. Its files
        are ranges of (date, zone, time) and sorted, so a predicate on that
        column skips row groups (one on the NTZ column doesn't)."""
        if not self.exists(self.path(name)):
            return self.empty(name).withColumn(TIME_INDEX, F.lit(None).cast("long"))
        part = self.cfg.date_partition_col
        fields = [*SCHEMAS[name].fields, T.StructField(TIME_INDEX, T.LongType()), T.StructField(part, T.DateType())]
        return self.spark.read.schema(T.StructType(fields)).parquet(self.path(name))

    # ---- appends (SNK1, SNK2, SNK4, SNK5, SNK7, SNK8) -----------------------------------
    def append(self, name: str, df: DataFrame, key: list[str] | None = None,
               since: dt.datetime | None = None) -> None:
        """Append ``df``; with ``key``, rows whose key is stored already are
        skipped (idempotent re-runs). ``since`` bounds the partitions the
        batch can touch, so the anti-join reads only those."""
        cols = [f.name for f in SCHEMAS.get(name, FLAGS_SCHEMA).fields]
        out = df.select(*[F.col(c) if c in df.columns else F.lit(None).alias(c) for c in cols])
        out = out.select([F.col(f.name).cast(f.dataType) for f in SCHEMAS.get(name, FLAGS_SCHEMA).fields])
        part = None
        if name in DATE_PARTITIONED:
            part = self.cfg.date_partition_col
            out = out.withColumn(part, F.to_date(DATE_PARTITIONED[name]))
        if key and self.exists(self.path(name)):
            existing = self.read_table(name)
            if since is not None and part:
                existing = existing.where((F.col(part) >= F.lit(since.date())) | F.col(part).isNull())
            out = out.join(existing.select(*key), key, "left_anti")
        w_options = {}
        if name in INDEXED:
            # Range partitions by date, zone and time: a hot zone's day is cut
            # in time, and a file's row groups cover few zones and hours.
            order = [part, INDEXED[name], TIME_INDEX]
            out = (out.withColumn(TIME_INDEX, F.unix_micros(F.col(DATE_PARTITIONED[name]).cast("timestamp")))
                   .repartitionByRange(*order).sortWithinPartitions(*order))
            w_options["parquet.block.size"] = self.cfg.row_group_bytes
        elif part:
            # AQE-sized write partitions per date: skewed dates are split,
            # small ones merged, so each task writes few, reasonably sized files.
            out = out.hint("rebalance", part)
        w = out.write.mode("append").options(**w_options)
        if part:
            w = w.partitionBy(part)
        w.parquet(self.path(name))

    # ---- the primary key of clean_orders, over all time (SNK1) --------------------------
    def known_ids(self, ids: DataFrame) -> tuple[DataFrame, list[dt.date]]:
        """The ids of ``ids`` that a committed batch has stored, and the key
        partitions that were opened to find them: those in which the
        summaries may hold one of the ids. The ids are tested against the
        summaries, the keys are never read as a whole."""
        from zonecast.session import materialize  # noqa: PLC0415

        part = self.cfg.date_partition_col
        found = materialize(K.hits(self.read_table("key_summaries"), ids, "order_id", part), "key-hits")
        dates = sorted(r[0] for r in found.select(part).distinct().collect())
        keys = self.read_table("order_keys").where(F.col(part).isin(dates)) if dates else self.empty("order_keys")
        committed = self.log("ingests").frame(INGEST_COMMITS).select("batch")
        known = keys.join(found, ["order_id", part], "left_semi").join(committed, "batch", "left_semi")
        return known.select("order_id").distinct(), dates

    def append_new_orders(self, clean: DataFrame, since: dt.datetime, batch: str) -> DataFrame:
        """Append the orders whose id no committed batch has stored, with
        their keys and key summaries; returns them as they are stored.
        ``clean`` is a staged table. Summaries go first and count for
        nothing until the batch is committed. A batch that fails before is
        completed by its retry: its rows are found in clean_orders, and its
        keys don't count yet."""
        from zonecast.session import materialize  # noqa: PLC0415

        part = self.cfg.date_partition_col
        known = materialize(self.known_ids(clean.select("order_id"))[0], "known-ids")
        fresh = clean.join(known, "order_id", "left_anti")
        ids = materialize(fresh.select("order_id", F.to_date("timestamp").alias(part), F.lit(batch).alias("batch")), "new-ids")
        self._append_dated("key_summaries", K.summarise(ids, "order_id", part).withColumn("batch", F.lit(batch)))
        present = self.read_table("clean_orders").where(F.col(part) >= F.lit(since.date())).drop(part)
        present = materialize(present.join(ids.select("order_id"), "order_id", "left_semi"), "stored-before")
        # Written once: the append samples it for its ranges, and the counts read it.
        left = materialize(fresh.join(present.select("order_id"), "order_id", "left_anti"), "new-orders")
        self.append("clean_orders", left)
        self._append_dated("order_keys", ids)
        return left.select(*present.columns).unionByName(present)

    def _append_dated(self, name: str, df: DataFrame) -> None:
        part = self.cfg.date_partition_col
        names = [f.name for f in SCHEMAS[name].fields]
        df.select(*names, part).hint("rebalance", part).write.mode("append").partitionBy(part).parquet(self.path(name))

    def compact_key_summaries(self, before: dt.date) -> int:
        """One summary a date instead of one a batch and date, for dates
        before ``before`` with several; built again from the keys of
        committed batches. Returns the number of dates."""
        part = self.cfg.date_partition_col
        every = self.read_table("key_summaries").where(F.col(part) < F.lit(before))
        dates = [r[0] for r in every.groupBy(part).agg(F.count_distinct("batch").alias("n")).where("n > 1").collect()]
        if dates:
            committed = self.log("ingests").frame(INGEST_COMMITS).select("batch")
            ids = (self.read_table("order_keys").where(F.col(part).isin(dates)).join(committed, "batch", "left_semi"))
            self.replace_dates("key_summaries", K.summarise(ids, "order_id", part).withColumn("batch", F.lit("compacted")))
        return len(dates)

    def replace_dates(self, name: str, df: DataFrame) -> None:
        """Replace exactly the dates that ``df`` (with the partition column)
        has rows of; the result is staged first, since it may have been read
        from those dates. Queries that still read the replaced files must
        start again (the jobs run one after the other)."""
        from zonecast.session import materialize  # noqa: PLC0415

        part = self.cfg.date_partition_col
        fields = self.schema(name).fieldNames()
        staged = materialize(df.select(*fields), f"replace-{name}")
        (staged.hint("rebalance", part).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(part).parquet(self.path(name)))

    # ---- ingested batches and their hour counts (SNK1, AG1) -------------------------------
    def write_delta(self, counts: DataFrame, batch: str) -> None:
        counts.write.mode("overwrite").parquet(f"{self.path('zone_hour_deltas')}/batch={batch}")

    def commit_batch(self, batch: str, rows: int, oldest: dt.datetime | None, as_of: dt.datetime) -> dict:
        return self.log("ingests").commit(
            lambda _last: {"batch": batch, "rows": rows, "oldest": oldest, "as_of": as_of})

    def zone_hour_counts(self, upto: int, since: dt.datetime | None = None) -> DataFrame:
        """Counts a zone, hour and weather label of all orders that ingests
        up to commit ``upto`` have stored: the compacted base and the later
        batches' deltas, merged. ``since`` reads only those hours."""
        from zonecast.operators.features import merge_partials  # noqa: PLC0415

        base = self.log("zone_hour_counts").last()
        start = base["upto"] if base else 0
        paths = [f"{self.path('zone_hour_deltas')}/batch={c['batch']}" for c in self.log("ingests").all()
                 if start < c["seq"] <= upto]
        parts = [self.read_version("zone_hour_counts", base, since.date() if since else None)]
        if paths:
            parts.append(self.spark.read.schema(SCHEMAS["zone_hour_deltas"]).parquet(*paths))
        both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        if since is not None:
            both = both.where(F.col("timestamp") >= F.lit(since).cast("timestamp_ntz"))
        return merge_partials(both)

    def compact_zone_hour_counts(self, as_of: dt.datetime, keep: int) -> None:
        """Fold the committed deltas into the base: only dates that they
        touch are written again. Folded deltas go once no live base needs
        them."""
        log, ingests = self.log("zone_hour_counts"), self.log("ingests").all()
        if not ingests:
            return
        base, upto = log.last(), ingests[-1]["seq"]
        start = base["upto"] if base else 0
        if upto > start:
            paths = [f"{self.path('zone_hour_deltas')}/batch={c['batch']}" for c in ingests if c["seq"] > start]
            day = F.to_date("timestamp")
            dates = [r[0] for r in self.spark.read.schema(SCHEMAS["zone_hour_deltas"]).parquet(*paths)
                     .select(day.alias("d")).distinct().collect()]
            merged = self.zone_hour_counts(upto).where(day.isin(dates)) if dates else self.empty("zone_hour_counts")
            self.reload("zone_hour_counts", lambda _last: (merged, set(dates), upto), as_of)
        oldest = min(c["upto"] for c in self.expire("zone_hour_counts", keep))
        for c in ingests:
            if c["seq"] <= oldest:
                self.files.delete(f"{self.path('zone_hour_deltas')}/batch={c['batch']}")

    # ---- versioned reloads (SNK3) ----------------------------------------------------------
    def last_commit(self, name: str) -> dict | None:
        return self.log(name).last()

    def current_version(self, name: str) -> str | None:
        last = self.last_commit(name)
        return last["version"] if last else None

    def read_version(self, name: str, commit: dict | None, since: dt.date | None = None) -> DataFrame:
        """The table as of a commit; each date from the version that holds it."""
        part = self.cfg.date_partition_col
        parts = [(d, v) for d, (v, _rows) in sorted((commit or {"parts": {}})["parts"].items())
                 if since is None or d >= since.isoformat()]
        if not parts:
            return self.empty(name)
        fields = [*SCHEMAS[name].fields, T.StructField("v", T.StringType()), T.StructField(part, T.DateType())]
        out = (self.spark.read.schema(T.StructType(fields)).option("basePath", self.path(name))
               .parquet(*(f"{self.path(name)}/{v}/{part}={d}" for d, v in parts)))
        return out.select(*SCHEMAS[name].fieldNames())

    def reload(self, name: str, build, as_of: dt.datetime) -> str:
        """Commit a new version. ``build(last commit)`` gives (rows, dates to
        replace or None for all, newest ingest covered); the dates not
        replaced stay as they are in the last commit. If another writer
        commits first, it is built again on top of that commit."""
        part = self.cfg.date_partition_col
        log = self.log(name)
        version = None

        def attempt(last: dict | None) -> dict:
            nonlocal version
            df, dates, upto = build(last)
            version = f"v={as_of:%Y%m%d%H%M%S}-{uuid.uuid4().hex[:8]}"
            target = f"{self.path(name)}/{version}"
            df = df.select(*[F.col(f.name).cast(f.dataType) for f in SCHEMAS[name].fields],
                           F.to_date(VERSIONED[name]).alias(part))
            df.hint("rebalance", part).write.mode("error").partitionBy(part).parquet(target)
            parts = {}
            if last is not None and dates is not None:
                gone = {d.isoformat() for d in dates}
                parts = {d: p for d, p in last["parts"].items() if d not in gone}
            if self.list_dirs(target):  # rows a date, from footers
                written = self.spark.read.schema(T.StructType([T.StructField(part, T.DateType())])).parquet(target)
                parts |= {r[0].isoformat(): [version, r[1]] for r in written.groupBy(part).count().collect()}
            return {"version": version, "as_of": as_of, "rows": sum(n for _, n in parts.values()),
                    "upto": upto, "parts": parts}

        log.commit(attempt)
        return version

    def overwrite_versioned(self, name: str, df: DataFrame, as_of: dt.datetime, upto: int | None = None) -> str:
        """Full reload: the new version holds every date."""
        return self.reload(name, lambda _last: (df, None, upto), as_of)

    @contextmanager
    def leased(self, name: str):
        """The table's newest version, safe from expiry while the block runs."""
        with self.log(name).lease() as commit:
            yield self.read_version(name, commit)

    def expire(self, name: str, keep: int) -> list[dict]:
        """Remove the versions that neither the newest ``keep`` commits nor
        a lease needs, and versions that a failed writer left; returns the
        commits that are left."""
        log = self.log(name)
        live = log.live(keep)
        needed = {v for c in live for v, _rows in c["parts"].values()} | {c["version"] for c in live}
        gone = {v for c in log.forget(live) for v, _rows in c["parts"].values()}
        import time  # noqa: PLC0415

        for folder, at in self.files.list(self.path(name), dirs=True):
            if folder.startswith("v=") and folder not in needed and (folder in gone or time.time() - at > ORPHAN_S):
                self.files.delete(f"{self.path(name)}/{folder}")
        return live

    # ---- watermark state (SRC1, SNK11) ------------------------------------------------------
    def watermark(self, source: str, default: dt.datetime) -> dt.datetime:
        if not self.exists(self.path("watermarks")):
            return default
        row = (self.read_table("watermarks").where(F.col("source") == source)
               .agg(F.max("watermark").alias("w")).first())  # it never moves back
        return row["w"] if row and row["w"] is not None else default

    def save_watermark(self, source: str, value: dt.datetime, as_of: dt.datetime) -> None:
        row = self.spark.createDataFrame([(source, value, as_of)], SCHEMAS["watermarks"])
        row.coalesce(1).write.mode("append").parquet(self.path("watermarks"))

    # ---- predictions with flags (SNK6, JN9) -------------------------------------------------
    def flag(self, alerts: DataFrame, as_of: dt.datetime) -> None:
        """Store one flag an alerted zone, hour and run, and merge it into
        the stored predictions; a retry flags nothing twice, and merges what
        a failed run left."""
        from zonecast.session import materialize  # noqa: PLC0415

        keys = ["zone_id", "forecast_hour", "flagged_at"]
        rows = (alerts.select("zone_id", "forecast_hour").distinct()
                .withColumn("flag", F.lit(FLAG_HIGH_DEMAND))
                .withColumn("flagged_at", F.lit(as_of).cast("timestamp_ntz")))
        if self.exists(self.path(FLAGS)):
            rows = rows.join(self.read_table(FLAGS).select(*keys), keys, "left_anti")
        rows = materialize(rows.select(*FLAGS_SCHEMA.fieldNames()), "flags")
        if not rows.isEmpty():
            rows.coalesce(1).write.parquet(f"{self.path(FLAGS)}/batch={uuid.uuid4().hex}")
        self.merge_flags()

    def pending_flags(self) -> list[str]:
        """Batches of flags that no commit says are merged."""
        merged = {c["batch"] for c in self.log(FLAGS).all()}
        return [d[len("batch="):] for d in self.list_dirs(self.path(FLAGS))
                if d.startswith("batch=") and d[len("batch="):] not in merged]

    def _flags_of(self, batches: list[str]) -> DataFrame:
        return self.spark.read.schema(FLAGS_SCHEMA).parquet(*(f"{self.path(FLAGS)}/batch={b}" for b in batches))

    def merge_flags(self) -> list[dt.date]:
        """SNK6: write the flags into the predictions stored by now, older
        batches of the same zone and hour included (T21). Only dates with a
        row to change are written again; the dates are returned. Merging
        again, after a failure, changes nothing."""
        from zonecast.operators.monitor import flag_predictions  # noqa: PLC0415

        pending = self.pending_flags()
        if not pending:
            return []
        part = self.cfg.date_partition_col
        flags, preds = self._flags_of(pending), self.read_table("predictions")
        to_change = preds.where(F.col("confidence_flag") != FLAG_HIGH_DEMAND).join(
            flags.select("zone_id", "forecast_hour").distinct(), ["zone_id", "forecast_hour"], "left_semi")
        dates = [r[0] for r in to_change.select(part).distinct().collect()]
        if dates:
            self.replace_dates("predictions", flag_predictions(preds.where(F.col(part).isin(dates)), flags))
        for b in pending:
            self.log(FLAGS).commit(lambda _last, b=b: {"batch": b})
        return sorted(dates)

    def read_predictions(self) -> DataFrame:
        """Predictions with HIGH_DEMAND on every row of an alerted (zone,
        hour). Flags are in the table itself; only those that a failed run
        hasn't merged yet are joined."""
        preds, pending = self.read_table("predictions"), self.pending_flags()
        if not pending:
            return preds
        from zonecast.operators.monitor import flag_predictions  # noqa: PLC0415
        return flag_predictions(preds, self._flags_of(pending))

    # ---- model pointer (SNK12, SRC6) ---------------------------------------------------------
    def set_model_pointer(self, model_path: str, as_of: dt.datetime) -> None:
        self.log("model_pointer").commit(lambda _last: {"model_path": model_path, "as_of": as_of})

    def model_pointer(self) -> str | None:
        last = self.log("model_pointer").last()
        return last["model_path"] if last else None


class JdbcTables:
    """The original's relational storage as a Spark JDBC source/sink.

    Connection URL and credentials come from configuration only (e.g.
    ``spark.zonecast.jdbc.url``/``.user``/``.password`` set at submit
    time), never from literals. Reads split on a numeric or time column
    when bounds are given, so a large table is read by many tasks.
    """

    def __init__(self, spark: SparkSession, prefix: str = "spark.zonecast.jdbc"):
        self.spark = spark
        self.url = spark.conf.get(f"{prefix}.url", None)
        self.props = {k: v for k, v in (
            ("user", spark.conf.get(f"{prefix}.user", None)),
            ("password", spark.conf.get(f"{prefix}.password", None)),
            ("driver", spark.conf.get(f"{prefix}.driver", None))) if v}

    def read_table(self, name: str, column: str | None = None, lower=None, upper=None,
                   partitions: int | None = None) -> DataFrame:
        if not self.url:
            raise RuntimeError("no JDBC URL configured")
        if column and partitions:
            return self.spark.read.jdbc(self.url, name, column=column, lowerBound=lower,
                                        upperBound=upper, numPartitions=partitions,
                                        properties=self.props)
        return self.spark.read.jdbc(self.url, name, properties=self.props)

    def append(self, name: str, df: DataFrame) -> None:
        if not self.url:
            raise RuntimeError("no JDBC URL configured")
        df.write.jdbc(self.url, name, mode="append", properties=self.props)
