"""SparkSession construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job depends on: UTC so hour flooring of TIMESTAMP_NTZ is
# exact, AQE for runtime coalescing / skew splitting / broadcast choice.
_REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "zonecast", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the plans rely on.

    On a cluster ``master`` is left to spark-submit; tests pass
    ``local[*]`` and a small shuffle partition count.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(_REQUIRED_CONF)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_required_conf(spark)
    return spark


def apply_required_conf(spark: SparkSession) -> None:
    for k, v in _REQUIRED_CONF.items():
        spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only a local session without one (tests) gets a private folder; on a
    cluster executors would each write to their own disk, so a missing
    setting is an error there.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - sessions without a local SparkContext
        sc = None
    if not current and sc is not None:
        current = sc.getCheckpointDir()
    if not current:
        master = sc.master if sc is not None else ""
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="zonecast-ckpt-")
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint dir for written intermediates."""
    base = checkpoint_dir(spark)
    return os.path.join(base, name)


def materialize(df, name: str):
    """Cut lineage by writing ``df`` once as Parquet under the shared
    checkpoint folder and reading it back (one job, unlike an eager RDD
    checkpoint which computes the plan twice). Survives executor loss:
    the files are on shared storage, not in executor memory."""
    import uuid

    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
