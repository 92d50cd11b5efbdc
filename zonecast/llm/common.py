"""Spark helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ARROW_ROWS = "4096"          # an Arrow batch has at most so many rows
ARROW_BYTES = str(8 << 20)   # and about so many bytes: whole texts, some very long


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a private one is set
    only in a local session that has none (tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="zonecast-llm-")
        spark.sparkContext.setCheckpointDir(path)
    return path


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` once into the shared folder and read it.

    The write's own shuffle files are no longer needed by then (the table is
    on shared storage), so Spark is told to delete them with it instead of
    keeping them until the driver collects garbage.
    """
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), f"llm-{name}-{uuid.uuid4().hex}")
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def small_batches(spark: SparkSession) -> None:
    """Bound the texts that a Python worker holds at once, and make this
    subpackage importable in the executors' Python workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="zonecast-code-"), f"zonecast-llm-{sc.applicationId}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in (n for n in names if n.endswith(".py")):
                z.write(f"{folder}/{name}", os.path.join("zonecast", os.path.relpath(f"{folder}/{name}", package)))
    sc.addPyFile(archive)  # Spark serves the driver's copy to every executor
    _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_frame(df: DataFrame, id_col: str, text_col: str, id_name: str = "doc_id") -> DataFrame:
    """Only the two columns an operator reads, under its own names."""
    return df.select(F.col(id_col).cast("long").alias(id_name), F.col(text_col).cast("string").alias("text"))


def fold(id_name: str, mod: int):
    """crc32 of the id as text, modulo ``mod`` (null for a null id)."""
    return F.pmod(F.crc32(F.col(id_name).cast("string").cast("binary")), F.lit(mod))


HOT = 10_000  # a key with more than one row in HOT is broadcast


def join_sized(df: DataFrame, sizes: DataFrame, key: str, size: str, hot: int = HOT) -> DataFrame:
    """``df`` joined with a written table of one row a key, whose column
    ``size`` says how many rows of ``df`` have that key.  Keys of more than
    one row in ``hot`` are fewer than ``hot``, so they are broadcast; the
    rest are joined by a shuffle, which then meets no large key."""
    n = df.count()
    large = F.col(size) * hot > n
    first = F.broadcast(sizes.filter(large))
    rest = df.join(first.select(key), key, "left_anti").join(sizes.filter(~large), key)
    return df.join(first, key).unionByName(rest)
