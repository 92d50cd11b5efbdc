"""Sharding by extendible hashing, with DataFrame operations only.

A row's key is the first 32 bits of the id's md5.  A bucket of depth ``d``
holds the rows of one ``d``-bit prefix; only buckets over the byte limit
split on another bit.  A round looks ``step`` bits further under the buckets
still too large: rows are pre-aggregated into cells of the round's depth,
the cells' sums are rolled up to every shorter prefix, and a prefix that
fits while its parent doesn't is a bucket.  As in an extendible-hashing
directory a bucket of depth ``d`` then fills the ``2 ** (G - d)`` cells of
global depth ``G`` under it, so a row finds its bucket by one equi-join on
its cell.  The directory is a table as large as the number of shards asks.

Defined results: a null text has no bytes; a null id is hashed as an empty
id; a single row over the limit is a shard of its own; rows of one id (or
hash) that exceed the limit even at depth 32 go to overflow pages, numbered
from 1 within the rows' input partition, each within the limit.  An empty
table has no shards.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonecast.llm.common import written

LIMIT_BYTES = 1 << 20
BITS = 32
STEP = 8


def keyed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", whole: bool = False) -> DataFrame:
    """doc_id, n_bytes, the 32-bit key and the input partition of each row,
    and with ``whole`` the row itself."""
    ident = F.col(doc_id).cast("long")
    row = [F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")] if whole else []
    return docs.select(
        ident.alias("doc_id"),
        F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)).cast("long").alias("n_bytes"),
        F.conv(F.substring(F.md5(F.coalesce(ident.cast("string"), F.lit(""))), 1, 8), 16, 10).cast("long").alias("key"),
        F.spark_partition_id().alias("part"), *row)


def _cell(depth: int):
    return F.expr(f"shiftright(key, {BITS - depth})")


def _split(rows: DataFrame, low: int, high: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """(buckets, frontier) under prefixes of ``low`` bits, down to ``high``."""
    cells = rows.groupBy(_cell(high).alias("cell")).agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("n"))
    sums = (cells.withColumn("depth", F.explode(F.sequence(F.lit(low), F.lit(high))))
            .withColumn("prefix", F.expr(f"shiftright(cell, {high} - depth)"))
            .groupBy("depth", "prefix").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
            .withColumn("fits", (F.col("bytes") <= limit) | (F.col("n") == 1)))
    sums = written(sums, "buckets")
    parents = sums.filter("fits").select(
        (F.col("depth") + 1).alias("depth"), "prefix", F.lit(True).alias("parent_fits"))
    fitting = (sums.filter("fits").withColumn("up", F.expr("shiftright(prefix, 1)")).alias("s")
               .join(parents.withColumnRenamed("prefix", "up").alias("p"), ["depth", "up"], "left"))
    buckets = fitting.filter("parent_fits IS NULL").select("depth", "prefix", "bytes")
    return buckets, sums.filter(f"NOT fits AND depth = {high}").select("depth", "prefix", "bytes")


def directory(rows: DataFrame, limit: int = LIMIT_BYTES) -> list[tuple[int, DataFrame]]:
    """Rounds of (global depth, directory: cell, depth, prefix, bytes, paged)."""
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    low, high = 0, min(BITS, max(4, math.ceil(math.log2(max(1, total / limit))) + 3))
    out, todo = [], rows
    while True:
        buckets, frontier = _split(todo, low, high, limit)
        last = high == BITS
        if last:
            buckets = buckets.withColumn("paged", F.lit(False)).unionByName(frontier.withColumn("paged", F.lit(True)))
        else:
            buckets = buckets.withColumn("paged", F.lit(False))
        entries = buckets.withColumn("cell", F.explode(F.expr(
            f"sequence(shiftleft(prefix, {high} - depth), shiftleft(prefix + 1, {high} - depth) - 1)")))
        out.append((high, written(entries, "directory")))
        if last or frontier.isEmpty():
            return out
        todo = todo.withColumn("cell", _cell(high)).join(
            frontier.select(F.col("prefix").alias("cell")), "cell", "left_semi").drop("cell")
        low, high = high + 1, min(BITS, high + STEP)


def _assign(rows: DataFrame, rounds: list[tuple[int, DataFrame]], limit: int) -> DataFrame:
    """Each row with its bucket; every row is found in exactly one round."""
    out = None
    for depth, entries in rounds:
        found = rows.withColumn("cell", _cell(depth)).join(entries.withColumnRenamed("bytes", "shard_bytes"), "cell").drop("cell")
        out = found if out is None else out.unionByName(found)
    half = limit // 2
    own = out.filter("NOT paged").withColumn("page", F.lit(0).cast("long"))
    if not any(d == BITS for d, _ in rounds):
        return own
    large = (F.col("n_bytes") > half).cast("int")
    pages = (Window.partitionBy("depth", "prefix", "part", large).orderBy("n_bytes", "key")
             .rowsBetween(Window.unboundedPreceding, -1))
    paged = out.filter("paged").withColumn("start", F.coalesce(F.sum("n_bytes").over(pages), F.lit(0)))
    paged = paged.withColumn("page", 1 + F.expr(f"(part * 2L + int(n_bytes > {half})) * 4294967296L + start div {max(1, half)}")).drop("start")
    sized = Window.partitionBy("depth", "prefix", "page")
    return own.unionByName(paged.withColumn("shard_bytes", F.sum("n_bytes").over(sized)))


def shards(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", limit: int = LIMIT_BYTES) -> DataFrame:
    """doc_id, n_bytes, depth, prefix, page, shard_bytes of every row."""
    rows = written(keyed(docs, doc_id, text), "keys")
    return _assign(rows, directory(rows, limit), limit).select(
        "doc_id", "n_bytes", F.col("depth").cast("long").alias("depth"), "prefix", "page", "shard_bytes")


def write_shards(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
                 limit: int = LIMIT_BYTES) -> None:
    """Write every row, all columns, into one folder a shard."""
    rows = keyed(docs, doc_id, text, whole=True)
    placed = _assign(rows, directory(written(rows.drop("row"), "keys"), limit), limit)
    shard = F.concat_ws("-", "depth", F.lpad(F.hex("prefix"), 8, "0"), "page")
    placed.select("row.*", shard.alias("shard")).repartition("shard").write.partitionBy("shard").parquet(path)
