"""Bloom summaries of the stored order ids (SNK1, SRC1).

``order_keys`` holds every order id ever stored, partitioned by event date.
Beside it, each batch leaves a Bloom filter of its ids for every date that it
touched, in blocks of ``BLOCK_BITS`` bits: an id belongs to one block and sets
``HASHES`` bits there. A new batch's ids are tested against the summaries (a
join on the block and ``HASHES`` bit tests, all native expressions), and only
key partitions with a hit are opened. A false hit (about 2e-9 an id and
summary) costs reading a partition, never an order.

Summaries are built by Spark aggregates (``bit_or`` a 64-bit word) and take
``KEY_BITS`` bits an id, a sixth of an id of 36 characters. The ids are shuffled
once, by block; their bits are made and combined behind that shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 1 << 15
WORDS = BLOCK_BITS // 64
KEY_BITS = 48          # bits of a summary an id
HASHES = 16            # bits that an id sets; four from each 64-bit hash
BROADCAST_ROWS = 1 << 13  # blocks (4 KB each) of one size that are sent to every task
BLOCK_SCHEMA = "blocks long, block long, bits array<long>"


def positions(key: Column) -> Column:
    """The bits of an id within its block."""
    hashes = [F.xxhash64(F.lit(i), key) for i in range(HASHES // 4)]
    return F.array(*(F.shiftright(h, 15 * j).bitwiseAND(F.lit(BLOCK_BITS - 1)).cast("int")
                     for h in hashes for j in range(4)))


def block_of(key: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(HASHES), key), blocks)


def summarise(keys: DataFrame, key: str, part: str) -> DataFrame:
    """``part``, blocks, block, bits: one row a non-empty block of the
    summary of each ``part`` of ``keys``."""
    need = F.ceil(F.col("n") * KEY_BITS / BLOCK_BITS)
    sizes = (keys.groupBy(part).agg(F.count("*").alias("n"))  # powers of two, so few different numbers of blocks
             .select(part, F.pow(F.lit(2.0), F.ceil(F.log2(need.cast("double")))).cast("long").alias("blocks")))
    placed = (keys.join(F.broadcast(sizes), part)  # one row a date
              .select(part, "blocks", block_of(F.col(key), F.col("blocks")).alias("block"), key)
              .repartition(part, "blocks", "block"))  # a block's words meet in one task, so none is shuffled
    bits = placed.select(part, "blocks", "block", F.explode(positions(F.col(key))).alias("bit"))
    words = (bits.groupBy(part, "blocks", "block", F.shiftright("bit", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, bit & 63)")).alias("bits")))
    sets = (words.groupBy(part, "blocks", "block")  # at most WORDS rows each
            .agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("set")))
    zeros = lambda n: F.array_repeat(F.lit(0).cast("long"), n.cast("int"))

    def with_gap(entry, i):  # the empty words before an entry, and the entry
        before = F.coalesce(F.get("set", i - 1)["word"], F.lit(-1))
        return F.concat(zeros(entry["word"] - before - 1), F.array(entry["bits"]))

    filled = F.flatten(F.transform("set", with_gap))
    return sets.select(part, "blocks", "block", F.concat(
        filled, zeros(F.lit(WORDS - 1) - F.element_at("set", -1)["word"])).alias("bits"))


def hits(summaries: DataFrame, ids: DataFrame, key: str, part: str) -> DataFrame:
    """(key, part) of the ids that a summary may hold. Blocks of a size with
    few of them go to every task, so that no task gets all ids (those of a
    small date share one block); the ids are shuffled for the others only."""
    sizes = {r[0]: r[1] for r in summaries.groupBy("blocks").count().collect()}  # powers of two: at most 63
    if not sizes:
        return summaries.select(F.lit(None).cast("string").alias(key), part).limit(0)
    few = sorted(b for b, n in sizes.items() if n <= BROADCAST_ROWS)
    holds = lambda b: F.getbit(F.element_at("bits", F.shiftright(b, 6) + 1), b.bitwiseAND(F.lit(63))) == 1
    test = holds(F.get("set", 0)) & holds(F.get("set", 1)) & F.forall("set", holds)  # two plain tests stop most pairs
    found = None
    for some, small in ((few, True), (sorted(set(sizes) - set(few)), False)):
        if some:
            held = summaries.where(F.col("blocks").isin(some))
            probe = (ids.select(key, F.explode(F.array(*(F.lit(b).cast("long") for b in some))).alias("blocks"))
                     .withColumn("block", block_of(F.col(key), F.col("blocks"))))
            probe = probe if small else probe.repartition("blocks", "block")  # ids without their bits
            probe = probe.withColumn("set", positions(F.col(key)))
            hit = probe.join(F.broadcast(held) if small else held, ["blocks", "block"]).where(test).select(key, part)
            found = hit if found is None else found.unionByName(hit)
    return found.distinct()
