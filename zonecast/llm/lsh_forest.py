"""MinHash near-duplicates through an LSH forest.

Every document's set of five-word shingles gives ``TREES * DEPTH`` minhash
values, ``DEPTH`` a tree.  Documents with equal sets are one class, kept once
as its smallest id.  In each tree the classes are sorted by their sequence of
values (a range partitioning, so a dense region spreads over tasks).  A
region is a run of classes with the same first ``MIN_DEPTH`` values.

First round: in each tree a class looks at its next neighbours, which have
the longest common prefixes (the depth adapts to the region, since in a dense
one the nearest share long prefixes), and takes the first whose set size and
value bits allow the threshold (a few standard deviations below it).  The
best such partner of each class is confirmed on full sets, and the confirmed
links label components.

Second round: regions in which a class has a partner at all, or hasn't seen
every neighbour, or that may go on in another task, are searched to the end
for pairs of different components (``cross_blocks``).  So all pairs that
share a region of any tree are compared or are in one component, however
dense the region, and the result doesn't depend on the partitions.

At similarity 0.75 a pair shares MIN_DEPTH = 3 values in a tree with
probability 0.42, so 24 trees miss it with probability 2e-6.  What isn't
linear is the second round of a region with many classes that stay unlinked:
their sketches (28 bytes) are all compared, in blocks, and sets only where a
sketch allows a link.

Defined results: texts without words, and null texts, have no shingles, link
with nothing and stay; a null id is linked with nothing and stays (its
component is null); repeated rows (equal id and set) are one class, each
gets a row; of an id with different texts the smallest text confirms links.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonecast.llm import textblocks as tb
from zonecast.llm.common import small_batches, text_frame, written
from zonecast.llm.cross_blocks import BLOCK, elements, link_groups, similar
from zonecast.llm.graph import components

TREES, DEPTH, MIN_DEPTH = 24, 4, 3
VALUES = TREES * DEPTH
THRESHOLD = 75        # percent
AGREE = 60            # of VALUES two-bit pieces; 78 +- 3.8 expected at the threshold
REACH = 64            # neighbours looked at in the first round
BROADCAST_IDS = 1_000_000  # ids sent to all executors at most; a join beyond
REGION = 1 + 4 * MIN_DEPTH  # bytes of a key

_A = np.random.default_rng(77).integers(0, 2**63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SIGNATURES = "doc_id long, n_shingles long, set_a long, set_b long, values binary"
ENTRIES = "key binary, sketch binary, id long"
FOUND = "a long, b long, agree int, group binary, sketch binary"
SETS = "id long, content binary"


def sign(batches):
    """Set size, set fingerprint and minhash values of every text."""
    for batch in batches:
        sizes = np.zeros(batch.num_rows, np.int64)
        prints = np.zeros((batch.num_rows, 2), np.int64)
        values = [b""] * batch.num_rows
        for i, _, data, off in tb.blocks(batch.column("text")):
            h, _, _, woff = tb.words(data, off)
            s, soff = tb.shingles(h, woff)
            some = np.flatnonzero(np.diff(soff))
            if not len(some):
                continue
            least = np.empty((VALUES, len(some)), ">u4")
            work = np.empty_like(s)
            for k in range(VALUES):
                np.multiply(s, _A[k], out=work)
                least[k] = np.minimum.reduceat(work, soff[some]) >> np.uint64(32)
            least = np.ascontiguousarray(least.T)
            for row, d in enumerate(some):
                own = np.unique(s[soff[d]:soff[d + 1]])
                sizes[i + d] = len(own)
                spread = tb.mix(own ^ np.uint64(0x3C6EF372FE94F82B))
                prints[i + d] = own.sum(dtype=np.uint64).astype(np.int64), np.bitwise_xor.reduce(spread).astype(np.int64)
                values[i + d] = least[row].tobytes()
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes), pa.array(prints[:, 0]), pa.array(prints[:, 1]),
             pa.array(values, pa.binary())], ["doc_id", "n_shingles", "set_a", "set_b", "values"])


class Sketches:
    """Two low bits of every value, and the set size (32 bits), of classes."""

    WIDTH = VALUES // 4 + 4

    def __init__(self, raw: list[bytes]):
        rows = np.frombuffer(b"".join(raw), np.uint8).reshape(-1, self.WIDTH)
        self.bits = np.ascontiguousarray(rows[:, :-4]).view(np.uint64)
        self.size = np.ascontiguousarray(rows[:, -4:]).view("<u4").ravel().astype(np.int64)

    @staticmethod
    def make(values: np.ndarray, size: np.ndarray) -> np.ndarray:
        n = len(values)
        two = (values[:, :, 3] & 3).reshape(n, VALUES // 4, 4)
        bits = (two << np.array([0, 2, 4, 6], np.uint8)).sum(axis=2, dtype=np.uint8)
        return np.hstack([bits, np.minimum(size, 2**32 - 1).astype("<u4").view(np.uint8).reshape(n, 4)])

    def scores(self, i, others) -> np.ndarray:
        """How many pieces agree, where size and bits allow the threshold;
        else 0.  ``i``: one row, or as many as ``others``."""
        n, m = self.size[i], self.size[others]
        diff = self.bits[i] ^ self.bits[others]
        diff = (diff | diff >> np.uint64(1)) & np.uint64(0x5555555555555555)
        agree = VALUES - np.bitwise_count(diff).sum(axis=1).astype(np.int64)
        good = (agree >= AGREE) & (100 * np.minimum(n, m) >= THRESHOLD * np.maximum(n, m))
        return np.where(good, agree, 0)


def _fixed(x: np.ndarray) -> pa.Array:
    """Rows of bytes as an Arrow binary column."""
    return pa.Array.from_buffers(pa.binary(x.shape[1]), len(x), [None, pa.py_buffer(np.ascontiguousarray(x))]).cast(pa.binary())


def plant(batches):
    """One entry a class and tree: tree and values as a sortable key, the
    class's sketch and id."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        raw = np.frombuffer(b"".join(batch.column("values").to_pylist()), np.uint8).reshape(n, VALUES, 4)
        sketch = Sketches.make(raw, batch.column("n").to_numpy())
        key = np.empty((n, TREES, 1 + 4 * DEPTH), np.uint8)
        key[:, :, 0] = np.arange(TREES)
        key[:, :, 1:] = raw.reshape(n, TREES, 4 * DEPTH)
        yield pa.RecordBatch.from_arrays(
            [_fixed(key.reshape(n * TREES, -1)), _fixed(np.repeat(sketch, TREES, axis=0)),
             pa.array(np.repeat(batch.column("id").to_numpy(), TREES))], ["key", "sketch", "id"])


LOOK = 1 << 18  # entries that a task looks at together


def neighbours(batches):
    """First partners among sorted entries: (a, b, agree); and all entries
    (a: id, group, sketch) of the regions to be searched to the end."""
    held, n, first = [], 0, True
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= LOOK:
            yield from _look(held, first, False)
            held, n, first = [], 0, False
    if held:
        yield from _look(held, first, True)


def _look(batches, first_of_task, last_of_task):
    """A stretch of entries; the regions at its ends may go on elsewhere."""
    join = lambda c: b"".join(x for b in batches for x in b.column(c).to_pylist())
    key = np.frombuffer(join("key"), np.uint8).reshape(-1, 1 + 4 * DEPTH)
    sketch = np.concatenate([np.frombuffer(b"".join(b.column("sketch").to_pylist()), np.uint8) for b in batches])
    sketch = sketch.reshape(len(key), -1)
    sketches = Sketches([sketch.tobytes()])
    ident = np.concatenate([b.column("id").to_numpy() for b in batches])
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[1:, :REGION] != key[:-1, :REGION]).any(axis=1)
    region = np.cumsum(new) - 1
    end = np.append(np.flatnonzero(new)[1:], len(key))[region]  # of each entry's region
    unsettled = np.zeros(region[-1] + 1, dtype=bool)
    unsettled[[0, -1]] = True
    rows = np.arange(len(key))
    for step in range(1, REACH + 2):
        rows = rows[rows + step < end[rows]]
        if step > REACH or not len(rows):
            unsettled[region[rows]] = True
            break
        agree = sketches.scores(rows, rows + step)
        found = agree > 0
        x = rows[found]
        unsettled[region[x]] = True
        if len(x):
            y = x + step
            yield _found(np.minimum(ident[x], ident[y]), np.maximum(ident[x], ident[y]), agree[found], None, None)
        rows = rows[~found]
    rows = np.flatnonzero(unsettled[region])
    for i in range(0, len(rows), 1 << 15):
        r = rows[i:i + (1 << 15)]
        yield _found(ident[r], None, None, key[r, :REGION], sketch[r])


def _found(a, b, agree, group, sketch):
    null = lambda t: pa.nulls(len(a), t)
    return pa.RecordBatch.from_arrays(
        [pa.array(a), null(pa.int64()) if b is None else pa.array(b),
         null(pa.int32()) if agree is None else pa.array(agree.astype(np.int32)),
         null(pa.binary()) if group is None else _fixed(group), null(pa.binary()) if sketch is None else _fixed(sketch)],
        ["a", "b", "agree", "group", "sketch"])


def contents(batches):
    """Each text's set, as sorted 64-bit hashes."""
    for batch in batches:
        sets = [s.astype(">u8").tobytes() for s in tb.text_sets(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.binary())], ["id", "content"])


def confirm(batches):
    """The pairs whose full sets reach the threshold."""
    for batch in batches:
        ok = [r for r, (x, y) in enumerate(zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()))
              if similar(elements(x, 8), elements(y, 8), THRESHOLD)]
        if ok:
            yield batch.select(["a", "b"]).take(pa.array(ok))


def _links(found: DataFrame, sets: DataFrame, block: int) -> DataFrame:
    """Confirmed links that connect all truly linked classes."""
    best = (found.filter("b IS NOT NULL").groupBy("a").agg(F.max(F.struct("agree", "b")).alias("best"))
            .select("a", F.col("best.b").alias("b")))
    pairs = best.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
    links = written(pairs.mapInArrow(confirm, "a long, b long"), "links")
    label = components(links).select(F.col("node").alias("id"), "component")
    members = (found.filter("b IS NULL").select(F.col("a").alias("id"), "group", "sketch").distinct()
               .join(label, "id", "left").withColumn("label", F.coalesce("component", "id")).drop("component"))
    return links.unionByName(link_groups(written(members, "members"), sets, Sketches, 8, THRESHOLD, block))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs``."""
    spark = docs.sparkSession
    small_batches(spark)
    src = text_frame(docs, doc_id, text)
    signed = written(src.mapInArrow(sign, SIGNATURES), "signatures")
    sets = ["n_shingles", "set_a", "set_b"]
    classes = written(signed.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*sets).agg(
        F.min("doc_id").alias("id"), F.first("values").alias("values")), "classes")
    entries = (classes.select("values", F.col("n_shingles").alias("n"), "id").mapInArrow(plant, ENTRIES)
               .repartitionByRange("key", "id").sortWithinPartitions("key", "id"))
    found = written(entries.mapInArrow(neighbours, FOUND).filter("b IS NULL OR a <> b"), "found")
    ids = written(found.select(F.explode(F.array("a", "b")).alias("doc_id")).filter("doc_id IS NOT NULL").distinct(), "ids")
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    texts = src.join(ids, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    content = written(texts.mapInArrow(contents, SETS), "sets")
    comp = components(_links(found, content, block))
    member = (signed.drop("values").join(classes.drop("values"), sets, "left")
              .join(comp.withColumnRenamed("node", "id"), "id", "left"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "id", "doc_id"))
    return member.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of near-duplicates, all columns; rows that
    repeat an id and text stay once, rows without an id all stay."""
    packed = docs.select(F.struct("*").alias("doc"), F.col(doc_id).cast("long").alias("id"),
                         F.xxhash64(F.col(text)).alias("print"))
    gone = near_duplicates(docs, doc_id, text).filter("NOT kept").select(F.col("doc_id").alias("id")).distinct()
    left = packed.join(gone, "id", "left_anti")
    return (left.filter("id IS NOT NULL").dropDuplicates(["id", "print"])
            .unionByName(left.filter("id IS NULL")).select("doc.*"))
