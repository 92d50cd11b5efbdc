"""Connected components of an edge table, as Spark jobs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import written

EDGE_SCHEMA = "a long, b long"


def local_roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, the smallest node each reaches) over these edges alone."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while len(x):
        low = np.minimum(root[x], root[y])
        before = root.copy()
        for side in (x, y):
            np.minimum.at(root, root[side], low)  # hook the old root
            np.minimum.at(root, side, low)
        while (root != root[root]).any():         # and shorten the paths
            root = root[root]
        if (root == before).all():
            break
    return nodes, nodes[root]


def star_edges(a: np.ndarray, b: np.ndarray, batch: int = 1 << 16):
    """Arrow batches of (a: root, b: node) that connect the same nodes."""
    nodes, roots = local_roots(a, b)
    keep = nodes != roots
    nodes, roots = nodes[keep], roots[keep]
    for i in range(0, len(nodes), batch):
        yield pa.RecordBatch.from_arrays([pa.array(roots[i:i + batch]), pa.array(nodes[i:i + batch])], ["a", "b"])


def _contract(batches):
    """A partition's edges as stars: at most one edge a node."""
    a, b, rows = [], [], 0
    for x in batches:
        a.append(x.column("a").to_numpy())
        b.append(x.column("b").to_numpy())
        rows += x.num_rows
        if rows > 1 << 21:  # a bounded part at a time
            yield from star_edges(np.concatenate(a), np.concatenate(b))
            a, b, rows = [], [], 0
    if rows:
        yield from star_edges(np.concatenate(a), np.concatenate(b))


ONE_TASK = 1 << 20  # edges (16 MB) that one task finishes; beyond, all tasks go on


def components(edges: DataFrame) -> DataFrame:
    """(node, component: the smallest node it reaches) of all nodes of
    ``edges`` (a, b long, neither null) but the components' own roots.

    Alternates large-star and small-star steps until nothing changes, after
    each task has contracted its own edges; a hub's edges meet in a grouped
    minimum (summed in every task) and a join, never in one group.  Once at
    most ``ONE_TASK`` edges are left, one task contracts them to the end,
    which spares the last rounds' jobs.
    """
    stars = written(edges.filter("a <> b").select("a", "b").mapInArrow(_contract, EDGE_SCHEMA).distinct(), "stars")
    seen = None
    while True:
        state = stars.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if 0 < state["n"] <= ONE_TASK:
            stars = written(stars.repartition(1).mapInArrow(_contract, EDGE_SCHEMA), "stars")
        if state["n"] <= ONE_TASK or state == seen:
            return stars.select(F.col("b").alias("node"), F.col("a").alias("component"))
        seen = state
        both = stars.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            stars.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = (both.join(low, "u").filter("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
                 .filter("a < b").distinct())
        low = large.groupBy(F.col("b").alias("u")).agg(F.min("a").alias("m"))
        small = (large.withColumnRenamed("b", "u").join(low, "u")
                 .select("m", F.explode(F.array("a", "u")).alias("v")).filter("m < v")
                 .select(F.col("m").alias("a"), F.col("v").alias("b")).distinct())
        stars = written(small, "stars")
