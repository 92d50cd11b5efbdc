"""Exact cosine threshold links by dual traversal of cover trees.

On unit vectors ``cos >= c`` is a chord of at most ``t = sqrt(2 - 2c)``.
Equal vectors are one class with a multiplicity.  Classes are dealt to the
nearest of a bounded number of pivots; a pivot's cell is cut into chunks of
about ``CHUNK`` classes, so a dense cell spreads over tasks.  Each chunk
becomes a cover tree: nested levels whose radii halve (1, 1/2, ...); every
class lies within a level's radius of its centre there, and a centre stays
one on all finer levels.  Pairs of cells, then pairs of chunks' nodes level
by level, are pruned when the centres are farther apart than both covering
radii plus ``t``; node pairs wholly within ``t`` are links without looking
inside; what remains is decided by the cosine in double precision.

A task returns for each vector its number of links and one spanning edge, so
a group of m near copies costs m rows, not m * m.

Random directions in many dimensions can't be pruned by any ball bound;
there the traversal is a blocked matrix product over chunk pairs.

Defined results: a null, empty or zero vector, or one with null or
non-finite components, links with nothing and is its own component; vectors
of different length don't link; a null id gets no links and a null
component and stays; rows that repeat an id and vector are one vector.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import small_batches, written
from zonecast.llm.graph import components, local_roots

THRESHOLD = 0.9
CHUNK = 8192
MAX_PIVOTS = 512
RADII = tuple(2.0 ** -k for k in range(7))
TILE = 1024       # nodes of a side in a matrix product
PAIRS = 1 << 17   # node pairs expanded at a time
MARGIN = 1e-9     # a bound must clear the threshold by this much
FOUND = "vec_id long, n_links long, root long"


def unit(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, float)
    big = np.abs(x).max(axis=1, keepdims=True)  # no overflow of squares
    x = x / np.where(big > 0, big, 1)
    n = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(n > 0, n, 1)


def matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


class CoverTree:
    """Points sorted so that every node of every level is one slice.

    ``start[l]``: first points of the nodes of level l, which are their
    centres; the last level is the single points.  ``radius[l]``: covering
    radius of each node.
    """

    def __init__(self, points: np.ndarray):
        n = len(points)
        order, groups = np.arange(n), [np.arange(n)] if n else []
        paths = []
        for r in RADII:
            new = []
            for g in groups:
                new.extend(self._net(points, g, r) if len(g) > 1 else [g])
            groups = new
            order = np.concatenate(groups) if groups else order
            paths.append(np.cumsum([0] + [len(g) for g in groups])[:-1])
            if all(len(g) == 1 for g in groups):
                break
        # Slices of a finer level lie inside those of a coarser one, in its order.
        self.order, self.points = order, points[order]
        self.start = [*paths, np.arange(n)] if not paths or len(paths[-1]) < n else paths
        self.bounds = [*RADII[:len(paths)], 0.0][:len(self.start)]  # a level's radius at most
        while len(self.start) > 2 and 2 * len(self.start[0]) > n:
            del self.start[0], self.bounds[0]  # a top level that hardly groups prunes nothing
        self.radius, self.size = [], []
        for s in self.start:
            size = np.diff(np.append(s, n))
            centre = np.repeat(s, size)
            d = chord((self.points * self.points[centre]).sum(axis=1)) if n else np.zeros(0)
            self.radius.append(np.maximum.reduceat(d, s) * (size > 1) if n else d)
            self.size.append(size)

    @staticmethod
    def _net(points, group, r):
        """Greedy net: each centre takes what is within r and still free;
        the group's first point, the coarser centre, is the first centre."""
        out, free = [], group
        least = 1 - r * r / 2
        while len(free):
            some = min(len(free), 256)  # the next centres, if still free
            near = points[free[:some]] @ points[free].T >= least
            taken = np.zeros(len(free), dtype=bool)
            for k in range(some):
                if not taken[k]:
                    mine = near[k] & ~taken
                    mine[k] = True
                    out.append(free[mine])
                    taken |= mine
            free = free[~taken]
        return out

    def children(self, level: int, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first, end) node numbers of the next level inside each node."""
        s, finer = self.start[level], self.start[level + 1]
        ends = np.append(s[1:], len(self.points))
        return np.searchsorted(finer, s[node]), np.searchsorted(finer, ends[node])


def chord(cosine):
    return np.sqrt(np.maximum(2 - 2 * cosine, 0))


class DualTraversal:
    """Links between the points of two trees (or of one with itself)."""

    def __init__(self, a: CoverTree, b: CoverTree, weight_a, weight_b, threshold: float = THRESHOLD):
        self.a, self.b, self.threshold = a, b, threshold
        self.reach = math.sqrt(2 - 2 * threshold)
        self.weights = weight_a, weight_b
        self.links = np.zeros(len(a.points), np.int64), np.zeros(len(b.points), np.int64)
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0
        self.total = [np.concatenate([[0], np.cumsum(w)]) for w in self.weights]
        if len(a.points) and len(b.points):
            self._tiles(0, 0, 0, len(a.start[0]), 0, len(b.start[0]))

    def _tiles(self, la, lb, a0, a1, b0, b1):
        for i in range(a0, a1, TILE):
            for j in range(b0, b1, TILE):
                x, y = np.arange(i, min(i + TILE, a1)), np.arange(j, min(j + TILE, b1))
                sa, sb = self.a.start[la][x], self.b.start[lb][y]
                cosine = self.a.points[sa] @ self.b.points[sb].T
                ra, rb = self.a.radius[la][x], self.b.radius[lb][y]
                bound = self.reach + MARGIN + ra[:, None] + rb[None, :]
                close = cosine >= 1 - np.minimum(bound, 2) ** 2 / 2
                u, v = np.nonzero(close)
                if len(u):
                    self._decide(la, lb, x[u], y[v], cosine[u, v])

    def _decide(self, la, lb, x, y, cosine):
        a, b = self.a, self.b
        ra, rb = a.radius[la][x], b.radius[lb][y]
        single = (a.size[la][x] == 1) & (b.size[lb][y] == 1)
        inside = ~single & (chord(cosine) + ra + rb <= self.reach - MARGIN)
        link = single & (cosine >= self.threshold)
        self._link(a.start[la][x[link]], b.start[lb][y[link]])
        for p, q in zip(x[inside], y[inside]):
            self._all(a.start[la][p], a.size[la][p], b.start[lb][q], b.size[lb][q])
        open_ = ~single & ~inside
        if open_.any():
            self._deeper(la, lb, x[open_], y[open_])

    def _deeper(self, la, lb, x, y):
        """The pairs of the children of each open pair of nodes."""
        (la, a0, na), (lb, b0, nb) = self._below(self.a, la, x), self._below(self.b, lb, y)
        many = na * nb >= TILE
        for i in np.flatnonzero(many):
            self._tiles(la, lb, a0[i], a0[i] + na[i], b0[i], b0[i] + nb[i])
        a0, na, b0, nb = (z[~many] for z in (a0, na, b0, nb))
        n = na * nb
        ends = np.cumsum(n)
        first = 0
        while first < len(n):  # about PAIRS pairs at a time
            last = max(first + 1, int(np.searchsorted(ends, ends[first] + PAIRS)))
            k = np.arange(int(n[first:last].sum()))
            of = np.repeat(np.arange(first, last), n[first:last])
            k -= (ends[of] - n[of]) - (ends[first] - n[first])
            u, v = a0[of] + k // nb[of], b0[of] + k % nb[of]
            cosine = np.einsum("ij,ij->i", self.a.points[self.a.start[la][u]], self.b.points[self.b.start[lb][v]])
            bound = self.reach + MARGIN + self.a.radius[la][u] + self.b.radius[lb][v]
            close = cosine >= 1 - np.minimum(bound, 2) ** 2 / 2
            if close.any():
                self._decide(la, lb, u[close], v[close], cosine[close])
            first = last

    @staticmethod
    def _below(tree, level, node):
        """(next level, first child, children) of each node."""
        if level + 1 == len(tree.start):
            return level, node, np.ones(len(node), np.int64)
        first, end = tree.children(level, node)
        return level + 1, first, end - first

    def _link(self, x, y):
        if len(x):
            np.add.at(self.links[0], x, self.weights[1][y])
            np.add.at(self.links[1], y, self.weights[0][x])
            self._hold(x, y)

    def _all(self, a0, na, b0, nb):
        a, b = np.arange(a0, a0 + na), np.arange(b0, b0 + nb)
        self.links[0][a] += self.total[1][b0 + nb] - self.total[1][b0]
        self.links[1][b] += self.total[0][a0 + na] - self.total[0][a0]
        self._hold(a, np.full(na, b0))
        self._hold(np.full(nb, a0), b)

    def _hold(self, x, y):
        """Keep edges (numbers of b behind those of a), contracted in time."""
        self.edges.append((x, y + len(self.a.points)))
        self.held += len(x)
        if self.held > 1 << 20:
            node, root = self.roots()
            self.edges, self.held = [(root, node)], len(node)

    def roots(self):
        if not self.edges:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        x, y = (np.concatenate(z) for z in zip(*self.edges))
        node, root = local_roots(x, y)
        return node[node != root], root[node != root]


def _links(key, table: pa.Table, threshold: float) -> pa.Table:
    """Links within a pair of chunks (or one chunk with itself)."""
    side = table.column("chunk").to_numpy()
    ids, weight = table.column("id").to_numpy(), table.column("n").to_numpy()
    points = unit(matrix(table.column("vec")))
    parts = []
    for c in sorted({key[0].as_py(), key[1].as_py()}):
        at = np.flatnonzero(side == c)
        at = at[np.argsort(ids[at], kind="stable")]
        tree = CoverTree(points[at])
        at = at[tree.order]
        parts.append((tree, ids[at], weight[at]))
    (a, ids_a, wa), (b, ids_b, wb) = parts[0], parts[-1]
    found = DualTraversal(a, b, wa, wb, threshold)
    if len(parts) == 1:  # counted from the first side; not with itself
        ids_all, links = ids_a, found.links[0] - wa
        pick = lambda k: ids_a[k % len(ids_a)]
    else:
        ids_all, links = np.concatenate([ids_a, ids_b]), np.concatenate(found.links)
        pick = lambda k: ids_all[k]
    node, root = found.roots()
    out_id, out_root, out_links = [ids_all[links > 0], pick(node)], [ids_all[links > 0], pick(root)], [links[links > 0], np.zeros(len(node), np.int64)]
    return pa.table([pa.array(np.concatenate(x).astype(np.int64)) for x in (out_id, out_links, out_root)],
                    names=["vec_id", "n_links", "root"])


def _classes(vectors: DataFrame) -> DataFrame:
    """Distinct usable vectors: smallest id, number of ids, vector, length."""
    good = F.expr("size(vec) > 0 AND NOT exists(vec, x -> x IS NULL OR isnan(x) OR abs(x) = double('inf'))"
                  " AND exists(vec, x -> x <> 0)")
    return (vectors.filter(F.col("vec_id").isNotNull() & F.col("vec").isNotNull()).filter(F.coalesce(good, F.lit(False)))
            .withColumn("vec", F.expr("transform(vec, x -> x + 0D)"))  # -0 equals 0
            .distinct().groupBy("vec").agg(F.min("vec_id").alias("id"), F.count("*").alias("n"))
            .withColumn("dim", F.size("vec")))


def _cells(classes: DataFrame, n: int):
    """(rows with their pivot's number, pivots): nearest of a bounded set."""
    spark = classes.sparkSession
    most = min(MAX_PIVOTS, max(1, -(-n // CHUNK)))
    rows = classes.orderBy(F.xxhash64("id"), "id").limit(most).select("vec").collect()
    pivots = unit(np.array([r["vec"] for r in rows]))
    shared = spark.sparkContext.broadcast(pivots)

    def nearest(batches):
        for b in batches:
            if not b.num_rows:
                continue
            cosine = unit(matrix(b.column("vec"))) @ shared.value.T
            at = cosine.argmax(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(at), pa.array(chord(cosine[np.arange(len(at)), at]))],
                ["id", "n", "vec", "cell", "far"])

    cells = classes.select("id", "n", "vec").mapInArrow(
        nearest, "id long, n long, vec array<double>, cell long, far double")
    return written(cells, "cells"), pivots


def links(vectors: DataFrame, vec_id: str = "vec_id", vec: str = "embedding",
          threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, root (a vector it is linked with, through others)
    parts of every class, in several rows a class."""
    spark = vectors.sparkSession
    small_batches(spark)
    src = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vec).cast("array<double>").alias("vec"))
    classes = written(_classes(src), "vectors")
    out = spark.createDataFrame([], FOUND)
    for r in classes.groupBy("dim").count().orderBy("dim").collect():  # the lengths in use
        cells, pivots = _cells(classes.filter(F.col("dim") == r["dim"]), r["count"])
        sizes = {c["cell"]: (c["n"], c["far"]) for c in
                 cells.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect()}
        first, chunk = {}, 0
        for c in sorted(sizes):  # at most MAX_PIVOTS cells
            first[c] = chunk, -(-sizes[c][0] // CHUNK)
            chunk += first[c][1]
        apart, reach = chord(pivots @ pivots.T), math.sqrt(2 - 2 * threshold) + MARGIN
        near = {p: [q for q in sizes if apart[p, q] <= sizes[p][1] + sizes[q][1] + reach] for p in sizes}
        spread = spark.createDataFrame(
            [(p, first[p][0], first[p][1], [(first[q][0], first[q][0] + first[q][1] - 1) for q in near[p]]) for p in sizes],
            "cell long, first long, parts long, near array<struct<a: long, b: long>>")
        dealt = (cells.join(spread, "cell")
                 .withColumn("chunk", F.col("first") + F.pmod(F.xxhash64("id"), F.col("parts")))
                 .withColumn("other", F.explode(F.flatten(F.transform("near", lambda s: F.sequence(s["a"], s["b"]))))))
        pairs = dealt.select(F.least("chunk", "other").alias("a"), F.greatest("chunk", "other").alias("b"),
                             "chunk", "id", "n", "vec")
        out = out.unionByName(pairs.groupBy("a", "b").applyInArrow(lambda k, t: _links(k, t, threshold), FOUND))
    return classes, written(out, "links")


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", vec: str = "embedding",
                    threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``vectors``."""
    classes, found = links(vectors, vec_id, vec, threshold)
    counts = found.groupBy(F.col("vec_id").alias("id")).agg(F.sum("n_links").alias("links"))
    comp = components(found.filter("root <> vec_id").select(F.col("root").alias("a"), F.col("vec_id").alias("b")))
    known = (classes.join(counts, "id", "left").join(comp.withColumnRenamed("node", "id"), "id", "left")
             .select("id", "vec", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                     F.coalesce("component", "id").alias("component_id")))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vec).cast("array<double>").alias("vec"))
    rows = rows.withColumn("vec", F.expr("transform(vec, x -> x + 0D)"))
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return rows.join(known.drop("id"), "vec", "left").select(
        "vec_id", F.when(F.col("vec_id").isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(0).alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
