"""Links between different components inside groups of possible partners.

A similarity search puts rows into groups (a forest's regions, colliding
bands), and a first round of confirmed links has labelled them.  What is left
to look at are pairs of one group with different labels; here all of them are
looked at, however large the group, without sending a pair anywhere:

* Groups whose members have one label are done.  In the others, members that
  don't have the commonest label are outsiders; every pair to look at has one.
* A group of m members and k outsiders is a grid of blocks of ``BLOCK`` rows:
  all members along one side, the outsiders along the other.  A task gets the
  two sides of a cell, never a group.
* First only sketches are compared, which says which members have a possible
  partner at all.  Those come with their full contents, and pairs are
  confirmed where they meet.  A confirmed link unites its labels for the
  cells that a task has at hand, so it settles all other pairs of the two,
  and at most one link a member leaves the task with them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import join_sized, written

BLOCK = 1024        # rows of one side of a cell
CHUNK = 1 << 15     # rows that a task takes up at a time, and the rest of a cell
LOOK = 1 << 16      # pairs whose sketches are compared together, beyond a row's
ELEMENTS = 1 << 20  # of pairs of sets that are compared together, beyond a pair's
AT_ONCE = 64        # partners of a row that are confirmed together
CELL = ["group", "i", "j"]
DEALT = "group binary, i int, j int, side int, outsider boolean, id long, label long, sketch binary"
LINKS = "a long, b long"


def whole_groups(batches, keys: list[str], rows: int = CHUNK) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """(table, first row of each group and the end) of sorted rows, some
    whole groups at a time."""
    def edges(t):
        new = np.ones(t.num_rows, dtype=bool)
        differ = np.zeros(t.num_rows - 1, dtype=bool)
        for k in keys:
            c = t.column(k).combine_chunks()
            differ |= pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
        new[1:] = differ
        return np.append(np.flatnonzero(new), t.num_rows)

    held, n, limit = [], 0, rows
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        n += b.num_rows
        if n < limit:
            continue
        t = pa.Table.from_batches(held)
        cut = edges(t)
        if len(cut) > 2:  # the last group may go on in the next batch
            yield t.slice(0, cut[-2]), cut[:-1]
            t = t.slice(cut[-2])
            limit = rows
        else:
            limit = 2 * n
        held, n = t.to_batches(), t.num_rows
    if n:
        t = pa.Table.from_batches(held)
        yield t, edges(t)


def _partners(table: pa.Table, cut: np.ndarray, sketches):
    """(outsiders, possible partners of another label, scores) of the cells,
    row numbers in order of the outsiders, some outsiders at a time."""
    side, ident, label = (table.column(c).to_numpy() for c in ("side", "id", "label"))
    outsider = table.column("outsider").to_numpy()
    sketch = sketches(table.column("sketch").to_pylist())
    along, down = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    first = np.searchsorted(along, cut)  # of each cell's members
    cell = np.searchsorted(cut, down, "right") - 1
    count = np.diff(first)[cell]
    begin = np.append(0, np.cumsum(count))
    k = 0
    while k < len(down):
        end = max(k + 1, int(np.searchsorted(begin, begin[k] + LOOK, "right")) - 1)
        n = count[k:end]
        y = np.repeat(down[k:end], n)
        x = along[np.repeat(first[cell[k:end]] - begin[k:end], n) + np.arange(begin[k], begin[end])]
        fits = (label[x] != label[y]) & ~(outsider[x] & (ident[x] >= ident[y]))
        x, y = x[fits], y[fits]
        if len(x):
            score = sketch.scores(y, x)
            good = score > 0
            if good.any():
                yield y[good], x[good], score[good]
        k = end


def _possible(sketches):
    def run(batches):
        for table, cut in whole_groups(batches, CELL):
            wanted = np.zeros(table.num_rows, dtype=bool)
            for y, x, _ in _partners(table, cut, sketches):
                wanted[y] = True
                wanted[x] = True
            if wanted.any():
                yield from table.take(pa.array(np.flatnonzero(wanted))).combine_chunks().to_batches()
    return run


def similar(x: np.ndarray, y: np.ndarray, threshold: int) -> bool:
    """Jaccard similarity of ``threshold`` percent or more; empty sets have none."""
    return bool(similar_to([x], y, threshold)[0])


def similar_to(xs: list[np.ndarray], y: np.ndarray, threshold: int) -> np.ndarray:
    """Which sorted arrays without repeats are similar to ``y``."""
    n, m = np.array([len(x) for x in xs]), len(y)
    fits = (n > 0) & (100 * np.minimum(n, m) >= threshold * np.maximum(n, m))
    if m and fits.any():
        near = [x for x, f in zip(xs, fits.tolist()) if f]
        values = np.concatenate(near)
        at = np.searchsorted(y, values)
        at[at == m] = 0
        both = np.add.reduceat((y[at] == values).astype(np.int64), np.cumsum([0] + [len(x) for x in near[:-1]]))
        fits[fits] = 100 * both >= threshold * (n[fits] + m - both)
        return fits
    return np.zeros(len(xs), dtype=bool)


def flat(column: pa.Array) -> np.ndarray:
    """The bytes of a binary column without nulls, one row after the other."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, np.uint8)
    off = np.frombuffer(offsets, np.int64)
    return np.frombuffer(data, np.uint8)[off[column.offset]:off[column.offset + len(column)]]


def _alike(x: np.ndarray, n: np.ndarray, y: np.ndarray, m: np.ndarray, threshold: int) -> np.ndarray:
    """Which pairs of sets of ``n`` and ``m`` elements are similar; ``x`` and
    ``y`` are ascending keys of a pair's number and an element."""
    both = np.sort(np.concatenate([x, y]), kind="stable")  # two sorted runs
    equal = np.append(0, np.cumsum(np.append(False, both[1:] == both[:-1])))
    end = np.cumsum(n + m)
    common = equal[end] - equal[end - n - m]
    return (np.minimum(n, m) > 0) & (100 * common >= threshold * (n + m - common))


def similar_rows(xs: pa.Array, ys: pa.Array, width: int, threshold: int) -> np.ndarray:
    """Which rows hold similar sets; a set is its sorted elements without
    repeats, ``width`` big-endian bytes each, 5 at most."""
    ok = np.zeros(len(xs), dtype=bool)
    for k in range(0, len(xs), CHUNK):
        keys, sizes = [], []
        for side in (xs.slice(k, CHUNK), ys.slice(k, CHUNK)):
            sizes.append(pc.binary_length(side).to_numpy(zero_copy_only=False).astype(np.int64) // width)
            row = np.repeat(np.arange(len(side), dtype=np.uint64), sizes[-1])
            keys.append(row << np.uint64(8 * width) | elements(flat(side), width))
        ok[k:k + CHUNK] = _alike(keys[0], sizes[0], keys[1], sizes[1], threshold)
    return ok


class Contents:
    """The sets of a column's rows (as of ``similar_rows``, of any width),
    their elements numbered in order."""

    def __init__(self, column: pa.Array, width: int):
        self.size = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64) // width
        self.begin = np.cumsum(self.size) - self.size
        distinct, self.number = np.unique(elements(flat(column), width), return_inverse=True)
        self.most = max(1, len(distinct))

    def _keys(self, rows, n):
        pair = np.repeat(np.arange(len(rows)), n)
        return pair * self.most + self.number[np.repeat(self.begin[rows] - np.cumsum(n) + n, n) + np.arange(len(pair))]

    def similar(self, x: np.ndarray, y: np.ndarray, threshold: int) -> np.ndarray:
        """Which pairs of rows are similar, some pairs at a time."""
        n, m = self.size[x], self.size[y]
        ok = 100 * np.minimum(n, m) >= threshold * np.maximum(n, m)
        at = np.flatnonzero(ok)
        begin, k = np.append(0, np.cumsum((n + m)[at])), 0
        while k < len(at):
            end = max(k + 1, int(np.searchsorted(begin, begin[k] + ELEMENTS, "right")) - 1)
            p = at[k:end]
            ok[p] = _alike(self._keys(x[p], n[p]), n[p], self._keys(y[p], m[p]), m[p], threshold)
            k = end
        return ok


def elements(raw: bytes, width: int) -> np.ndarray:
    """The sorted set elements that ``width`` big-endian bytes each hold."""
    if width == 8:
        return np.frombuffer(raw, ">u8").astype(np.uint64)
    out = np.zeros((len(raw) // width, 8), np.uint8)
    out[:, 8 - width:] = np.frombuffer(raw, np.uint8).reshape(-1, width)
    return out.view(">u8").ravel().astype(np.uint64)


def _confirmed(sketches, width: int, threshold: int):
    def run(batches):
        for table, cut in whole_groups(batches, CELL, CHUNK // 8):
            ident = table.column("id").to_numpy()
            root, label = np.unique(table.column("label").to_numpy(), return_inverse=True)
            root = np.arange(len(root))
            contents = Contents(table.column("content").combine_chunks(), width)
            a, b = [], []

            def find(i):
                while root[i] != i:
                    i = root[i]
                return i

            for y, x, score in _partners(table, cut, sketches):
                order = np.lexsort((-score, y))
                y, x = y[order], x[order]
                new = np.append(True, y[1:] != y[:-1])
                place = np.arange(len(y)) - np.flatnonzero(new)[np.cumsum(new) - 1]
                upto = 1  # the likeliest first, then a few at a time
                while True:
                    apart = root[label[x]] != root[label[y]]
                    x, y, place = x[apart], y[apart], place[apart]
                    if not len(x):
                        break
                    now = place < upto
                    ok = contents.similar(x[now], y[now], threshold)
                    for i, j in zip(x[now][ok].tolist(), y[now][ok].tolist()):
                        p, q = find(label[i]), find(label[j])
                        if p != q:
                            root[max(p, q)] = min(p, q)
                            a.append(ident[i])
                            b.append(ident[j])
                    while (root != root[root]).any():
                        root = root[root]
                    x, y, place = x[~now], y[~now], place[~now]
                    upto += min(3 * upto, AT_ONCE)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return run


def deal(members: DataFrame, block: int = BLOCK) -> DataFrame:
    """The cells of all groups with several labels, from ``members`` (group
    binary, id long, label long, sketch binary; one row a group and id)."""
    by_label = members.groupBy("group", "label").agg(F.count("*").alias("n"))
    sizes = written(
        by_label.groupBy("group").agg(F.sum("n").alias("m"), F.max(F.struct("n", "label")).alias("top"))
        .filter("m > top.n")
        .select("group", "m", F.col("top.label").alias("common"),
                F.ceil(F.col("m") / block).cast("int").alias("rows"),
                F.ceil((F.col("m") - F.col("top.n")) / block).cast("int").alias("columns")), "groups")
    sized = join_sized(members, sizes, "group", "m").withColumn("outsider", F.col("label") != F.col("common"))
    place = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    names = ["group", "i", "j", "side", "outsider", "id", "label", "sketch"]
    along = sized.withColumns({"i": place("rows"), "side": F.lit(0)}).withColumn("j", every("columns"))
    down = sized.filter("outsider").withColumns({"j": place("columns"), "side": F.lit(1)}).withColumn("i", every("rows"))
    return along.select(names).unionByName(down.select(names))


def link_groups(members: DataFrame, contents: DataFrame, sketches, width: int, threshold: int, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that connect all truly linked pairs of one group and
    different labels.

    ``contents``: id, content (the sorted set elements, ``width`` big-endian
    bytes each).  ``sketches`` makes an object of a list of sketches whose
    ``scores(i, others)`` are positive where a pair may be linked."""
    dealt = deal(members, block)
    possible = written(dealt.repartition(*CELL).sortWithinPartitions(*CELL).mapInArrow(_possible(sketches), DEALT), "possible")
    return written(possible.join(contents, "id").select(*[c.split()[0] for c in DEALT.split(", ")], "content")
                   .repartition(*CELL).sortWithinPartitions(*CELL)
                   .mapInArrow(_confirmed(sketches, width, threshold), LINKS), "links")
