"""Quality by nearest-neighbour voting in a latent-semantic space.

Words and word shapes (``Hello!!`` -> ``Aa!``) are hashed into a fixed number
of bins, and the counts of lines seen before and of words equal to the last
one have bins by powers of two; a text is its log term frequencies times the inverse document
frequencies of all documents, scaled to length one.  A bounded sample of
labelled documents (``max_labelled``, the first by a hash of the id) gives
the latent axes by a singular value decomposition; their vectors are
broadcast (``max_labelled`` x ``DIMS`` doubles).  Every document is projected
and compared with all of them in blocked matrix products (exact cosines);
the ``NEIGHBOURS`` most similar vote, weighted by similarity.

Document frequencies cover all documents: each task adds up its bins, so
what is shuffled is one row a bin and task.

Defined results: a null or empty text has no bins and is scored the share
of label 1 among the sampled rows, as is every text if none is labelled
(0.5 then); ids are carried, repeated rows are scored each; an id labelled
twice takes the larger label, null labels are none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm import textblocks as tb
from zonecast.llm.common import fold, small_batches, text_frame

MAX_LABELLED = 3000
WORD_BINS, SHAPE_BINS = 2048, 1024
LEVELS = 8             # a bin for each power of two of repeated lines, and of repeated words
BINS = WORD_BINS + SHAPE_BINS + 2 * LEVELS
DIMS = 64
NEIGHBOURS = 25
SHARPNESS = 4          # weight = cosine ** SHARPNESS
THRESHOLD = 0.5
ROWS = 256             # texts of a block of products
SCORE_SCHEMA = "doc_id long, held_out boolean, score double, predicted int"

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[65:91], _SHAPE[97:123], _SHAPE[48:58], _SHAPE[128:] = 1, 2, 48, 2  # byte 1 for A-Z: not folded


def _shapes(data: np.ndarray, off: np.ndarray):
    """Word hashes of the text with runs of one character class collapsed."""
    cls = _SHAPE[data]
    keep = np.ones(len(data), dtype=bool)
    keep[1:] = cls[1:] != cls[:-1]
    keep[off[:-1][off[:-1] < len(data)]] = True
    h, _, _, woff = tb.words(cls[keep], np.concatenate([[0], np.cumsum(keep)])[off])
    return h, woff


def _repeated_lines(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """For each text the number of its lines seen earlier in it."""
    out = np.zeros(len(off) - 1)
    raw = data.tobytes()
    for d, (a, b) in enumerate(zip(off[:-1], off[1:])):
        lines = [x for x in raw[a:b].split(b"\n") if x]
        out[d] = len(lines) - len(set(lines))
    return out


def term_frequencies(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Dense texts x BINS matrix of log(1 + count)."""
    n = len(off) - 1
    x = np.zeros(n * BINS)
    if len(data):
        h, _, _, woff = tb.words(data, off)
        s, soff = _shapes(data, off)
        text = lambda o: np.repeat(np.arange(n), np.diff(o)) * BINS
        x += np.bincount(text(woff) + (h % np.uint64(WORD_BINS)).astype(np.int64), minlength=n * BINS)
        x += np.bincount(text(soff) + WORD_BINS + (s % np.uint64(SHAPE_BINS)).astype(np.int64), minlength=n * BINS)
        same = np.zeros(len(h), dtype=bool)
        same[1:] = h[1:] == h[:-1]
        same[woff[:-1][woff[:-1] < len(h)]] = False
        total = np.concatenate([[0], np.cumsum(same)])
        for base, count in ((LEVELS, total[woff[1:]] - total[woff[:-1]]), (0, _repeated_lines(data, off))):
            some = np.flatnonzero(count)
            level = np.minimum(np.log2(count[some]).astype(np.int64), LEVELS - 1)
            x[some * BINS + WORD_BINS + SHAPE_BINS + base + level] = 2 ** level
    return np.log1p(x, out=x).reshape(n, BINS)


def matrices(column):
    """(first row, term matrix) of runs of at most ROWS texts."""
    for i, j, data, off in tb.blocks(column):
        for a in range(0, j - i, ROWS):
            b = min(a + ROWS, j - i)
            yield i + a, term_frequencies(data[off[a]:off[b]], off[a:b + 1] - off[a])


def document_frequencies(src: DataFrame) -> tuple[np.ndarray, int]:
    """Documents holding each bin, and the number of all documents."""
    def count(batches):
        seen, rows = np.zeros(BINS, np.int64), 0
        for b in batches:
            for _, x in matrices(b.column("text")):
                seen += (x > 0).sum(axis=0)
                rows += len(x)
        bins = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(bins, -1)), pa.array(np.append(seen[bins], rows))], ["bin", "n"])

    rows = src.select("text").mapInArrow(count, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect()
    df, total = np.zeros(BINS), 0
    for r in rows:  # at most BINS + 1
        if r["bin"] < 0:
            total = r["n"]
        else:
            df[r["bin"]] = r["n"]
    return df, total


class LatentNeighbours:
    """Latent vectors and labels of the sample, and the projection."""

    def __init__(self, idf: np.ndarray, terms: np.ndarray, labels: np.ndarray, dims: int = DIMS):
        self.idf, self.labels = idf, labels.astype(float)
        self.prior = float(self.labels.mean()) if len(labels) else 0.5
        x = self._scaled(terms) if len(labels) else np.zeros((0, BINS))
        self.axes = np.zeros((BINS, 0))
        if len(x):
            value, left = np.linalg.eigh(x @ x.T)
            keep = np.argsort(-value)[:dims]
            keep = keep[value[keep] > 1e-9 * max(value.max(), 1e-300)]
            self.axes = x.T @ (left[:, keep] / np.sqrt(value[keep]))
        self.vectors = self._unit(x @ self.axes)

    def _scaled(self, terms):
        return self._unit(terms * self.idf)

    @staticmethod
    def _unit(x):
        n = np.sqrt((x * x).sum(axis=1, keepdims=True))
        return np.divide(x, n, out=np.zeros_like(x), where=n > 1e-12)

    def score(self, terms: np.ndarray) -> np.ndarray:
        if not len(self.vectors):
            return np.full(len(terms), self.prior)
        cosine = self._unit(self._scaled(terms) @ self.axes) @ self.vectors.T
        k = min(NEIGHBOURS, cosine.shape[1])
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.clip(np.take_along_axis(cosine, near, axis=1), 0, 1) ** SHARPNESS
        vote = (weight * self.labels[near]).sum(axis=1)
        return np.clip((vote + 0.1 * self.prior) / (weight.sum(axis=1) + 0.1), 0, 1)


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
          mod: int = 3, held_out: int = 1, max_labelled: int = MAX_LABELLED) -> LatentNeighbours:
    """Fit on labelled rows outside the held-out fold of the id's crc32."""
    small_batches(docs.sparkSession)
    src = text_frame(docs, doc_id, text)
    df, total = document_frequencies(src)
    idf = np.log((1 + total) / (1 + df)) + 0.1
    marked = (labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
              .filter((fold("doc_id", mod) != held_out) & F.col("y").isNotNull())
              .groupBy("doc_id").agg(F.max("y").alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled))

    def sparse(batches):
        for b in batches:
            ids, y = b.column("doc_id").to_pylist(), b.column("y").to_pylist()
            rows = []
            for i, x in matrices(b.column("text")):
                for k, row in enumerate(x):
                    at = np.flatnonzero(row)
                    rows.append((ids[i + k], y[i + k], at.astype("<i4").tobytes(), row[at].astype("<f4").tobytes()))
            cols = list(zip(*rows)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.binary(), pa.binary()))],
                ["doc_id", "y", "bins", "terms"])

    rows = (src.join(F.broadcast(marked), "doc_id")
            .mapInArrow(sparse, "doc_id long, y int, bins binary, terms binary").dropDuplicates()
            .orderBy(F.xxhash64("doc_id"), "doc_id", "bins", "terms").limit(max_labelled).collect())  # however many rows an id has
    rows.sort(key=lambda r: (r["doc_id"], r["bins"]))
    terms = np.zeros((len(rows), BINS))
    for x, r in zip(terms, rows):
        x[np.frombuffer(r["bins"], "<i4")] = np.frombuffer(r["terms"], "<f4")
    return LatentNeighbours(idf, terms, np.array([r["y"] for r in rows]))


def score(docs: DataFrame, model: LatentNeighbours, doc_id: str = "doc_id", text: str = "text", mod: int = 3,
          held_out: int = 1, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            s = np.zeros(b.num_rows)
            for i, x in matrices(b.column("text")):
                s[i:i + len(x)] = shared.value.score(x)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    return (text_frame(docs, doc_id, text).withColumn("held_out", F.coalesce(fold("doc_id", mod) == held_out, F.lit(False)))
            .mapInArrow(run, SCORE_SCHEMA))
