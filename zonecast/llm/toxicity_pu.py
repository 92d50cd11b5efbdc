"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic examples are taken as labels; everything else is
unlabelled text, which holds toxic rows too.  With class prior ``pi`` the
risk of a classifier ``f`` is estimated as

    pi * E_P[l(f, +)] + max(0, E_U[l(f, -)] - pi * E_P[l(f, -)])

(logistic loss); where the bracket falls below zero its gradient is turned
round, as in the non-negative estimator.  The classifier is linear over the
presence of words and word beginnings (inflected stems), trained with numpy on a bounded sample (``max_positive``
confirmed examples, ``max_unlabelled`` documents, both the first by a hash
of the id, copies of one example once) whose distinct feature hashes are
gathered, not its texts.  Every
whole document is then scored inside the scan, without a shuffle.

Defined results: a null or empty text has no words and gets the intercept's
score; ids are carried as they are, repeated rows are scored each; a null
label is no label, ids labelled twice count as toxic if any row says so.
Without a confirmed example every score is 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm import textblocks as tb
from zonecast.llm.common import fold, small_batches, text_frame

MAX_POSITIVE = 2000
MAX_UNLABELLED = 4000
MAX_WORDS = 1024      # features kept
PREFIXES = (4, 5, 6, 8)  # bytes of a word's beginning that are features too
MIN_POSITIVE_DOCS = 3  # a feature occurs in so many confirmed examples
MIN_G = 20.0          # and its signed G statistic is at least this
THRESHOLD = 0.3
SCORE_SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def word_sets(column):
    """Distinct feature hashes of each text."""
    for i, j, data, off in tb.blocks(column):
        h, text = tb.word_beginnings(data, off, PREFIXES)
        order = np.argsort(text, kind="stable")
        h, ends = h[order], np.searchsorted(text[order], np.arange(j - i + 1))
        for a, b in zip(ends[:-1], ends[1:]):
            yield np.unique(h[a:b])


def _g_test(p, np_, u, nu):
    """Signed G statistic of a word's document rates among both samples."""
    rate = (p + u) / (np_ + nu)
    g = np.zeros(len(p))
    for seen, n in ((p, np_), (u, nu)):
        for k, r in ((seen, rate), (n - seen, 1 - rate)):
            with np.errstate(divide="ignore", invalid="ignore"):
                g += np.where(k > 0, k * np.log(k / np.maximum(n * r, 1e-12)), 0.0)
    return np.where(p / np_ >= u / nu, g, -g)


class PULinear:
    """Linear classifier over word presence, trained by the nnPU risk."""

    def __init__(self, keys=None, weights=None, bias=0.0, empty=False):
        self.keys = np.zeros(0, np.uint64) if keys is None else keys
        self.weights = np.zeros(0) if weights is None else weights
        self.bias, self.empty = bias, empty

    @classmethod
    def train(cls, positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float,
              max_words: int = MAX_WORDS, min_g: float = MIN_G, steps: int = 600, rate: float = 0.05, l2: float = 2e-4) -> PULinear:
        if not positive or not unlabelled or prior <= 0:
            return cls(empty=True)
        np_, nu = len(positive), len(unlabelled)
        pk, pc = np.unique(np.concatenate(positive), return_counts=True)
        uk, uc = np.unique(np.concatenate(unlabelled), return_counts=True)
        often = pc >= min(MIN_POSITIVE_DOCS, np_)
        pk, pc = pk[often], pc[often]
        at = np.searchsorted(uk, pk)
        same = at < len(uk)
        same[same] = uk[at[same]] == pk[same]
        u = np.zeros(len(pk))
        u[same] = uc[at[same]]
        g = _g_test(pc.astype(float), np_, u, nu)
        best = np.argsort(-g, kind="stable")[:max_words]
        keys = np.sort(pk[best[g[best] >= min_g]])
        x = [cls._presence(keys, s) for s in (positive, unlabelled)]
        # Start from naive Bayes' intercept; Adam on the full sample.
        w = np.zeros(len(keys) + 1)
        w[-1] = np.log(prior / (1 - prior)) if prior < 1 else 0.0
        m, v = np.zeros_like(w), np.zeros_like(w)
        sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        for t in range(1, steps + 1):
            sp, su = sig(x[0] @ w), sig(x[1] @ w)
            softplus = lambda s: -np.log(np.maximum(1 - s, 1e-13))
            negative = softplus(su).mean() - prior * softplus(sp).mean()
            g_pos = prior * (x[0].T @ (sp - 1)) / np_
            g_neg = x[1].T @ su / nu - prior * (x[0].T @ sp) / np_
            grad = g_pos + g_neg if negative >= 0 else -g_neg
            grad[:-1] += l2 * w[:-1]
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
            w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        return cls(keys, w[:-1], float(w[-1]))

    @staticmethod
    def _presence(keys, sets):
        x = np.zeros((len(sets), len(keys) + 1), dtype=np.float32)
        x[:, -1] = 1
        for i, s in enumerate(sets):
            if len(s) and len(keys):
                at = np.minimum(np.searchsorted(s, keys), len(s) - 1)
                x[i, :-1] = s[at] == keys
        return x

    def score(self, column) -> np.ndarray:
        out = np.zeros(len(column))
        if self.empty:
            return out
        n = len(self.keys)
        for i, j, data, off in tb.blocks(column):
            z = np.full(j - i, self.bias)
            if n:
                h, text = tb.word_beginnings(data, off, PREFIXES)
                at = np.minimum(np.searchsorted(self.keys, h), n - 1)
                hit = self.keys[at] == h
                cell = np.unique(text[hit] * n + at[hit])  # presence, not counts
                z += np.bincount(cell // n, weights=self.weights[cell % n], minlength=j - i)
            out[i:j] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return out


def _gather(docs: DataFrame, ids: DataFrame, most: int) -> list[np.ndarray]:
    """Distinct word hashes of the sampled documents: ``most`` rows at most,
    however many rows an id has; equal texts of an id count once."""
    def sets(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("h"),
                 pa.array([s.tobytes() for s in word_sets(batch.column("text"))], pa.binary())], ["doc_id", "h", "words"])

    rows = (docs.withColumn("h", F.xxhash64("text")).join(F.broadcast(ids), "doc_id", "left_semi")
            .mapInArrow(sets, "doc_id long, h long, words binary").dropDuplicates(["doc_id", "h"])
            .orderBy(F.xxhash64("doc_id"), "doc_id", "h").limit(most).collect())
    return [np.frombuffer(r["words"], np.uint64) for r in sorted(rows, key=lambda r: (r["doc_id"], r["words"]))]


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          label: str = "toxic", mod: int = 4, held_out: int = 2, max_positive: int = MAX_POSITIVE,
          max_unlabelled: int = MAX_UNLABELLED) -> PULinear:
    """Fit on rows outside the held-out fold of the id's crc32."""
    small_batches(docs.sparkSession)
    src = text_frame(docs, doc_id, text).filter(fold("doc_id", mod) != held_out)
    marked = (labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
              .filter((fold("doc_id", mod) != held_out) & F.col("y").isNotNull())
              .groupBy("doc_id").agg(F.max("y").alias("y")))
    counts = marked.agg(F.count("*").alias("n"), F.sum((F.col("y") == 1).cast("long")).alias("p")).first()
    prior = (counts["p"] or 0) / counts["n"] if counts["n"] else 0.0
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    positive = marked.filter("y = 1").select("doc_id").orderBy(*order).limit(max_positive)
    unlabelled = src.select("doc_id").distinct().orderBy(*order).limit(max_unlabelled)
    examples = {s.tobytes(): s for s in _gather(src, positive, max_positive)}  # copies count once
    return PULinear.train(list(examples.values()), _gather(src, unlabelled, max_unlabelled), prior)


def score(docs: DataFrame, model: PULinear, doc_id: str = "doc_id", text: str = "text", mod: int = 4,
          held_out: int = 2, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            s = shared.value.score(b.column("text"))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    return (text_frame(docs, doc_id, text).withColumn("held_out", F.coalesce(fold("doc_id", mod) == held_out, F.lit(False)))
            .mapInArrow(run, SCORE_SCHEMA))


def drop_toxic(docs: DataFrame, model: PULinear, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that the model doesn't reject."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def keep(batches):
        for b in batches:
            yield b.filter(pa.array(shared.value.score(b.column(text)) < threshold))

    return docs.mapInArrow(keep, docs.schema)
