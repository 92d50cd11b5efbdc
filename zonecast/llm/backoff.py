"""Language-model scores from a weighted backoff automaton.

The model is a bigram model over words and an end mark with Dirichlet
smoothing: ``p(w|h) = (c(hw) + MU p(w)) / (c(h) + MU)``.  As an automaton:
every word (and the start) seen in training is a state; a seen bigram is an
arc of weight ``log10 p(w|h)`` to state ``w``; otherwise the failure arc of
weight ``log10 (MU / (c(h) + MU))`` leads to the empty state, whose arcs are
the unigrams.  Unigrams lose an absolute discount ``D = n1 / (n1 + 2 n2)``
each, and the mass set free is the unknown word's, so every state's weights
sum to one.  A text's score is one left-to-right walk that carries the state.

The automaton grows with the corpus and is never held in one place.  Texts
are dealt into blocks of about ``BLOCK_BYTES``; a block asks for the n-grams
it holds (sorted hashes, cut into buckets by their leading bits, with the
block's own training counts), each bucket adds up what the blocks report and
answers every block with corpus totals in the order it asked, and the block
builds the states and arcs its texts can touch.  What is shuffled is a packed
array for each block and bucket, already summed within the block, so a
frequent word or bigram is one entry a block.  Totals (N, V, n1, n2) are a
few numbers.

Words are compared by 64-bit, bigrams by 48-bit hashes.

Defined results: a null or empty text is the end mark alone; rows with a
null id are scored but not learned from and not held out; repeated rows
count and are scored each.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm import textblocks as tb
from zonecast.llm.common import fold, small_batches, text_frame, written

BLOCK_BYTES = 8 << 20
MU = 20.0
START, END = np.uint64(0x5354415254000001), np.uint64(0x454E440000000001)
SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
          "base_score double, score double")
ASKED = "kind int, bucket long, block long, n long, keys binary, counts binary"
ANSWERS = "kind int, bucket long, block long, n long, counts binary, total long, distinct long, once long, twice long"


def pack(values: np.ndarray, dtype: str) -> bytes:
    """Non-negative integers in a narrow type, with the few that don't fit
    behind them in full."""
    top = np.iinfo(dtype).max
    narrow = np.minimum(values, top).astype(dtype)
    return narrow.tobytes() + values[values >= top].astype("<u8").tobytes()


def unpack(raw: bytes, n: int, dtype: str) -> np.ndarray:
    narrow = np.frombuffer(raw, dtype, n)
    out = narrow.astype(np.uint64)
    out[narrow == np.iinfo(dtype).max] = np.frombuffer(raw, "<u8", offset=narrow.nbytes)
    return out


class Block:
    """The tokens of a block of texts as n-gram numbers.

    ``keys[k]``: sorted distinct n-gram hashes of kind k (0 words, 1 bigrams);
    ``at[k]``: for each token the number of its word, or of the bigram that
    ends in it; ``off``: token offsets by text (each text's end included).
    """

    def __init__(self, column):
        words, counts = [np.zeros(0, np.uint64)], []
        for _, _, data, off in tb.blocks(column):
            h, _, _, woff = tb.words(data, off)
            n = np.diff(woff)
            words.append(np.insert(h, woff[1:], END))
            counts.append(n + 1)
        token = np.concatenate(words)
        self.off = np.concatenate([[0], np.cumsum(np.concatenate(counts))]) if counts else np.zeros(1, np.int64)
        before = np.empty_like(token)
        before[1:] = token[:-1]
        before[self.off[:-1]] = START
        bigram = tb.mix(before * np.uint64(0xA24BAED4963EE407) + token * np.uint64(0x9FB21C651E98DF25)) >> np.uint64(16)
        self.keys, self.at = [], []
        for x in (token, bigram):
            keys, at = np.unique(x, return_inverse=True)
            self.keys.append(keys)
            self.at.append(at)
        # The state before each token: its predecessor's word number, -1 for the start.
        self.state = np.empty(len(token), np.int64)
        self.state[1:] = self.at[0][:-1]
        self.state[self.off[:-1]] = -1

    def training_counts(self, kind: int, train: np.ndarray) -> np.ndarray:
        learned = np.repeat(train, np.diff(self.off))
        return np.bincount(self.at[kind][learned], minlength=len(self.keys[kind]))


WIDTH = (64, 48)  # bits of a word's and a bigram's hash


def _edges(kind: int, bits: int) -> np.ndarray:
    return np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(WIDTH[kind] - bits)


def ask(key, table: pa.Table, bits: int):
    """What a block wants to know: its n-grams and their counts in it."""
    block = Block(table.column("text"))
    train = table.column("train").to_numpy()
    out = []
    for kind, keys in enumerate(block.keys):
        counts = block.training_counts(kind, train)
        cut = np.concatenate([[0], np.searchsorted(keys, _edges(kind, bits)), [len(keys)]])
        for bucket, (a, b) in enumerate(zip(cut[:-1], cut[1:])):
            if b > a:
                k = keys[a:b]
                packed = k.tobytes() if kind == 0 else pack(np.diff(k, prepend=np.uint64(0)), "<u4")
                out.append((kind, bucket, key[0].as_py(), b - a, packed, pack(counts[a:b].astype(np.uint64), "<u1")))
    return _table(out, ASKED)


def answer(key, table: pa.Table):
    """Add up a bucket's counts over all blocks; answer each in its order."""
    kind, bucket = key[0].as_py(), key[1].as_py()
    blocks, sizes = table.column("block").to_pylist(), table.column("n").to_pylist()
    keys, counts = [], []
    for n, k, c in zip(sizes, table.column("keys"), table.column("counts")):
        keys.append(np.frombuffer(k.as_py(), np.uint64) if kind == 0 else np.cumsum(unpack(k.as_py(), n, "<u4"), dtype=np.uint64))
        counts.append(unpack(c.as_py(), n, "<u1"))
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(at, weights=np.concatenate(counts), minlength=len(distinct)).astype(np.uint64)
    out = [(kind, bucket, -1, 0, b"", int(total.sum()), int((total > 0).sum()), int((total == 1).sum()), int((total == 2).sum()))]
    first = 0
    for b, n in zip(blocks, sizes):
        out.append((kind, bucket, b, n, pack(total[at[first:first + n]], "<u1"), 0, 0, 0, 0))
        first += n
    return _table(out, ANSWERS)


def _table(rows: list[tuple], schema: str) -> pa.Table:
    names, kinds = zip(*(x.split() for x in schema.split(", ")))
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "double": pa.float64()}
    columns = list(zip(*rows)) if rows else [[]] * len(names)
    return pa.table([pa.array(c, types[t]) for c, t in zip(columns, kinds)], names=list(names))


class BackoffAutomaton:
    """States, arcs and failure arcs over a block's n-grams.

    ``word_counts``/``bigram_counts``: corpus training counts by n-gram
    number; ``starts``: training texts; ``totals``: N, V, n1, n2 of words.
    """

    def __init__(self, word_counts, starts: int, totals: tuple[int, int, int, int], mu: float = MU):
        n, v, n1, n2 = totals
        self.mu, self.count = mu, word_counts.astype(float)
        d = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
        known = np.maximum(self.count - d, 0) / n if n else np.zeros(len(self.count))
        unknown = d * v / n if n else 1.0
        self.unigram = np.where(self.count > 0, known, unknown)   # arcs of the empty state
        self.state_count = np.append(self.count, starts)          # the last is the start, also as -1
        self.base = np.log10((self.count + 0.1) / (n + 0.1 * (v + 1)))

    def walk(self, state: np.ndarray, word: np.ndarray, arc_count: np.ndarray) -> np.ndarray:
        """log10 weight of each step: from ``state`` along the arc of
        ``word`` if training saw it, else the failure arc and a unigram."""
        c = self.state_count[state]
        p = self.unigram[word]
        arc = np.log10((arc_count + self.mu * p) / (c + self.mu))
        failure = np.log10(self.mu / (c + self.mu))
        return np.where(arc_count > 0, arc, failure + np.log10(p))


def score_block(texts: pa.Table, answers: pa.Table, starts: int, totals, mu: float) -> pa.Table:
    if texts.num_rows == 0:
        return _table([], SCORES)
    block = Block(texts.column("text"))
    counts = [np.zeros(len(k)) for k in block.keys]
    cut = [0, 0]
    rows = sorted(zip(answers.column("kind").to_pylist(), answers.column("bucket").to_pylist(),
                      answers.column("n").to_pylist(), answers.column("counts").to_pylist()), key=lambda r: r[:2])
    for kind, _, n, raw in rows:
        counts[kind][cut[kind]:cut[kind] + n] = unpack(raw, n, "<u1")
        cut[kind] += n
    automaton = BackoffAutomaton(counts[0], starts, totals, mu)
    word, bigram = block.at
    steps = automaton.walk(block.state, word, counts[1][bigram])
    sums = lambda x: np.add.reduceat(x, block.off[:-1])  # noqa: E731  every text has its end
    return pa.table([
        texts.column("doc_id"), texts.column("held_out"), pa.array(np.diff(block.off)),
        pa.array(sums((counts[0][word] > 0).astype(np.int64))), pa.array(np.full(texts.num_rows, totals[0], np.int64)),
        pa.array(sums(automaton.base[word])), pa.array(sums(steps)),
    ], names=[x.split()[0] for x in SCORES.split(", ")])


def scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", mod: int = 10, held_out: int = 0,
           mu: float = MU, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Score every row; learn from rows outside the held-out fold."""
    spark = docs.sparkSession
    small_batches(spark)
    part = fold("doc_id", mod)
    src = (text_frame(docs, doc_id, text)
           .withColumn("held_out", F.coalesce(part == held_out, F.lit(False)))
           .withColumn("train", F.coalesce(part != held_out, F.lit(False))))
    size = src.agg(F.sum(F.octet_length("text")).alias("b"), F.count("*").alias("n"),
                   F.sum(F.col("train").cast("long")).alias("starts")).first()
    n_blocks = max(1, -(-(size["b"] or 0) // block_bytes), -(-size["n"] // 500_000))
    bits = min(24, max(0, math.ceil(math.log2(n_blocks)) - 1))
    src = src.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)))
    asked = src.groupBy("block").applyInArrow(lambda k, t: ask(k, t, bits), ASKED)
    answers = written(asked.groupBy("kind", "bucket").applyInArrow(lambda k, t: answer(k, t), ANSWERS), "ngrams")
    row = answers.filter("block = -1 AND kind = 0").agg(*(F.sum(c).alias(c) for c in ("total", "distinct", "once", "twice"))).first()
    totals = tuple(int(x or 0) for x in row)
    starts = int(size["starts"] or 0)
    told = answers.filter("block >= 0")

    def score(texts, told):
        return score_block(texts, told, starts, totals, mu)

    return src.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(score, SCORES)
