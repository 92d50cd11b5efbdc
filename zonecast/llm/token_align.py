"""Alignment of two tokenisations of every text, and of their vocabularies.

Tokeniser A (byte-level BPE) encodes a space and the text, tokeniser B
(sentence pieces, which adds that space itself) the text; both cover the same
bytes.  Where a token of A and one of B end at the same byte, both sequences
are cut, which gives groups; the two tokens that end there are linked.

The ends are compared by diagonal run skipping: while the sequences run one
to one at the current shift (index in B less index in A), slices of 4, 8, 16,
... ends are compared at once and halved again at the first difference; then
the irregular group is resolved locally, the smaller end moving on until both
meet, and the shift is updated.  (Slices are compared whole: equal ends far
ahead alone could hide two irregular groups that cancel out.)

An id pair's count, over all documents, says how often it is linked; a pair
is best if no other pair of its B id has a higher count.  Documents are
encoded once; each keeps its distinct pairs and how often it holds them.
Counts are summed up in every task before the shuffle.  They go back to the
documents by a broadcast for pairs that make up more than one link in ``HOT``
(fewer than ``HOT`` pairs, however large the corpus) and by a join for the
rest, so that no frequent pair is gathered in one task.

Defined results: texts that are null, empty, or that a tokeniser doesn't give
back byte for byte (with the leading space) have no tokens: zeros, and '' for
the digest.  Ids are carried as they are and repeated rows give repeated
rows, each of them counted.  Special tokens' strings are ordinary text.  An
empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import small_batches, text_frame, written

HOT = 200_000           # a pair with more than one link in HOT is broadcast
BLOCK_CHARS = 1 << 19   # texts are encoded in blocks of about this size
LONG_SPACE = " " * 10_000  # runs that a backtracking pattern may refuse
DIGESTS = ("doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<long>, times array<int>")
SPANS = "doc_id long, a_ids array<int>, b_ids array<int>, a_ends array<int>, b_ends array<int>"


def align(a: list[int], b: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """For increasing byte ends with the same last one: of each group the
    index after its last token, in A and in B."""
    irregular = []  # (first, last) token of A, (first, last) of B
    i = j = 0
    n = len(a)
    while i < n:
        if a[i] == b[j]:  # a stretch at shift j - i
            i += 1
            j += 1
            step = 4
            while (ahead := a[i:i + step]) and ahead == b[j:j + step]:
                i += len(ahead)
                j += len(ahead)
                step *= 2
            while step > 1:
                step //= 2
                ahead = a[i:i + step]
                if ahead == b[j:j + step]:
                    i += len(ahead)
                    j += len(ahead)
        else:
            p, q = i, j
            x, y = a[i], b[j]
            while x != y:
                if x < y:
                    i += 1
                    x = a[i]
                else:
                    j += 1
                    y = b[j]
            irregular.append((p, i, q, j))
            i += 1
            j += 1
    spans = np.array(irregular, dtype=np.int64).reshape(-1, 4)

    def cuts(size, first, last):  # every token ends a group but those before an irregular group's last
        depth = np.zeros(size + 1, dtype=np.int8)
        depth[first] += 1
        depth[last] -= 1
        return np.flatnonzero(np.cumsum(depth[:-1]) == 0) + 1

    return cuts(n, spans[:, 0], spans[:, 1]), cuts(len(b), spans[:, 2], spans[:, 3])


def byte_level_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for:
    printable Latin-1 itself, the other bytes from U+0100 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(x): x for x in shown}
    for k, x in enumerate(x for x in range(256) if x not in shown):
        out[chr(0x100 + k)] = x
    return out


def ranked_encoder(a: dict):
    """The same vocabulary in tiktoken, which gives equal ids several times
    faster, if the file is plain byte-level BPE: its merges make ids in
    ascending order and texts are cut by the usual pattern.  Else None."""
    import public_tokenizers
    import tiktoken

    cut, model = a.get("pre_tokenizer") or {}, a["model"]
    plain = (cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
             and a.get("normalizer") is None and not model.get("dropout") and not model.get("ignore_merges"))
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
    made = [model["vocab"].get(x + y, -1) for x, y in pairs]
    if not plain or any(x >= y for x, y in zip(made, made[1:])):
        return None
    byte = byte_level_alphabet()
    ranks = {bytes([x]): model["vocab"].get(c) for c, x in byte.items()}
    ranks |= {bytes(byte[c] for c in x + y): i for (x, y), i in zip(pairs, made)}
    if None in ranks.values() or (made and max(ranks[bytes([x])] for x in range(256)) >= made[0]):
        return None
    return tiktoken.Encoding("aligned", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class Tokens:
    """A vocabulary's token bytes and the texts that the digest is made of."""

    def __init__(self, tokens: list[bytes], ends_with: str):
        self.bytes = tokens
        self.size = np.array([len(t) for t in tokens], dtype=np.int64)
        self.shown = [f"{i}{mark}".encode() for i in range(len(tokens)) for mark in (",", ends_with)]

    def join(self, ids) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


class Aligner:
    """Both tokenisers, from their files' contents."""

    def __init__(self, a_json: bytes, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task a core
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_str(a_json.decode("utf-8"))
        self.a.encode_special_tokens = True
        self.ranked = ranked_encoder(json.loads(a_json))
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        byte = byte_level_alphabet()
        vocabulary = self.a.get_vocab()
        entries = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            entries[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        self.a_tokens = Tokens(entries, "|")
        pieces = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            raw = re.fullmatch("<0x([0-9A-F]{2})>", piece) if self.b.is_byte(i) else None
            pieces.append(bytes([int(raw[1], 16)]) if raw else piece.replace("▁", " ").encode())
        self.b_tokens = Tokens(pieces, ";")
        self.shown = self.a_tokens.shown + self.b_tokens.shown

    def a_ids(self, texts: list[str]) -> list[list[int]]:
        if self.ranked and not any(LONG_SPACE in t for t in texts):
            return list(map(self.ranked.encode_ordinary, texts))
        return [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str | None]):
        """(ids of A, ids of B) of each text; both empty where defined so."""
        first, chars = 0, 0
        for k, text in enumerate(texts):
            chars += len(text or "")
            if chars >= BLOCK_CHARS or k + 1 == len(texts):
                yield from self._encode(texts[first:k + 1])
                first, chars = k + 1, 0

    def _encode(self, texts):
        spaced = [" " + t if t else "" for t in texts]
        for text, ids, y in zip(spaced, self.a_ids(spaced), self.b.encode([t or "" for t in texts], num_threads=1)):
            want = text.encode()
            yield (ids, y) if want and self.a_tokens.join(ids) == want == self.b_tokens.join(y) else ([], [])

    def cuts(self, a_ids, b_ids) -> tuple[np.ndarray, np.ndarray]:
        return align(np.cumsum(self.a_tokens.size[a_ids]).tolist(), np.cumsum(self.b_tokens.size[b_ids]).tolist())

    def groups(self, a_ids, b_ids, a_cut, b_cut) -> bytes:
        """``a1,a2|b1;a3|b2,b3``: the ids of each group."""
        codes = np.empty(len(a_ids) + len(b_ids), dtype=np.int64)
        a_code, b_code = 2 * a_ids, 2 * b_ids + len(self.a_tokens.shown)
        a_code[a_cut - 1] += 1
        b_code[b_cut - 1] += 1
        before = np.append(0, b_cut[:-1])  # tokens of B before each group
        codes[np.arange(len(a_ids)) + np.repeat(before, np.diff(a_cut, prepend=0))] = a_code
        codes[np.arange(len(b_ids)) + np.repeat(a_cut, np.diff(b_cut, prepend=0))] = b_code
        return b"".join(map(self.shown.__getitem__, codes.tolist()))[:-1]

    def digest(self, a_ids, b_ids):
        if not a_ids:
            return 0, 0, 0, "", [], []
        a_ids, b_ids = np.array(a_ids, dtype=np.int64), np.array(b_ids, dtype=np.int64)
        a_cut, b_cut = self.cuts(a_ids, b_ids)
        pairs, times = np.unique(a_ids[a_cut - 1] * len(self.b_tokens.bytes) + b_ids[b_cut - 1], return_counts=True)
        digest = hashlib.sha256(self.groups(a_ids, b_ids, a_cut, b_cut)).hexdigest()
        return len(a_ids), len(b_ids), len(a_cut), digest, pairs, times.astype(np.int32)

    def spans(self, a_ids, b_ids):
        if not a_ids:
            return [], [], [], []
        a_ids, b_ids = np.array(a_ids, dtype=np.int64), np.array(b_ids, dtype=np.int64)
        return tuple(x.astype(np.int32) for x in (a_ids, b_ids, *self.cuts(a_ids, b_ids)))


@lru_cache(2)
def _aligner(a_json: bytes, b_model: bytes) -> Aligner:
    """One a worker: the tables are built once."""
    return Aligner(a_json, b_model)


def _run(docs: DataFrame, a_path: str, b_path: str, doc_id: str, text: str, schema: str, method: str) -> DataFrame:
    spark = docs.sparkSession
    small_batches(spark)
    contents = []
    for path in (a_path, b_path):  # two fixed vocabulary files
        with open(path, "rb") as f:
            contents.append(spark.sparkContext.broadcast(f.read()))
    names = [c.split()[0] for c in schema.split(", ")]
    types = [{"long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64()),
              "array<int>": pa.list_(pa.int32())}[c.split()[1]] for c in schema.split(", ")]

    def run(batches):
        aligner = None
        for batch in batches:
            aligner = aligner or _aligner(*(c.value for c in contents))
            rows = [getattr(aligner, method)(*ids) for ids in aligner.encode(batch.column("text").to_pylist())]
            columns = list(zip(*rows)) if rows else [[] for _ in names[1:]]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types[1:]))], names)

    return text_frame(docs, doc_id, text).mapInArrow(run, schema)


def spans(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, both id sequences, and of each group the index after its last
    token in either, of every row."""
    return _run(docs, a_path, b_path, doc_id, text, SPANS, "spans")


def digests(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Sizes, digest, and distinct linked pairs with their numbers, written
    once: row (of the written table), doc_id, ...; a pair is A's id times the
    size of B's vocabulary, plus B's id."""
    table = _run(docs, a_path, b_path, doc_id, text, DIGESTS, "digest")
    return written(table.withColumn("row", F.monotonically_increasing_id()), "alignments")


def vocabulary_size(b_path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()


def linked_pairs(aligned: DataFrame, b_size: int) -> DataFrame:
    """pair, a_id, b_id, n (links of all documents that hold it), best."""
    held = aligned.select(F.inline(F.arrays_zip("pairs", "times")))
    counted = written(held.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("n"))
                      .withColumn("b_id", F.col("pair") % b_size), "pairs")
    top = counted.groupBy("b_id").agg(F.max("n").alias("top"))  # at most B's vocabulary
    return (counted.join(F.broadcast(top), "b_id")
            .select("pair", ((F.col("pair") - F.col("b_id")) / b_size).cast("long").alias("a_id"), "b_id", "n",
                    (F.col("n") == F.col("top")).alias("best")))


def alignment_report(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text",
                     hot: int = HOT) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256
    of every row."""
    aligned = digests(docs, a_path, b_path, doc_id, text)
    pairs = written(linked_pairs(aligned, vocabulary_size(b_path)).select("pair", "n", "best"), "linked")
    links = pairs.agg(F.sum("n")).first()[0] or 0
    frequent = F.broadcast(pairs.filter(F.col("n") * hot > links))
    held = aligned.select("row", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    rare = (held.join(frequent.select("pair"), "pair", "left_anti")
            .join(pairs.filter(F.col("n") * hot <= links), "pair"))
    own = [F.sum(F.when(F.col("best"), F.col("times"))).alias("n_best"), F.sum(F.col("n") * F.col("times")).alias("count_sum")]
    sums = (held.join(frequent, "pair").groupBy("row").agg(*own)
            .unionByName(rare.groupBy("row").agg(*own))
            .groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))
    return aligned.join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
        F.coalesce("n_best", F.lit(0)).alias("n_best"), F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256")
