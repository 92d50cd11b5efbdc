"""Byte-level BPE encoding and decoding by a two-tier lookup.

Texts are cut into pre-tokens by vectorised boundary rules that follow the
public split pattern exactly (contractions; letters, numbers or other marks
with one leading space; white space).  Tier one: a minimal perfect hash over
the vocabulary's byte strings resolves pre-tokens that are tokens.  Tier two,
for the misses: bytes as a linked list, adjacent pairs in a heap by merge
rank (position breaks ties), stale heap entries skipped; a pre-token of n
bytes takes O(n log n), so long runs without a break stay cheap.

Each distinct pre-token of a batch is resolved once; misses are remembered
by a bounded per-worker table (``MEMO``), which only saves time.

Defined results: a null text encodes like an empty one, to no ids (the hash
of no bytes); ids are carried as they are and repeated rows give repeated
result rows; special tokens' strings are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache
from heapq import heapify, heappop, heappush
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from zonecast.llm import textblocks as tb
from zonecast.llm.common import small_batches, text_frame

MEMO = 300_000  # remembered pre-tokens of a worker, and as many older ones
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
_OTHER, _LETTER, _NUMBER, _SPACE = 0, 1, 2, 3


@lru_cache(1)
def _classes() -> np.ndarray:
    """Character class of every code point, from the Unicode properties."""
    out = np.zeros(0x110000, dtype=np.uint8)
    everything = "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))
    for cls, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, everything):
            a, b = ord(m[0][0]), ord(m[0][-1])
            out[a:b + 1] = cls
    out[0xD800:0xE000] = _OTHER
    return out


def pretoken_starts(chars: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Flags of the code points that begin a pre-token.

    ``first``: flags of the code points that begin a text.
    """
    n = len(chars)
    cls = _classes()[chars]
    new_text = np.append(first, True)  # also past the end
    prev_same = np.zeros(n, dtype=bool)
    prev_same[1:] = (cls[1:] == cls[:-1]) & ~first[1:]
    start = ~prev_same
    space = cls == _SPACE
    # The last white space before a non-space is its own pre-token, or the
    # leading space of the next one when it is U+0020.
    last = space & ~new_text[1:] & ~np.append(space[1:], True)
    start |= last
    lead = np.flatnonzero(last & (chars == 0x20))
    start[lead + 1] = False
    # Contractions: a pre-token that begins with a lone apostrophe.
    apostrophe = np.flatnonzero((chars == 0x27) & start)
    if len(apostrophe):
        at = lambda k: np.where(apostrophe + k < n, chars[np.minimum(apostrophe + k, n - 1)], 0)
        inside = lambda k: (apostrophe + k < n) & ~new_text[np.minimum(apostrophe + k, n)]
        c1, c2 = at(1), at(2)
        one = inside(1) & np.isin(c1, [ord(c) for c in "stmd"])
        two = np.zeros(len(apostrophe), dtype=bool)
        for a, b in ("re", "ve", "ll"):
            two |= (c1 == ord(a)) & (c2 == ord(b))
        two &= inside(1) & inside(2)
        for which, size in ((one, 1), (two & ~one, 2)):
            a = apostrophe[which]
            for k in range(1, size + 1):
                start[a + k] = False
            follows = a + size + 1
            follows = follows[follows < n]
            start[follows[cls[follows] == _LETTER]] = True
    return start


class MinimalPerfectHash:
    """Byte strings to 0..n-1 without gaps: a cascade of bit arrays.

    On each level the remaining keys hash into an array; keys alone in their
    cell keep it, the rest go on.  A key's number is the rank of its cell
    among all set cells.  Other strings may land anywhere, so callers
    compare the stored string.
    """

    def __init__(self, hashes: np.ndarray, gamma: float = 1.5):
        if len(np.unique(hashes)) != len(hashes):
            raise ValueError("two keys have the same 64-bit hash")
        self.sizes, bits = [], []
        left = hashes
        while len(left):
            size = max(8, int(len(left) * gamma))
            cell = self._cell(left, len(self.sizes), size)
            alone = np.bincount(cell, minlength=size) == 1
            bits.append(alone)
            self.sizes.append(size)
            left = left[~alone[cell]]
        self.bits = np.concatenate(bits) if bits else np.zeros(0, dtype=bool)
        self.rank = np.cumsum(self.bits) - 1

    @staticmethod
    def _cell(h, level, size):
        return (tb.mix(h + np.uint64(0x9E3779B97F4A7C15 * (level + 1) & (2**64 - 1))) % np.uint64(size)).astype(np.int64)

    def lookup(self, h: np.ndarray) -> np.ndarray:
        """The number of each key; -1 for hashes that end on no level."""
        out = np.full(len(h), -1, dtype=np.int64)
        todo, base = np.arange(len(h)), 0
        for level, size in enumerate(self.sizes):
            cell = base + self._cell(h[todo], level, size)
            hit = self.bits[cell]
            out[todo[hit]] = self.rank[cell[hit]]
            todo = todo[~hit]
            base += size
        return out


def _hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans (case kept)."""
    p, inv = tb._powers(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_CASED[data] * p[:len(data)], out=total[1:])
    return tb.mix((total[end] - total[start]) * inv[start] ^ (end - start).astype(np.uint64))


_CASED = np.random.default_rng(424242).integers(1, 2**64, 256, dtype=np.uint64)


class ByteBPE:
    """Encoder and decoder for a table of byte strings and their ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        tokens = list(ranks)
        blob = np.frombuffer(b"".join(tokens), np.uint8)
        ends = np.cumsum([len(t) for t in tokens])
        hashes = _hash_spans(blob, ends - [len(t) for t in tokens], ends)
        self.mph = MinimalPerfectHash(hashes)
        slot = self.mph.lookup(hashes)
        self.slot_hash = np.zeros(len(tokens), dtype=np.uint64)
        self.slot_hash[slot] = hashes
        self.slot_token: list[bytes] = [b""] * len(tokens)
        for s, t in zip(slot, tokens):
            self.slot_token[s] = t
        self.decoder: dict[int, bytes] = {i: t for t, i in ranks.items()}
        self.byte_id = [ranks[bytes([b])] for b in range(256)]
        # Every merge of two tokens into a third, keyed by both ids.
        self.pair: dict[int, int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.pair[left << 20 | right] = rank
        self.memo: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    @classmethod
    def from_file(cls, path: str) -> ByteBPE:
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})

    def merge(self, piece: bytes) -> list[int]:
        """Heap over linked bytes: always the lowest rank, leftmost first.

        A heap entry is ``rank << 32 | position`` of a pair's left side; it
        is stale when the pair there has another rank (or is gone) by now.
        """
        ids = [self.byte_id[b] for b in piece]
        n, rank, push, pop = len(ids), self.pair.get, heappush, heappop
        now = [rank(a << 20 | b, -1) for a, b in zip(ids, ids[1:])]  # each pair's rank
        heap = [r << 32 | i for i, r in enumerate(now) if r >= 0]
        if not heap:
            return ids
        heapify(heap)
        now.append(-1)
        nxt = list(range(1, n + 1))
        prv = list(range(-1, n - 1))
        while heap:
            e = pop(heap)
            i, r = e & 0xFFFFFFFF, e >> 32
            if now[i] != r:
                continue
            j = nxt[i]
            k = nxt[j]
            ids[i], ids[j], now[j], nxt[i] = r, -1, -1, k
            s = -1
            if k < n:
                prv[k] = i
                s = rank(r << 20 | ids[k], -1)
                if s >= 0:
                    push(heap, s << 32 | i)
            now[i] = s
            h = prv[i]
            if h >= 0:
                now[h] = s = rank(ids[h] << 20 | r, -1)
                if s >= 0:
                    push(heap, s << 32 | h)
        return [x for x in ids if x >= 0]

    def resolve(self, pieces: list[bytes], hashes: np.ndarray) -> list[bytes]:
        """Little-endian 32-bit ids of distinct pre-tokens."""
        slot = self.mph.lookup(hashes)
        known = slot >= 0
        known[known] = self.slot_hash[slot[known]] == hashes[known]
        out = []
        for piece, s, k in zip(pieces, slot.tolist(), known.tolist()):
            if k and self.slot_token[s] == piece:
                out.append(self.ranks[piece].to_bytes(4, "little"))
                continue
            ids = self.memo.get(piece)
            if ids is None:
                ids = self.older.get(piece)
                if ids is None:
                    merged = self.merge(piece)
                    ids = pack(f"<{len(merged)}I", *merged)
                if len(piece) <= 64:
                    if len(self.memo) >= MEMO:  # the pieces not seen lately go
                        self.memo, self.older = {}, self.memo
                    self.memo[piece] = ids
            out.append(ids)
        return out

    def encode_column(self, column, block_bytes: int = 1 << 20):
        """Yield each text's ids as little-endian 32-bit bytes, in order."""
        for _, _, data, off in tb.blocks(column, block_bytes):
            if not len(data):
                yield from (b"" for _ in range(len(off) - 1))
                continue
            chars = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
            at = np.flatnonzero((data & 0xC0) != 0x80)  # byte of each code point
            first = np.zeros(len(chars), dtype=bool)
            begin = np.searchsorted(at, off[:-1])
            first[begin[begin < len(chars)]] = True
            start = at[np.flatnonzero(pretoken_starts(chars, first))]
            end = np.append(start[1:], len(data))
            hashes = _hash_spans(data, start, end)
            distinct, where, inverse = np.unique(hashes, return_index=True, return_inverse=True)
            raw = data.tobytes()
            pieces = [raw[a:b] for a, b in zip(start[where].tolist(), end[where].tolist())]
            ids = self.resolve(pieces, distinct)
            bounds = np.searchsorted(start, off)
            order = inverse.tolist()
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                yield b"".join([ids[k] for k in order[a:b]])

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(next(self.encode_column(pa.array([text]))), "<u4").tolist()

    def decode_bytes(self, ids) -> bytes:
        return b"".join(map(self.decoder.__getitem__, ids))


_coders: dict[str, ByteBPE] = {}


def coder(path: str, content: bytes) -> ByteBPE:
    """One coder per worker and vocabulary; tables are built once."""
    key = hashlib.sha256(content).hexdigest()
    if key not in _coders:
        _coders[key] = ByteBPE({base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())})
    return _coders[key]


def encode_documents(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (little-endian 32-bit binary) of every row."""
    return _run(docs, vocabulary, doc_id, text, "doc_id long, ids binary",
                lambda ids, bpe: (ids,))


def digest_documents(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every text, decode the ids again, return both digests."""
    def digest(ids, bpe):
        decoded = bpe.decode_bytes(np.frombuffer(ids, "<u4").tolist())
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()

    return _run(docs, vocabulary, doc_id, text, SCHEMA, digest)


def _run(docs, vocabulary, doc_id, text, schema, row):
    spark = docs.sparkSession
    small_batches(spark)
    with open(vocabulary, "rb") as f:
        content = spark.sparkContext.broadcast(f.read())  # a fixed vocabulary file
    names = [x.split()[0] for x in schema.split(", ")]
    types = [{"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[x.split()[1]] for x in schema.split(", ")]

    def run(batches):
        bpe = None
        for b in batches:
            bpe = bpe or coder(vocabulary, content.value)
            rows = [row(ids, bpe) for ids in bpe.encode_column(b.column("text"))]
            columns = list(zip(*rows)) if rows else [[] for _ in names[1:]]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types[1:]))], names)

    return text_frame(docs, doc_id, text).mapInArrow(run, schema)
