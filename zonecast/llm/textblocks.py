"""Vectorised word and shingle hashing over Arrow text columns.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z only.  Texts stay
UTF-8 bytes in the Arrow buffer; a word's 64-bit hash is the difference of
two prefix sums of a polynomial over random byte values, so a block of
texts is hashed by a handful of numpy passes instead of a loop over words.
Hash values depend only on the words, never on block boundaries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
SHINGLE_WORDS = 5
BLOCK_BYTES = 1 << 20  # texts are hashed in blocks of about this size

_rng = np.random.default_rng(20240131)
_BYTE = _rng.integers(1, 2**64, 256, dtype=U64)
_BYTE[65:91] = _BYTE[97:123]  # A-Z hash as a-z
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, 9, 10, 11, 12, 13]] = False
_P = 0x9E3779B97F4A7C15 | 5  # odd
_P_INV = pow(_P, -1, 2**64)
_Q = [pow(0xD6E8FEB86659FD93, j, 2**64) for j in range(64)]
_pow = np.ones(1, dtype=U64)
_inv = np.ones(1, dtype=U64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _pow, _inv
    if len(_pow) < n:
        size = max(n, 1 << 21)
        for name, base in (("_pow", _P), ("_inv", _P_INV)):
            a = np.full(size, base, dtype=U64)
            a[0] = 1
            globals()[name] = np.cumprod(a)
    return _pow, _inv


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(29)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(32)
    return x


def raw_text(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bufs = column.buffers()
    off = np.frombuffer(bufs[1], np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def blocks(column, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, end row, bytes, offsets) for runs of whole texts."""
    data, off = raw_text(column)
    n, i = len(off) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + block_bytes, "right")) - 1)
        yield i, j, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end, word offsets by text) of all words of a block."""
    n = len(data)
    if n == 0:
        return np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    is_word = _IS_WORD[data]
    cut = np.zeros(n + 1, dtype=bool)  # a text begins here
    cut[off] = True
    prev = np.empty(n, dtype=bool)
    prev[0], prev[1:] = False, is_word[:-1]
    start = np.flatnonzero(is_word & (~prev | cut[:-1]))
    nxt = np.empty(n, dtype=bool)
    nxt[-1], nxt[:-1] = False, is_word[1:]
    end = np.flatnonzero(is_word & (~nxt | cut[1:])) + 1
    p, inv = _powers(n)
    total = np.zeros(n + 1, dtype=U64)
    np.cumsum(_BYTE[data] * p[:n], out=total[1:])
    h = mix((total[end] - total[start]) * inv[start])
    return h, start, end, np.searchsorted(start, off)


def word_beginnings(data: np.ndarray, off: np.ndarray, lengths: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of every word and of its first 4, 5, ... bytes,
    for words longer than that; each length has hashes of its own."""
    h, start, end, woff = words(data, off)
    p, inv = _powers(len(data))
    total = np.zeros(len(data) + 1, dtype=U64)
    np.cumsum(_BYTE[data] * p[:len(data)], out=total[1:])
    text = np.repeat(np.arange(len(off) - 1), np.diff(woff))
    hashes, texts = [h], [text]
    for n in lengths:
        w = np.flatnonzero(end - start > n)
        s = start[w]
        hashes.append(mix((total[s + n] - total[s]) * inv[s] ^ U64(n)))
        texts.append(text[w])
    return np.concatenate(hashes), np.concatenate(texts)


def sequence_hash(h: np.ndarray) -> int:
    """Hash of a whole short word sequence (fewer words than a shingle)."""
    with np.errstate(over="ignore"):
        q = np.array(_Q[:len(h)], dtype=U64)
        return int(mix(np.array([(h * q).sum(dtype=U64) + U64(len(h) * 0x632BE5AB)], dtype=U64))[0])


def shingles(h: np.ndarray, woff: np.ndarray, k: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes, offsets by text), in text order, repeats included.

    A text of 1 to k-1 words has its whole sequence as its one shingle, a
    text without words has none.
    """
    count = np.diff(woff)
    n = len(h)
    m = n - k + 1
    if m > 0:
        s = h[:m].copy()
        for j in range(1, k):
            s += h[j:j + m] * U64(_Q[j])
        s = mix(s)
    else:
        s = np.zeros(0, U64)
    sizes = np.where(count >= k, count - k + 1, (count > 0).astype(np.int64))
    soff = np.zeros(len(woff), dtype=np.int64)
    np.cumsum(sizes, out=soff[1:])
    if (count >= k).all() and len(count) == 1:
        return s, soff
    out = np.empty(int(soff[-1]), dtype=U64)
    long = np.flatnonzero(count >= k)
    if len(long):
        idx = np.arange(int(sizes[long].sum()))
        first = np.repeat(np.cumsum(sizes[long]) - sizes[long], sizes[long])
        within = idx - first
        out[np.repeat(soff[:-1][long], sizes[long]) + within] = s[np.repeat(woff[:-1][long], sizes[long]) + within]
    for d in np.flatnonzero((count > 0) & (count < k)):
        out[soff[d]] = sequence_hash(h[woff[d]:woff[d + 1]])
    return out, soff


def text_sets(column, k: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, in row order."""
    for _, _, data, off in blocks(column):
        h, _, _, woff = words(data, off)
        s, soff = shingles(h, woff, k)
        for a, b in zip(soff[:-1], soff[1:]):
            yield np.unique(s[a:b])
