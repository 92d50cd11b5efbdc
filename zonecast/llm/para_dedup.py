"""Repeated passages across documents by paragraph MinHash banding.

Units are the whole paragraphs of a text, and anchored runs for passages that
stand in running text.  Whole paragraphs are lines of ``PARAGRAPH`` words or
more, and wrapped ones (several lines between blank lines).  An anchored run
has ``PARAGRAPH`` words and begins at an anchor: the five-word shingle of
least hash in some window of ``WINDOW`` shingles that a run can begin at (in
a text with fewer, among all of them).  Anchors depend only on the words
around them, so a passage of at least ``PASSAGE`` = 50 words that stands in
two documents, wherever and between whatever other words, has at least one
whole run in common, and so have equal texts and lines of 24 words or more.
Shorter passages inside a line may be missed.  Below, a paragraph is a unit
of either sort.

Equal paragraphs meet by their fingerprint.  Of the rest, minhash bands
(tuned by ``tune_bands`` for recall at the threshold; lines and runs have
bands of their own) collide.  Pairs in a band are dropped only if bitmaps of
their shingles show that they can't reach the threshold; the others are
confirmed by exact Jaccard similarity of their shingle sets, and connected
components of confirmed pairs are clusters.  At first a paragraph is paired
with one other of a band and looks at the ``NEAR`` next; bands where that
left pairs are then searched to the end for pairs of different components,
block by block across tasks and confirmed there (``cross_blocks``), so none
is left out and none is sent.
A cluster that spans
several documents is a repeated passage: its first occurrence (smallest
doc_id, then position) stays, with what overlaps it there (a line and the run
in it can be one cluster); the others are removed.  So is a first occurrence
more than half of which other removed paragraphs cut out anyway (a run that
begins two words before a passage, say).

Bands are made ``BANDS_AT_ONCE`` at a time (less disk) and summed up in every
task (a paragraph in many copies is sent once a batch), occurrences are counted with a map-side minimum, and texts are read
again only for colliding paragraphs that aren't equal.

Defined results: texts of fewer than PARAGRAPH words, empty and null texts,
and rows without an id have no paragraphs and no result row; one word
repeated is no paragraph; repeated rows (equal id and text) count as
one document, so they aren't repeats of each other.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.llm import textblocks as tb
from zonecast.llm.common import small_batches, text_frame, written
from zonecast.llm.cross_blocks import link_groups, similar_rows
from zonecast.llm.graph import components

PARAGRAPH = 24                      # words
PASSAGE = 50                        # words of the shortest passage found for sure
WINDOW = PASSAGE - PARAGRAPH        # shingles that a run can begin at
SIZE = PARAGRAPH - tb.SHINGLE_WORDS + 1
THRESHOLD = 75                      # percent
RECALL = 0.99
BROADCAST_KEYS = 1_000_000          # fingerprints sent to all executors at most
FLUSH = 1 << 18                     # paragraphs of one deduplicated batch of bands
BANDS_AT_ONCE = 3
PACK_AT_ONCE = 1 << 16              # paragraphs whose shingles are sorted together
NEAR = 64                           # places in a band looked at at first
BITS, MANY = 56, 255                # a sketch: bitmap of shingles, their number (MANY or more: unknown)


def tune_bands(threshold: float = THRESHOLD / 100, recall: float = RECALL, rows: int = 2) -> int:
    """Fewest bands of ``rows`` values that collide with probability
    ``recall`` at the threshold."""
    n = 1
    while 1 - (1 - threshold ** rows) ** n < recall:
        n += 1
    return n


ROWS = 2
BANDS = tune_bands(rows=ROWS)
_A = np.random.default_rng(11).integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_Q = 0xC2B2AE3D27D4EB4F
UNITS = "doc_id long, start int, end int, print long"
BAND_ROWS = "band long, print long, sketch long"


def anchors(s: np.ndarray, soff: np.ndarray) -> np.ndarray:
    """The shingles at which runs begin."""
    n = np.maximum(np.diff(soff) - SIZE + 1, 0)  # places of a text where a run has room
    begin = np.concatenate([[0], np.cumsum(n)])
    at = np.repeat(soff[:-1] - begin[:-1], n) + np.arange(begin[-1])
    v, stop = s[at], np.repeat(begin[1:], n)
    chosen = np.zeros(len(v), dtype=bool)
    if len(v) >= WINDOW:
        least = np.lib.stride_tricks.sliding_window_view(v, WINDOW).argmin(axis=1) + np.arange(len(v) - WINDOW + 1)
        chosen[least[np.arange(len(least)) + WINDOW <= stop[:len(least)]]] = True
    for d in np.flatnonzero((n > 0) & (n < WINDOW)):  # shorter than a window
        chosen[begin[d] + v[begin[d]:begin[d + 1]].argmin()] = True
    return at[chosen]


def whole(data: np.ndarray, start: np.ndarray, end: np.ndarray, woff: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first word, words) of the lines, and of the paragraphs of several
    lines between blank lines where a text has such."""
    lines = np.concatenate([[0], np.cumsum(data == 10)])
    gap = lines[start[1:]] - lines[end[:-1]] if len(start) else np.zeros(0, np.int64)
    edge = np.zeros(len(start) + 1, dtype=bool)
    edge[woff] = True
    out = []
    for breaks in (1, 2):
        cut = edge.copy()
        cut[1:-1] |= gap >= breaks
        at = np.flatnonzero(cut)
        if breaks == 2:
            text = np.searchsorted(woff, at[:-1], "right")
            parted = np.bincount(text, minlength=len(woff) + 1)[text] > 1
            inner = np.concatenate([[0], np.cumsum(np.append(gap == 1, False))]) if len(start) else np.zeros(1, np.int64)
            wrapped = inner[np.maximum(at[1:] - 1, 0)] > inner[at[:-1]]
            ok = parted & wrapped
        else:
            ok = np.ones(len(at) - 1, dtype=bool)
        ok &= np.diff(at) >= PARAGRAPH
        out.append(np.stack([at[:-1], np.diff(at)])[:, ok])
    return tuple(np.concatenate(out, axis=1))


def paragraphs(data: np.ndarray, off: np.ndarray):
    """(text number, first byte, end byte, shingles, offsets of a paragraph's
    shingles, is it whole) of a block's paragraphs."""
    h, start, end, woff = tb.words(data, off)
    s, soff = tb.shingles(h, woff)
    a = anchors(s, soff)
    text = np.searchsorted(soff, a, "right") - 1
    first, count = whole(data, start, end, woff)
    first = np.concatenate([a - soff[text] + woff[text], first])  # number of the first word
    count = np.concatenate([np.full(len(a), PARAGRAPH), count])
    entire = np.arange(len(count)) >= len(a)
    text = np.searchsorted(woff, first, "right") - 1
    n = count - tb.SHINGLE_WORDS + 1
    at = np.concatenate([[0], np.cumsum(n)])
    inside = s[np.repeat(first - woff[text] + soff[text] - at[:-1], n) + np.arange(at[-1])]
    if len(n):
        real = np.minimum.reduceat(inside, at[:-1]) != np.maximum.reduceat(inside, at[:-1])
        if not real.all():
            inside = inside[np.repeat(real, n)]
            text, first, count, n, entire = text[real], first[real], count[real], n[real], entire[real]
            at = np.concatenate([[0], np.cumsum(n)])
    begin = off[text]
    return text, start[first] - begin, end[first + count - 1] - begin, inside, at, entire


def fingerprint(inside: np.ndarray, at: np.ndarray) -> np.ndarray:
    if len(at) < 2:
        return np.zeros(0, np.int64)
    n = np.diff(at)
    power = np.cumprod(np.full(n.max(), _Q, dtype=np.uint64))
    place = np.arange(at[-1]) - np.repeat(at[:-1], n)
    return tb.mix(np.add.reduceat(inside * power[place], at[:-1])).view(np.int64)


def bands(inside: np.ndarray, at: np.ndarray, entire: np.ndarray, numbers: range = range(BANDS)) -> np.ndarray:
    least = np.stack([np.minimum.reduceat(inside * a, at[:-1]) for k in numbers for a in _A[k * ROWS:(k + 1) * ROWS]],
                     axis=1).reshape(len(at) - 1, len(numbers), ROWS)
    key = least[:, :, 0] * np.uint64(0x9E3779B97F4A7C15)
    for r in range(1, ROWS):
        key = (key ^ least[:, :, r]) * np.uint64(0xBF58476D1CE4E5B9)
    key += np.array(numbers, dtype=np.uint64) + np.uint64(1)
    return tb.mix(key + entire[:, None] * np.uint64(BANDS)).view(np.int64)


def sketch(inside: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A bitmap of each paragraph's shingles, and how many there are."""
    bits = np.bitwise_or.reduceat(np.uint64(1) << (inside >> np.uint64(16)) % np.uint64(BITS), at[:-1])
    return (bits << np.uint64(8) | np.minimum(np.diff(at), MANY).astype(np.uint64)).view(np.int64)


class Sketches:
    """Bitmaps of shingles and their numbers, of paragraphs."""

    def __init__(self, raw: list[bytes] | np.ndarray):
        marks = raw if isinstance(raw, np.ndarray) else np.frombuffer(b"".join(raw), np.uint64)
        self.bits, self.size = marks >> np.uint64(8), (marks & np.uint64(MANY)).astype(np.int64)

    def scores(self, i, others) -> np.ndarray:
        """More the more the bitmaps agree; 0 where the paragraphs can't
        reach the threshold.  Each differing bit is a shingle in one set
        only, and sets of Jaccard similarity t differ by at most
        (1 - t) / (1 + t) of their sizes' sum."""
        differ = np.bitwise_count(self.bits[i] ^ self.bits[others]).astype(np.int64)
        n, m = self.size[i], self.size[others]
        fits = ((100 + THRESHOLD) * differ <= (100 - THRESHOLD) * (n + m)) | (n == MANY) | (m == MANY)
        return np.where(fits, BITS + 1 - differ, 0)


def find(batches):
    """Every paragraph's document, byte span and fingerprint."""
    for batch in batches:
        ids = batch.column("doc_id")
        for i, _, data, off in tb.blocks(batch.column("text")):
            text, a, b, inside, at, _ = paragraphs(data, off)
            if len(text):
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(i + text)), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)),
                     pa.array(fingerprint(inside, at))], ["doc_id", "start", "end", "print"])


def band_rows(batches, numbers: range = range(BANDS)):
    """(band, fingerprint, sketch) of the distinct ones of many paragraphs at
    a time: equal paragraphs of one sort have equal bands."""
    held, rows = [], 0

    def distinct():
        print_, entire, sk, keys = (np.concatenate(x) for x in zip(*held))
        _, first = np.unique(print_ ^ entire, return_index=True)
        for i in range(0, len(first), 1 << 16):
            x = first[i:i + (1 << 16)]
            mark, sketches = pa.array(print_[x]), pa.array(sk[x])
            for c in range(len(numbers)):
                yield pa.RecordBatch.from_arrays([pa.array(keys[x, c]), mark, sketches], ["band", "print", "sketch"])

    for batch in batches:
        for _, _, data, off in tb.blocks(batch.column("text")):
            inside, at, entire = paragraphs(data, off)[3:]
            if len(inside):
                held.append((fingerprint(inside, at), entire.astype(np.int64), sketch(inside, at),
                             bands(inside, at, entire, numbers)))
                rows += len(at) - 1
                if rows >= FLUSH:
                    yield from distinct()
                    held, rows = [], 0
    if rows:
        yield from distinct()


def _pair_batches(a: np.ndarray, b: np.ndarray):
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
    for i in range(0, len(pairs), 1 << 16):
        yield pairs[i:i + (1 << 16)]


COLLIDED = "a long, b long, group binary, sketch binary"


def collide(batches):
    """First pairs (a, b) of different fingerprints in one band; and of each
    band that may have further pairs all members (a, null, band, sketch)."""
    got = [[b.column(c).to_numpy() for c in ("band", "print", "sketch")] for b in batches if b.num_rows]
    if not got:
        return
    band, mark, sk = (np.concatenate(x) for x in zip(*got))
    order = np.lexsort((mark, band))
    band, mark, sk = band[order], mark[order], sk[order]
    new = np.ones(len(band), dtype=bool)
    new[1:] = (band[1:] != band[:-1]) | (mark[1:] != mark[:-1])
    band, mark, sk = band[new], mark[new], sk[new]
    sketches = Sketches(sk.view(np.uint64))
    sent, more = np.zeros(len(band), dtype=bool), np.zeros(len(band), dtype=bool)
    live, a, b = np.arange(len(band)), [mark[:0]], [mark[:0]]
    for k in range(1, NEAR + 2):
        live = live[live + k < len(band)]
        live = live[band[live + k] == band[live]]
        if not len(live):
            break
        if k > NEAR:
            more[live] = True
            break
        i = live[sketches.scores(live, live + k) > 0]
        more[i[sent[i]]] = True
        i = i[~sent[i]]
        sent[i] = True
        a.append(mark[i])
        b.append(mark[i + k])
    for x in _pair_batches(np.concatenate(a), np.concatenate(b)):
        none = pa.nulls(len(x), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(x[:, 0].copy()), pa.array(x[:, 1].copy()), none, none],
                                         ["a", "b", "group", "sketch"])
    first = np.flatnonzero(np.concatenate([[True], band[1:] != band[:-1]]))
    rest = np.flatnonzero(np.repeat(np.logical_or.reduceat(more, first), np.diff(np.append(first, len(band)))))
    eight = lambda x: pa.Array.from_buffers(pa.binary(8), len(x), [None, pa.py_buffer(x)]).cast(pa.binary())
    for i in range(0, len(rest), 1 << 16):
        r = rest[i:i + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(mark[r]), pa.nulls(len(r), pa.int64()), eight(band[r]), eight(sk[r])],
                                         ["a", "b", "group", "sketch"])


PACKED = 5  # bytes


def pack_all(inside: np.ndarray, at: np.ndarray) -> pa.Array:
    """The distinct shingles of each paragraph, sorted, the first 40 bits of
    each hash: enough to tell the few shingles of two paragraphs apart."""
    out, n = [], np.diff(at)
    for k in range(0, len(n), PACK_AT_ONCE):  # 24 bits of a key number the paragraph
        m = n[k:k + PACK_AT_ONCE]
        v = inside[at[k]:at[k] + m.sum()] >> np.uint64(24)
        v = np.sort(np.repeat(np.arange(len(m), dtype=np.uint64) << np.uint64(40), m) | v)
        v = v[np.append(True, v[1:] != v[:-1])[:len(v)]]
        end = np.append(0, np.cumsum(np.bincount((v >> np.uint64(40)).astype(np.int64), minlength=len(m)) * PACKED))
        raw = v.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - PACKED:].tobytes()
        out.append(pa.Array.from_buffers(pa.binary(), len(m), [None, pa.py_buffer(end.astype(np.int32)), pa.py_buffer(raw)]))
    return pa.concat_arrays(out) if out else pa.array([], pa.binary())


def pack(inside: np.ndarray) -> bytes:
    return pack_all(inside, np.array([0, len(inside)]))[0].as_py()


def contents(batches):
    """(fingerprint, shingles) of the wanted paragraphs of each text."""
    for batch in batches:
        wanted = batch.column("wanted")
        for i, j, data, off in tb.blocks(batch.column("text")):
            text, _, _, inside, at, _ = paragraphs(data, off)
            marks = fingerprint(inside, at)
            lists = wanted.slice(i, j - i)
            asked, number = np.unique(lists.flatten().to_numpy(zero_copy_only=False), return_inverse=True)
            if not len(marks) or not len(asked):
                continue
            row = np.repeat(np.arange(j - i), lists.value_lengths().to_numpy(zero_copy_only=False))
            place = np.minimum(np.searchsorted(asked, marks), len(asked) - 1)
            k = np.flatnonzero(asked[place] == marks)
            cell = place[k] * (j - i) + text[k]  # a fingerprint and a text
            cell, first = np.unique(cell, return_index=True)
            k = np.sort(k[first[np.isin(cell, number * (j - i) + row)]])
            for k in np.split(k, range(PACK_AT_ONCE, len(k), PACK_AT_ONCE)):
                n = np.diff(at)[k]
                ends = np.append(0, np.cumsum(n))
                own = inside[np.repeat(at[k] - ends[:-1], n) + np.arange(ends[-1])]
                yield pa.RecordBatch.from_arrays([pa.array(marks[k]), pack_all(own, ends)], ["print", "shingles"])


def confirm(batches):
    for batch in batches:
        ok = np.flatnonzero(similar_rows(batch.column("xs"), batch.column("ys"), PACKED, THRESHOLD))
        if len(ok):
            yield batch.select(["a", "b"]).take(pa.array(ok))


def _near(src: DataFrame, units: DataFrame) -> DataFrame:
    """(print, cluster) of fingerprints linked to different ones."""
    def some(numbers):
        rows = src.mapInArrow(lambda batches: band_rows(batches, numbers), BAND_ROWS)
        return written(rows.repartition("band").mapInArrow(collide, COLLIDED), "collided")

    collided = [some(range(k, min(k + BANDS_AT_ONCE, BANDS))) for k in range(0, BANDS, BANDS_AT_ONCE)]
    collided = reduce(DataFrame.unionByName, collided)
    pairs = written(collided.filter("b IS NOT NULL").select("a", "b").distinct(), "pairs")
    large = collided.filter("b IS NULL").select("group", F.col("a").alias("id"), "sketch")
    marks = pairs.select(F.explode(F.array("a", "b")).alias("print")).union(large.select("id"))
    marks = written(marks.distinct(), "marks")
    marks = F.broadcast(marks) if marks.count() <= BROADCAST_KEYS else marks
    where = (units.join(marks, "print").groupBy("print").agg(F.min("doc_id").alias("doc_id"))
             .groupBy("doc_id").agg(F.collect_list("print").alias("wanted")))
    where = written(where, "where")
    where = F.broadcast(where) if where.count() <= BROADCAST_KEYS // 8 else where
    content = written(src.join(where, "doc_id").mapInArrow(contents, "print long, shingles binary")
                      .dropDuplicates(["print"]), "contents")

    links = written(pairs.join(content.toDF("a", "xs"), "a").join(content.toDF("b", "ys"), "b")
                    .mapInArrow(confirm, "a long, b long"), "links")
    label = components(links).select(F.col("node").alias("id"), "component")
    members = written(large.join(label, "id", "left").withColumn("label", F.coalesce("component", "id"))
                      .drop("component"), "members")
    links = links.union(link_groups(members, content.toDF("id", "content"), Sketches, PACKED, THRESHOLD))
    found = components(links).select(F.col("node").alias("print"), F.col("component").alias("cluster"))
    return found.union(found.select("cluster", "cluster").distinct())  # and the components' own roots


def repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, start, end (bytes), cluster, first_doc_id, removed of every
    paragraph whose cluster spans several documents."""
    small_batches(docs.sparkSession)
    src = text_frame(docs, doc_id, text).filter(F.col("doc_id").isNotNull() & (F.octet_length("text") >= 2 * PARAGRAPH - 1))
    units = written(src.mapInArrow(find, UNITS), "paragraphs")
    near = _near(src, units)
    counted = (units.groupBy("print").agg(F.min(F.struct("doc_id", "start", "end")).alias("first"), F.max("doc_id").alias("last"))
               .join(near, "print", "left").filter("cluster IS NOT NULL OR first.doc_id <> last")
               .withColumn("cluster", F.coalesce("cluster", "print")))
    counted = written(counted, "counted")
    spread = (counted.groupBy("cluster").agg(F.min("first").alias("first"), F.max("last").alias("last"))
              .filter("first.doc_id <> last").drop("last"))
    marks = written(counted.select("print", "cluster").join(spread, "cluster"), "repeated")
    removed = ~((F.col("doc_id") == F.col("first.doc_id")) & (F.col("start") < F.col("first.end"))
                & (F.col("end") > F.col("first.start")))
    # dealt by document before rows are made distinct: a join by a frequent paragraph stays one that Spark can split
    found = units.join(marks, "print").repartition("doc_id").distinct().select(
        "doc_id", "start", "end", "cluster", F.col("first.doc_id").alias("first_doc_id"), removed.alias("removed"))
    place = Window.partitionBy("doc_id").orderBy("start")
    upto = F.max(F.when(F.col("removed"), F.col("end"))).over(place.rangeBetween(Window.unboundedPreceding, 0))
    since = F.min(F.when(F.col("removed"), F.col("start"))).over(place.rangeBetween(0, Window.unboundedFollowing))
    low = F.greatest(F.col("start"), F.least(F.col("end"), F.coalesce(upto, F.col("start"))))
    high = F.greatest(low, F.least(F.col("end"), F.coalesce(since, F.col("end"))))
    gone = 2 * (high - low) < F.col("end") - F.col("start")
    return found.withColumn("removed", F.col("removed") | gone)


def by_document(found: DataFrame) -> DataFrame:
    """One row a document with repeated paragraphs: how many, the documents
    where they stand first, and the merged byte spans to remove."""
    spans = F.array_sort(F.collect_list(F.when(F.col("removed"), F.struct("start", "end"))))
    merged = F.aggregate(
        F.col("spans"), F.expr("cast(array() as array<struct<start:int,end:int>>)"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= x["start"]),
            F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(
                F.element_at(acc, -1)["start"].alias("start"),
                F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end")))))
        .otherwise(F.concat(acc, F.array(x))))
    return (found.groupBy("doc_id").agg(
        F.count("*").alias("n_repeated"), F.sum(F.col("removed").cast("long")).alias("n_removed"),
        F.array_sort(F.collect_set("first_doc_id")).alias("first_doc_ids"), spans.alias("spans"))
        .withColumn("spans", merged)
        .withColumn("removed_bytes", F.expr("aggregate(spans, 0L, (acc, x) -> acc + x.end - x.start)")))


def remove(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with the removed spans cut out."""
    cuts = by_document(repeats(docs, doc_id, text)).filter("n_removed > 0").select(F.col("doc_id").alias("id"), "spans")
    packed = docs.select(F.struct("*").alias("doc"), F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))

    def cut(batches):
        for b in batches:
            new = []
            for t, spans in zip(b.column("text").to_pylist(), b.column("spans").to_pylist()):
                if t and spans:
                    raw, last, kept = t.encode(), 0, []
                    for s in spans:
                        kept.append(raw[last:s["start"]])
                        last = s["end"]
                    t = b"".join((*kept, raw[last:])).decode()
                new.append(t)
            yield pa.RecordBatch.from_arrays([b.column("doc"), pa.array(new, pa.string())], ["doc", "text"])

    rows = packed.join(cuts, "id", "left").select("doc", "text", "spans")
    schema = T.StructType([rows.schema["doc"], T.StructField("text", T.StringType())])
    return rows.mapInArrow(cut, schema).select(
        *(F.col("text").alias(c) if c == text else F.col("doc")[c].alias(c) for c in docs.columns))
