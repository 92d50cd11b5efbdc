"""Benchmark decontamination by size-partitioned MinHash containment search.

Items (test questions, answers) are short, documents are long, so the
measure is containment: the share of an item's five-word shingles found in
the document.  Items are partitioned by the power of two above their
shingle count.  Every item keeps a bottom-k MinHash sketch whose length
follows from its partition's upper bound ``u``: ``k = floor(u * (1 - t)) + 1``.
A document holding at least the share ``t`` of an item misses at most
``floor(n * (1 - t))`` of its shingles, so it holds one of any ``k``: the
search has no false negatives, whatever the document's length.  Hits are
confirmed on the full shingle sets.

The index lives in a broadcast of bounded size: items are dealt into blocks
of at most about ``block_bytes`` of text, and the documents are scanned once
a block (a given query set against all rows, in blocks).  No document text
is shuffled.

Defined results: null or empty documents and items match nothing; an item of
one to four words is one shingle, found only in a text that is this word
sequence; repeated document rows give repeated result rows, item rows with
equal ids are separate items of that id; null ids are carried as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm import textblocks as tb
from zonecast.llm.common import small_batches, text_frame

THRESHOLD = 75          # percent of an item's shingles
BLOCK_BYTES = 16 << 20  # item text of one broadcast index
FILTER_BITS = 20

MATCH_SCHEMA = "doc_id long, item_id long, n_item long, n_shared long, containment double"


class ContainmentIndex:
    """Sketches and full shingle sets of one block of items."""

    def __init__(self, ids: list, texts: list, threshold: int = THRESHOLD):
        self.threshold = threshold
        sets = list(tb.text_sets(pa.array(texts, pa.string())))
        self.ids = [i for i, s in zip(ids, sets) if len(s)]
        self.sets = [s for s in sets if len(s)]
        keys, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for n, s in enumerate(self.sets):
            upper = 1 << (len(s) - 1).bit_length()  # the partition's bound
            k = min(len(s), upper * (100 - threshold) // 100 + 1)
            order = np.argsort(tb.mix(s ^ np.uint64(0x5851F42D4C957F2D)), kind="stable")[:k]
            keys.append(s[order])
            owners.append(np.full(k, n))
        keys, owners = np.concatenate(keys), np.concatenate(owners)
        order = np.argsort(keys, kind="stable")
        self.keys, self.owners = keys[order], owners[order]
        self.filter = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.filter[(self.keys >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True

    def search(self, column) -> Iterator[tuple[int, int, int]]:
        """(row, item number, shared shingles) of every confirmed match."""
        if not self.sets:
            return
        for first, _, data, off in tb.blocks(column):
            h, _, _, woff = tb.words(data, off)
            s, soff = tb.shingles(h, woff)
            hit = np.flatnonzero(self.filter[(s >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
            lo = np.searchsorted(self.keys, s[hit], "left")
            n = np.searchsorted(self.keys, s[hit], "right") - lo
            hit, lo, n = hit[n > 0], lo[n > 0], n[n > 0]
            if not len(hit):
                continue
            doc = np.repeat(np.searchsorted(soff, hit, "right") - 1, n)
            within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            pairs = np.unique(np.stack([doc, self.owners[np.repeat(lo, n) + within]]), axis=1)
            last, own = -1, None
            for d, item in pairs.T:
                if d != last:
                    last, own = d, np.unique(s[soff[d]:soff[d + 1]])
                wanted = self.sets[item]
                at = np.minimum(np.searchsorted(own, wanted), len(own) - 1)
                shared = int((own[at] == wanted).sum())
                if 100 * shared >= self.threshold * len(wanted):
                    yield first + int(d), int(item), shared


def item_blocks(items: DataFrame, item_id: str, item_text: str, block_bytes: int) -> Iterator[list]:
    """The items in blocks of about ``block_bytes`` of text each."""
    src = text_frame(items, item_id, item_text, "item_id").filter(F.length("text") > 0)
    total = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // block_bytes)
    for b in range(n):
        yield src.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b).orderBy("item_id", "text").collect()


def _index(spark, rows, threshold):
    return spark.sparkContext.broadcast(
        ContainmentIndex([r["item_id"] for r in rows], [r["text"] for r in rows], threshold))


def matches(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text",
            item_id: str = "item_id", item_text: str = "text", threshold: int = THRESHOLD,
            block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every (document, item) with at least ``threshold`` percent of the
    item's shingles in the document."""
    spark = docs.sparkSession
    small_batches(spark)
    src = text_frame(docs, doc_id, doc_text)
    out = None
    for rows in item_blocks(items, item_id, item_text, block_bytes):
        index = _index(spark, rows, threshold)

        def find(batches, index=index):
            for batch in batches:
                found = list(index.value.search(batch.column("text")))
                if found:
                    row, item, shared = zip(*found)
                    size = [len(index.value.sets[i]) for i in item]
                    yield pa.RecordBatch.from_arrays([
                        batch.column("doc_id").take(pa.array(row)),
                        pa.array([index.value.ids[i] for i in item], pa.int64()),
                        pa.array(size, pa.int64()), pa.array(shared, pa.int64()),
                        pa.array([a / b for a, b in zip(shared, size)], pa.float64()),
                    ], ["doc_id", "item_id", "n_item", "n_shared", "containment"])

        part = src.mapInArrow(find, MATCH_SCHEMA)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], MATCH_SCHEMA)


def clean_documents(docs: DataFrame, items: DataFrame, doc_text: str = "text", item_id: str = "item_id",
                    item_text: str = "text", threshold: int = THRESHOLD,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no item."""
    spark = docs.sparkSession
    small_batches(spark)
    for rows in item_blocks(items, item_id, item_text, block_bytes):
        index = _index(spark, rows, threshold)

        def keep(batches, index=index):
            for batch in batches:
                clean = np.ones(batch.num_rows, dtype=bool)
                clean[[r for r, _, _ in index.value.search(batch.column(doc_text))]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
