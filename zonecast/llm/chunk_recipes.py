"""Exact duplicates through content-defined chunk recipes, in Spark SQL only.

Two texts are equal if they are identical once the white space
``[\\x20\\x09-\\x0D]`` is deleted.  The normalised text is cut into chunks
where its content says so: after the first punctuation mark or symbol past
``MIN_CHARS`` code points, at ``MAX_CHARS`` at the latest.  A text's
recipe is the ordered list of its chunks' identifiers, and texts are equal
exactly if their recipes are.

An identifier is ``parts`` seeded 64-bit hashes of the chunk.  It is verified,
not trusted: all chunks are deduplicated by content (summed up in each task
first, so a chunk that a third of all documents share leaves a task once),
and if any identifier stands for two contents, all identifiers get one more
hash and are verified again.  Chunk contents are shuffled once, documents
never; after that only recipes move (16 bytes a chunk).

A group's row that stays is found by a grouped maximum.  Its members learn of
it by a join; groups that hold more than one row in ``HOT`` are fewer than
``HOT`` and are broadcast, so that no task gets a large group's rows.

Defined results: a null text counts as empty, and all texts without other
characters are equal.  Of equal texts the one row stays that has the most
code points in its original text, then the smallest id (a null id last); of
rows repeated as a whole exactly one stays.  An empty table gives no rows;
other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import text_frame, written

MIN_CHARS, MAX_CHARS = 512, 4096
PARTS = 2       # 64-bit hashes in a chunk's identifier, to begin with
HOT = 10_000    # a group with more than one row in HOT is broadcast
WHITE_SPACE = " \t\n\x0b\x0c\r"
_CHUNK = f"(?s).{{{MIN_CHARS},{MAX_CHARS - 1}}}?[\\p{{P}}\\p{{S}}]|.{{1,{MAX_CHARS}}}"


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), WHITE_SPACE, "")


def chunks(norm: Column) -> Column:
    """The chunks of a normalised text, in order; they join to the text."""
    return F.regexp_extract_all(norm, F.lit(_CHUNK), F.lit(0))


def hashes(chunk: Column, parts: int) -> Column:
    """``parts`` hashes of a chunk, each with a seed of its own."""
    return F.array(*(F.xxhash64(F.lit(k), chunk) for k in range(parts)))


def chunk_store(docs: DataFrame, text: str = "text", parts: int = PARTS, identify=hashes) -> DataFrame:
    """id, chunk, n_uses of every distinct chunk of ``docs``."""
    pieces = docs.select(F.explode(chunks(normalised(F.col(text)))).alias("chunk"))
    return (pieces.groupBy("chunk").agg(F.count("*").alias("n_uses"))
            .select(identify(F.col("chunk"), parts).alias("id"), "chunk", "n_uses"))


def verified_parts(docs: DataFrame, text: str = "text", parts: int = PARTS, identify=hashes) -> int:
    """The least number of hashes, from ``parts`` on, with which no two
    different chunks of ``docs`` have one identifier."""
    while True:
        store = chunk_store(docs, text, parts, identify)
        if store.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
            return parts
        parts += 1


def recipes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", parts: int = PARTS, identify=hashes) -> DataFrame:
    """doc_id, n_chars, text_sha256 and recipe (identifiers in order, one
    flat list) of every row."""
    norm = text_frame(docs, doc_id, text).withColumn("norm", normalised(F.col("text")))
    return norm.select(
        "doc_id", F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"),
        F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
        F.flatten(F.transform(chunks(F.col("norm")), lambda c: identify(c, parts))).alias("recipe"))


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", parts: int = PARTS,
                     identify=hashes) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row."""
    src = text_frame(docs, doc_id, text)
    parts = verified_parts(src, "text", parts, identify)
    rows = written(recipes(src, "doc_id", "text", parts, identify)
                   .withColumn("row", F.monotonically_increasing_id()), "recipes")
    best = F.struct("n_chars", F.col("doc_id").isNotNull().alias("named"), F.bitwise_not("doc_id").alias("low"),
                    F.bitwise_not("row").alias("first"), F.col("doc_id").alias("id"))
    groups = written(
        rows.groupBy("recipe").agg(F.count("*").alias("group_size"), F.max(best).alias("best"))
        .filter("group_size > 1")
        .select("recipe", "group_size", F.col("best.id").alias("keep_id"), F.bitwise_not("best.first").alias("keep_row")),
        "groups")
    is_hot = F.col("group_size") * HOT > rows.count()
    hot = F.broadcast(groups.filter(is_hot))
    rest = rows.join(hot.select("recipe"), "recipe", "left_anti").join(groups.filter(~is_hot), "recipe", "left")
    return rows.join(hot, "recipe").unionByName(rest).select(
        "doc_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        F.coalesce(F.col("row") == F.col("keep_row"), F.lit(True)).alias("kept"), "text_sha256")
