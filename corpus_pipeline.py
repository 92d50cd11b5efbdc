"""A training-corpus pipeline: five operators of ``zonecast.llm`` in a row.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again as the next stage's documents.  All stages
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from zonecast.llm import bbpe, decontam, lsh_forest, pii, toxicity_pu
from zonecast.llm.common import table, written
from zonecast.llm.queries import vocabulary_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the trained classifier doesn't reject."""
    return toxicity_pu.drop_toxic(docs, toxicity_pu.train(docs, table(spark, sf_dir, "labels")))


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return lsh_forest.keep_representatives(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def anonymisation(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts replaced by surrogates."""
    return pii.anonymise_column(docs)


def tokenisation(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and of the decoded bytes."""
    return bbpe.digest_documents(docs, vocabulary_path())


STAGES = [("toxicity", toxicity), ("minhash_dedup", minhash_dedup), ("decontamination", decontamination),
          ("anonymisation", anonymisation), ("tokenisation", tokenisation)]

ORACLE_SQL = None  # a trained classifier, a keyed permutation and BPE merges are no SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
