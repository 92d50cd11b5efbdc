"""The registered queries of this subpackage.

Each applies one operator, with production parameters, to its whole table;
``ORACLES`` has DuckDB SQL where SQL can express the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from zonecast.llm import (backoff, bbpe, chunk_recipes, cover_tree, decontam, ext_hash, knn_quality, lsh_forest,
                          para_dedup, pii, token_align, toxicity_pu, turn_repair)
from zonecast.llm.common import table
from zonecast.llm.oracles import ORACLES  # noqa: F401

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
ALIGNED = ("byte_bpe_50k.json", "piece_bpe_32k.model")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.near_duplicates(table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ext_hash.shards(table(spark, sf_dir, "documents"))


def op3_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return para_dedup.by_document(para_dedup.repeats(table(spark, sf_dir, "documents")))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity_pu.score(docs, toxicity_pu.train(docs, table(spark, sf_dir, "labels")))


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.anonymise(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return knn_quality.score(docs, knn_quality.train(docs, table(spark, sf_dir, "labels")))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bbpe.digest_documents(table(spark, sf_dir, "documents"), vocabulary_path())


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff.scores(table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.alignment_report(table(spark, sf_dir, "documents"), *map(vocabulary_path, ALIGNED))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_recipes.exact_duplicates(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair(turn_repair.damaged(table(spark, sf_dir, "conversations")))


QUERIES = {f.__name__: f for f in (
    op1_minhash_dedup, op2_sharding, op3_paragraph_dedup, op4_toxicity, op5_embedding_dedup, op6_pii, op7_quality,
    op8_decontamination, op9_bpe, op10_lm_scoring, op11_token_alignment, op12_exact_dedup, op13_conversation_repair)}
