"""Registered queries of the subpackage, and the pipeline."""

import pytest

import __spark_entry__ as E
from brute import documents
from zonecast.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_covers_its_whole_table(spark, name):
    assert name in E.queries()
    got = QUERIES[name](spark, SF)
    if name == "op5_embedding_dedup":
        assert got.count() == spark.read.parquet(f"{SF}/embeddings.parquet").count()
    elif name == "op13_conversation_repair":
        assert got.count() == spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id").distinct().count()
    elif name not in ("op3_paragraph_dedup", "op8_decontamination"):
        assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_pipeline_stages_take_effect_and_keep_columns(spark):
    import corpus_pipeline as C

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in C.STAGES:
        docs = C.written(stage(spark, docs, SF), name)
        counts.append(docs.count())
        assert name == C.STAGES[-1][0] or docs.columns == columns
    assert counts[0] > counts[2] > counts[3] == counts[4] == counts[5] > counts[0] // 2
    assert C.run(spark, SF).count() == counts[-1]


def test_pipeline_stages_take_odd_and_no_rows(spark, odd, none):
    import corpus_pipeline as C

    for rows in (odd, none):
        docs = rows
        for name, stage in C.STAGES:
            docs = C.written(stage(spark, docs, SF), name)
        assert (docs.count() > 0) == (rows is odd)
    assert documents(spark, []).columns == odd.columns
