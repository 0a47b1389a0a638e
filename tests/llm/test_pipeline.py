"""The pipeline on awkward tables."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import functions as F

from tests.llm import helpers as H
from tidetable.session import shared_folder


def folder_of(spark, rows) -> str:
    """A folder with a documents table that has columns of clashing names."""
    path = shared_folder(spark)
    frame = H.docs(spark, rows).withColumns({"lang": F.lit("en"), "source": F.lit(None).cast("string"), "__before": F.lit("x")})
    frame.withColumn("n_chars", F.length("text").cast("long")).write.parquet(f"{path}/documents.parquet")
    return path


def test_awkward_documents_pass_through_all_stages(spark):
    rows = H.awkward_docs() + [(20, None), (21, "key: AKIA" + "Q" * 16 + " and words behind it"), (21, "key: AKIA" + "Q" * 16 + " and words behind it")]
    path = folder_of(spark, rows)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.materialize(stage(spark, docs, path))
        assert after.schema.names == docs.schema.names, name
        assert after.count() <= docs.count()
        docs = after
    left = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert len({t or "" for _, t in left}) == len(left)
    assert not any("AKIAQ" in (t or "") for _, t in left)
    packed = corpus_pipeline.run(spark, path).collect()
    assert sum(r["offset"] == 0 for r in packed) >= 1
    assert {r["doc_id"] for r in packed} == {d for d, _ in left}


def test_an_empty_table_gives_no_rows(spark):
    assert corpus_pipeline.run(spark, folder_of(spark, [])).count() == 0
