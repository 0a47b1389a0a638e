"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next.

Every stage works on all rows that its predecessor left, and all but the last return the columns of ``documents``. Null texts are
empty texts and stay null until they are packed, as an end of text alone; of repeated rows one stays; rows of a null id are packed like
others. An empty table gives no rows. Other columns, whatever their names, go through to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidetable.llm import exact_dedup, ngram_join, packing, quality, secret_scan
from tidetable.llm.shared import materialize

#: No SQL: the fitted model of the first stage and the token ids of the last are not expressible.
ORACLE_SQL = None


def good_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on these, accepts."""
    return quality.accepted(docs)


def one_of_each_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, that with the largest id."""
    return exact_dedup.drop_duplicates(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id."""
    return ngram_join.one_of_each_group(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark and ``n_chars`` counted anew where that changed the text."""
    before = "__before"
    while before in docs.columns:
        before += "_"
    clean = secret_scan.redacted(docs.withColumn(before, F.col("text")))
    changed = ~F.col("text").eqNullSafe(F.col(before))
    counted = F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", counted).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces of token windows."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", good_texts),
    ("exact dedup", one_of_each_text),
    ("n-gram Jaccard join", one_of_each_group),
    ("secret scan", without_secrets),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
