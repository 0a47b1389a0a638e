"""Tables and streams from files, always with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Typed CSV scan, columns by position."""
    return spark.read.schema(schema).csv(path)


def stream_csv(
    spark: SparkSession, path: str, schema: str | StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Typed CSV scan of files that appear below ``path``."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).csv(path)


def stream_table(
    spark: SparkSession, path: str, schema: str | StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Parquet files below ``path`` as a stream, oldest first.

    With ``files_per_batch=1`` the files are an ordered script: one micro-batch each, so a stream's watermark
    advances exactly at file boundaries.
    """
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(path)
