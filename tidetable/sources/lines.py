"""Typed rows from lines of text and from delimited message payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def stream_lines(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream of text lines (``value``) from files that appear below ``path``."""
    reader = spark.readStream
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).text(path)


def _cast_fields(df: DataFrame, parts, schema: str, lenient: bool, keep: tuple[str, ...]) -> DataFrame:
    fields = StructType.fromDDL(schema).fields
    split = df.select(*keep, parts.alias("__parts"))
    columns = []
    for i, field in enumerate(fields):
        part = F.trim(F.get("__parts", F.lit(i)) if lenient else F.col("__parts")[i])
        cast = part.try_cast(field.dataType) if lenient else part.cast(field.dataType)
        columns.append(cast.alias(field.name))
    return split.select(*keep, *columns)


def parse_fields(
    df: DataFrame, schema: str, value: str = "value", lenient: bool = False, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Whitespace-separated line to declared fields; a bad number fails the job unless ``lenient``."""
    return _cast_fields(df, F.split(F.trim(F.col(value)), r"\s+"), schema, lenient, keep)


def parse_csv_payload(
    df: DataFrame, schema: str, value: str = "value", lenient: bool = False, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Comma-separated payload (text or UTF-8 bytes) to declared fields."""
    return _cast_fields(df, F.split(F.trim(F.col(value).cast("string")), ","), schema, lenient, keep)
