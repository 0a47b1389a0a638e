"""Named tables and SQL over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidetable.operators.rows import renamed


def register(df: DataFrame, name: str, columns: str | None = None) -> DataFrame:
    """Make a table or stream known to SQL, optionally renaming its columns by position."""
    table = renamed(df, columns) if columns else df
    table.createOrReplaceTempView(name)
    return table


def scan(spark: SparkSession, name: str) -> DataFrame:
    """A registered table."""
    return spark.table(name)


def sql(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    """SQL whose ``{name}`` placeholders stand for the given frames."""
    return spark.sql(text, **tables)
