"""Unions, filters and conversions of whole rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


def union_all(*tables: DataFrame) -> DataFrame:
    """All rows of all tables, columns matched by name."""
    return reduce(DataFrame.unionByName, tables)


def renamed(df: DataFrame, names: str | Sequence[str]) -> DataFrame:
    """Columns renamed by position, from a list or a comma-separated text."""
    parts = [n.strip() for n in names.split(",")] if isinstance(names, str) else names
    return df.toDF(*parts)


def typed(df: DataFrame, schema: str | StructType) -> DataFrame:
    """Columns picked by name and cast to a declared schema."""
    declared = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in declared.fields])
