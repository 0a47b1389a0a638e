"""Database tables over JDBC (the driver jar comes from the cluster)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def query_scan(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """Result of one query, read through one connection: for dimensions known to be small."""
    return spark.read.format("jdbc").options(url=url, query=query, **options).load()


def partitioned_scan(
    spark: SparkSession, url: str, table: str, column: str, low: int, high: int, partitions: int, **options: str
) -> DataFrame:
    """A table read through ``partitions`` connections, split by ranges of a numeric column."""
    split = {
        "partitionColumn": column,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(partitions),
    }
    return spark.read.format("jdbc").options(url=url, dbtable=table, **split, **options).load()
