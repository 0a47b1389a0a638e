"""The k largest rows per window, as rows or as a text report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidetable.functions.text import ranked_report


def top_k(df: DataFrame, window: Sequence[str], count: str, item: str, k: int = 5) -> DataFrame:
    """Rank items within each window by descending count, ties by item.

    The filter on the rank lets every task cut its own rows to k per window before the shuffle.
    """
    order = Window.partitionBy(*window).orderBy(F.col(count).desc(), F.col(item))
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def report(ranked: DataFrame, window: Sequence[str], count: str, item: str) -> DataFrame:
    """One text block per window from the (at most k) ranked rows of `top_k`."""
    row = F.struct(F.col("rank"), F.col(item).alias("item"), F.col(count).alias("n"))
    gathered = ranked.groupBy(*window).agg(F.sort_array(F.collect_list(row)).alias("ranked"))
    return gathered.select(*window, ranked_report(F.col("ranked")).alias("report"))
