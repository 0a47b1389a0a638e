"""Streaming forms of the operators that are not the same DataFrame calls as on bounded tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidetable.functions import timewin
from tidetable.operators import topk
from tidetable.streaming import sinks, stateful


def window_pv_uv(df: DataFrame, ts: str, keys: Sequence[str], visitor: str, size: str) -> DataFrame:
    """Exact page views and unique visitors of closed windows: count per visitor, then count the visitors.

    Two chained aggregations keep one small state row per (window, key, visitor) instead of a set per window, so a
    huge window spreads over the state partitions.
    """
    per_visitor = timewin.assign(df, ts, size).groupBy("w", *keys, visitor).agg(F.count("*").alias("__views"))
    seen = F.count(F.when(F.col(visitor).isNotNull(), 1)).alias("uv")
    counted = per_visitor.groupBy("w", *keys).agg(F.sum("__views").alias("pv"), seen)
    return counted.select(*keys, *timewin.bounds(size), "pv", "uv")


def early_views(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Page views so far per key, for update mode: every micro-batch emits the keys it changed."""
    return df.groupBy(*keys).agg(F.count("*").alias("pv"))


def early_visitors(
    df: DataFrame, keys: Sequence[str], visitor: str, salts: int = 1, salt_by: str | None = None
) -> DataFrame:
    """Exact unique visitors so far per key, for update mode: first sightings are counted as they come.

    For a visitor that may hold a large share of the rows, ``salts`` first removes its repeats within that many shares,
    dealt by the column ``salt_by``; the second removal then sees at most one row per share.
    """
    known = df.where(F.col(visitor).isNotNull())
    if salts > 1:
        dealt = known.withColumn("__salt", F.pmod(F.xxhash64(salt_by), F.lit(salts)))
        known = dealt.dropDuplicates([*keys, visitor, "__salt"])
    return known.dropDuplicates([*keys, visitor]).groupBy(*keys).agg(F.count("*").alias("uv"))


def top_k_sink(path: str, window: Sequence[str], count: str, item: str, k: int = 5):
    """Rank the windows that close in a micro-batch; all rows of a window close together."""
    return sinks.batch_folders(path, lambda closed: topk.top_k(closed, window, count, item, k))


def carried_total(sums: DataFrame, key: str, value: str, key_type: str = "string", ttl_ms: int | None = None) -> DataFrame:
    """Totals carried across the closed windows of a stream (``key, w_start, w_end, value``)."""
    windows = sums.select(F.col(key).alias("key"), "w_start", "w_end", F.col(value).alias("value"))
    return stateful.carried_total(windows, "key", key_type, ttl_ms).withColumnRenamed("key", key)


def emit_on_change(
    averages: DataFrame, key: str, value: str, key_type: str = "string", ttl_ms: int | None = None
) -> DataFrame:
    """Closed windows of a stream whose value differs from the last one of the key."""
    windows = averages.select(F.col(key).alias("key"), "w_start", "w_end", F.col(value).cast("double").alias("value"))
    changed = stateful.emit_on_change(windows, "key", key_type, ttl_ms)
    return changed.withColumnsRenamed({"key": key, "value": value})
