"""Time the headline queries: one JSON line with the median of the timed runs per query.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local threads), BENCH_RUNS (timed runs per query, after one warm-up).
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidetable.functions.text import tokens
from tidetable.operators import joins, topk, windowed
from tidetable.plans import batch, registry
from tidetable.plans.tables import arriving_documents, clicks, events, of_type, purchases, table

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = (
    "hot_items_topk hot_items_report tumble_count tumble_bounds_rowtime arrival_tumble hop_count hop_gapped region_pv "
    "union_all_filtered union_then_filter append_projection pvuv_hourly pvuv_tumble pvuv_panes window_avg "
    "window_avg_panes avg_emit_on_change panes_emit_on_change running_total carried_window_total over_range "
    "word_count_sliding window_inner_join window_left_join window_join_panes interval_join dimension_join_sql "
    "dimension_join_where sum_retract pvuv_retract apply_changelog json_tumble"
).split()
STREAMS = (
    "stream_tumble_count stream_pvuv_tumble stream_running_total stream_interval_join stream_pvuv_retract stream_keyed_table "
    "stream_pvuv_panes stream_window_join_panes stream_tumble_versions"
).split()


def hop_raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variant of hot_items_topk: every row copied into its 24 windows."""
    views = of_type(table(spark, sf_dir, "events"), "view")
    counts = windowed.window_aggregate(
        views, "ts", ["user_id"], {"n": ("count", "*")}, "1 day", "1 hour", preaggregate=False
    )
    return topk.top_k(counts, ["w_start", "w_end"], "n", "user_id", 5)


def words_raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variant of word_count_sliding: every word copied into its five windows."""
    docs = arriving_documents(spark, sf_dir).select("arrival", F.explode(tokens("text")).alias("word"))
    return windowed.window_aggregate(
        docs, "arrival", ["word"], {"n": ("count", "*")}, "5 minutes", "1 minute", preaggregate=False
    )


def interval_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variant of interval_join: key and range, without time buckets."""
    source = events(spark, sf_dir)
    bought = purchases(source).withColumnRenamed("event_id", "purchase_id")
    return joins.interval_join(clicks(source), bought, "user_id", "click_ts", "purchase_ts", "1 hour", bucketed=False)


def pvuv_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variant of pvuv_hourly: approximate visitors."""
    return windowed.hourly_pv_uv(table(spark, sf_dir, "events"), "ts", "user_id", exact=False)


VARIANTS = {"hot_items_topk.raw": hop_raw_rows, "word_count_sliding.raw": words_raw_rows,
            "interval_join.plain": interval_plain, "pvuv_hourly.sketch": pvuv_sketch}


def timed(spark: SparkSession, query: Callable[[SparkSession, str], DataFrame], runs: int) -> float:
    """Median seconds to build and run a query into the discarding sink."""
    seconds = []
    for attempt in range(runs + 1):
        started = time.perf_counter()
        query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
        if attempt or runs == 0:
            seconds.append(time.perf_counter() - started)
    return round(statistics.median(seconds), 4)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tidetable-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidetable-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {name: timed(spark, registry.QUERIES[name], RUNS) for name in HEADLINE}
    times |= {name: timed(spark, query, 1) for name, query in VARIANTS.items()}
    times |= {name: timed(spark, registry.QUERIES[name], 1) for name in sorted(set(batch.QUERIES) - set(HEADLINE))}
    times |= {name: timed(spark, registry.QUERIES[name], 1) for name in STREAMS}
    total = round(sum(times[name] for name in HEADLINE), 4)
    print(json.dumps({
        "metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": SF_DIR.rsplit("sf", 1)[-1]
    }))


if __name__ == "__main__":
    main()
