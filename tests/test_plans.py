"""The physical plans keep to what the queries need."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_DIR
from tidetable.operators import windowed
from tidetable.plans import batch
from tidetable.plans.tables import events


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(batch.QUERIES))
def test_no_products_and_no_python_in_the_way(spark, name):
    plan = plan_of(batch.QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert ("Python" in plan or "Pandas" in plan) == (name == "user_avg")


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(batch.hot_items_topk(spark, SF_DIR))
    assert re.search(r"PushedFilters: \[.*EqualTo\(event_type,view\)", plan)
    assert re.search(r"FileScan parquet \[ts#\d+,user_id#\d+L,event_type#\d+\]", plan)


def test_top_k_is_cut_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan_of(batch.hot_items_topk(spark, SF_DIR))


def test_filter_moves_below_the_union(spark):
    plan = plan_of(batch.union_then_filter(spark, SF_DIR))
    assert plan.index("Union") < plan.index("Filter")
    assert len(re.findall(r"Filter .*o_totalprice#\d+ > 200000.0", plan)) == 2


def test_running_values_read_their_input_twice_at_most(spark):
    """Rows and block totals; the larger blocks come from the totals."""
    most = {"running_total": 2, "over_range": 3, "sum_retract": 2, "carried_window_total": 2, "window_avg_panes": 2}
    for name, scans in most.items():
        df = batch.QUERIES[name](spark, SF_DIR)
        df._jdf.queryExecution().toRdd().count()
        final = plan_of(df).split("== Initial Plan ==")[0]
        assert final.count("FileScan") <= scans, name


def test_sliding_windows_deal_a_key_over_stretches_of_time(spark):
    """7,200 hops: a short plan, and no shuffle by the key alone."""
    df = windowed.window_aggregate(events(spark, SF_DIR), "ts", ["event_type"], {"n": ("count", "*")}, "2 hours", "1 second")
    plan = plan_of(df)
    assert len(plan) < 12_000
    assert re.search(r"hashpartitioning\(event_type#\d+, __stretch#\d+", plan)
    assert not re.search(r"hashpartitioning\(event_type#\d+, \d+\)", plan)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_overlapping_counts_are_shuffled_once(spark, kind):
    """Partial rows of a key and stretch of time cross the network; their copies in windows do not."""
    rows = [(None if i % 31 == 0 else (i * 7919) % 9000 - 3000, "abc"[i % 3], None if i % 5 == 0 else i % 4 - 1) for i in range(400)]
    df = spark.createDataFrame(rows, "second int, k string, v int").repartition(3)
    start = F.lit("2021-03-14 00:10:00").cast(kind)
    df = df.withColumn("ts", start + F.make_dt_interval(secs=F.col("second") + F.lit(0.5).cast("decimal(18,6)")))
    measures = {"n": ("count", "*"), "given": ("count", "v"), "total": ("sum", "v")}
    got = windowed.window_aggregate(df, "ts", ["k"], measures, "5 minutes", "1 minute")
    plain = windowed.window_aggregate(df, "ts", ["k"], measures, "5 minutes", "1 minute", preaggregate=False)
    assert got.dtypes == plain.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
    assert len(re.findall(r"Exchange hashpartitioning", plan_of(got).split("Initial Plan")[-1])) == 1
