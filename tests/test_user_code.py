"""A user's own sources, sinks and processors on streams."""

from __future__ import annotations

import pathlib
import uuid
from datetime import datetime, timedelta

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidetable.functions import timewin
from tidetable.operators import running, windowed
from tidetable.session import shared_folder, streaming_session
from tidetable.sources import files, user
from tidetable.streaming import jobs, run, sinks, stateful

NOON = datetime(2024, 3, 10, 12)


@pytest.fixture
def session(spark):
    return streaming_session(spark)


@pytest.fixture
def folder(spark):
    return shared_folder(spark)


def place(session, folder: str, number: int, rows, schema: str) -> None:
    """One more place of a script: a single file."""
    made = f"{folder}/made-{uuid.uuid4().hex}"
    session.createDataFrame(rows, schema).coalesce(1).write.parquet(made)
    pathlib.Path(f"{folder}/script").mkdir(parents=True, exist_ok=True)
    user.publish(made, f"{folder}/script", f"{number:04d}")


def test_a_user_source_goes_on_behind_its_offset(session, folder):
    schema = "ts timestamp, k string"
    name = f"script_{uuid.uuid4().hex[:8]}"
    at = lambda minutes: NOON + timedelta(minutes=minutes)
    place(session, folder, 0, [(at(0), "a"), (at(1), "b")], schema)
    place(session, folder, 1, [(at(9), "a")], schema)
    user.register_source(session, name, session.createDataFrame([], schema).schema, user.FolderScript(f"{folder}/script"))

    def drained():
        stream = session.readStream.format(name).load().withWatermark("ts", "5 minutes")
        counted = windowed.window_aggregate(stream, "ts", ["k"], {"n": ("count", "*")}, "5 minutes")
        run.drain(counted, user.committed_files_sink(session, f"{folder}/out"), f"{folder}/cp")
        held = user.read_committed(session, f"{folder}/out", counted.schema)
        return sorted((r["k"], int((r["w_start"] - NOON).total_seconds()) // 60, r["n"]) for r in held.collect())

    assert drained() == []
    place(session, folder, 2, [(at(3), "a"), (at(20), "c")], schema)  # late, but within five minutes of the highest time
    drained()
    place(session, folder, 3, [(at(40), "c")], schema)
    drained()
    place(session, folder, 4, [(at(2), "a"), (at(90), "end")], schema)  # its window is closed by now
    drained()
    place(session, folder, 5, [(at(200), "end")], schema)
    assert drained() == [("a", 0, 2), ("a", 5, 1), ("b", 0, 1), ("c", 20, 1), ("c", 40, 1)]


def test_a_batch_written_twice_counts_once(session, folder):
    schema = session.createDataFrame([], "x long").schema
    writer = user._Writer(f"{folder}/out")
    batch = pa.record_batch({"x": [1, 2]})
    lost = writer.write(iter([batch]))
    kept = [writer.write(iter([batch])), writer.write(iter([]))]
    writer.commit(kept, 0)
    writer.commit(kept, 0)
    assert lost.file and len(list(pathlib.Path(f"{folder}/out/data").iterdir())) == 2
    assert sorted(r["x"] for r in user.read_committed(session, f"{folder}/out", schema).collect()) == [1, 2]
    assert user.read_committed(session, f"{folder}/none", schema).count() == 0


def fed(session, folder, schema, *parts):
    for part in parts:
        session.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    return files.stream_table(session, f"{folder}/in", schema, files_per_batch=1)


def test_processors_equal_the_native_forms(session, folder):
    big = 2**60 + 1
    data = [("a", 0, 1), ("b", 1, None), ("a", 2, big), ("a", 3, None), (None, 4, 3), ("b", 5, 7), ("a", 6, -4), ("b", 7, None)]
    schema = "key string, seq bigint, value bigint"
    stream = fed(session, folder, schema, data[:3], data[3:6], data[6:])
    run.drain(stateful.running_total(stream, "key"), sinks.file_sink(f"{folder}/t"), f"{folder}/cp-t")
    whole = session.createDataFrame(data, schema)
    want = running.running_total(whole, ["key"], "value", "seq")
    got = session.read.parquet(f"{folder}/t").select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))

    run.drain(stateful.retracting_sum(stream.drop("seq"), "key"), sinks.file_sink(f"{folder}/r"), f"{folder}/cp-r")
    held = session.read.parquet(f"{folder}/r").where("key = 'b'").orderBy("step", "op").collect()
    assert [(r["op"], r["step"], r["total"]) for r in held] == [(True, 1, None), (False, 2, None), (True, 2, 7)]


def test_processors_compare_nulls_and_nans_by_value(session, folder):
    nan, day = float("nan"), timedelta(days=1)
    values = [1.0, 1.0, nan, nan, None, None, 2.0]
    rows = [("a", NOON + i * day, NOON + (i + 1) * day, v) for i, v in enumerate(values)]
    stream = fed(session, folder, "key string, w_start timestamp, w_end timestamp, value double", rows[:3][::-1], rows[3:])
    run.drain(stateful.emit_on_change(stream, "key"), sinks.file_sink(f"{folder}/out"), f"{folder}/cp")
    held = session.read.parquet(f"{folder}/out").orderBy("w_start").collect()
    assert [((r["w_start"] - NOON).days, str(r["value"])) for r in held] == [(0, "1.0"), (2, "nan"), (4, "None"), (6, "2.0")]


def test_timer_top_k_of_texts_across_a_clock_change(session, folder):
    """Items are texts, and a window ends inside the hour that a local clock skips."""
    session.conf.set("spark.sql.session.timeZone", "America/New_York")
    rows = [(1710054000 + 60 * i, item) for i in range(60) for item in ("pear", "fig", "plum")[: 1 + i % 3]]  # 2024-03-10 07:00 UTC
    stream = fed(session, folder, "s long, item string", rows, [(1710054000 + 86_400, "end")], [(1710054000 + 2 * 86_400, "end")])
    timed = timewin.with_event_time(stream, "s", "s", delay="0 seconds")
    counts = windowed.window_aggregate(timed, "ts", ["item"], {"n": ("count", "*")}, "30 minutes")
    best = stateful.window_top_k(counts.select("w_end", "item", "n"), "w_end", 2, shares=2)
    run.drain(best, jobs.top_k_sink(f"{folder}/out", ["w_end"], "n", "item", 2), f"{folder}/cp")
    held = sinks.read_batches(session, f"{folder}/out").where("item <> 'end'").select(F.unix_seconds("w_end").alias("w"), "rank", "item", "n")
    assert sorted(map(tuple, held.collect())) == [
        (1710054000 + 1800, 1, "pear", 30), (1710054000 + 1800, 2, "fig", 20), (1710054000 + 3600, 1, "pear", 30), (1710054000 + 3600, 2, "fig", 20),
    ]


def test_values_over_batches_need_no_python(session):
    """What `carry` computes per micro-batch: plans without a Python node."""
    day = session.range(10).select(F.lit("k").alias("k"), F.timestamp_seconds("id").alias("w_start"), F.lit(1.0).alias("v"))
    opening = day.select("k", "v").limit(1)
    for made in (
        running.emit_on_change(day, ["k"], "w_start", "v", opening=opening),
        running.running_total(day.withColumn("v", F.lit(1)), ["k"], "v", "w_start", opening=opening.select("k", F.lit(1).cast("long").alias("total"))),
    ):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan


SINKS_IN_A_FRESH_PROCESS = """
from pyspark.sql import SparkSession
from tidetable.session import streaming_session
from tidetable.sources import user
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
for number in range(3):
    user.committed_files_sink(streaming_session(spark), "/unused")
"""


def test_sinks_of_sibling_sessions_do_not_clash():
    """A sibling and its parent both learn a sink's format; each sink, in a fresh process as a driver runs, must not clash."""
    import subprocess
    import sys

    root = pathlib.Path(__file__).resolve().parents[1]
    done = subprocess.run([sys.executable, "-c", SINKS_IN_A_FRESH_PROCESS], cwd=root, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
