"""Streams replayed file by file: equal to the bounded result, over restarts, with late and early rows."""

from __future__ import annotations


import time

import pytest

from tidetable import schemas
from tidetable.functions import timewin
from tidetable.operators import windowed
from tidetable.operators.changelog import aggregate_changelog, versions_changelog
from tidetable.session import shared_folder, streaming_session
from tidetable.sources import files, lines
from tidetable.streaming import carry, jobs, run, sinks, stateful


@pytest.fixture
def session(spark):
    return streaming_session(spark)


@pytest.fixture
def folder(spark):
    return shared_folder(spark)


def write_lines(folder: str, *batches) -> str:
    """One text file per micro-batch, older files first."""
    import os
    import pathlib

    path = pathlib.Path(folder) / "lines"
    path.mkdir(parents=True, exist_ok=True)
    base = len(list(path.iterdir()))
    for i, batch in enumerate(batches, base):
        file = path / f"{i:04d}.txt"
        file.write_text("\n".join(batch) + "\n")
        os.utime(file, (1_600_000_000 + i * 10,) * 2)
    return str(path)


def bills_stream(session, path, delay="0 seconds"):
    parsed = lines.parse_fields(lines.stream_lines(session, path, files_per_batch=1), schemas.BILL)
    return timewin.with_event_time(parsed, "timestamp", "ms", delay=delay)


BILLS = [
    ["bill 10 1577259310000"], ["alice 20 1577259313000"], ["bill 20 1577259312000"],
    ["tom 50 1577259314000"], ["bill 80 1577259320000"],
]


def averages(stream):
    return windowed.window_aggregate(stream, "ts", ["userId"], {"avg": ("avg", "price")}, "10 seconds")


def test_append_emits_closed_windows_only(session, folder):
    path = write_lines(folder, *BILLS)
    run.drain(averages(bills_stream(session, path)), sinks.file_sink(f"{folder}/out"), f"{folder}/cp")
    held = session.read.parquet(f"{folder}/out").select("userId", "avg").collect()
    assert sorted(tuple(r) for r in held) == [("alice", 20.0), ("bill", 15.0), ("tom", 50.0)]


def test_update_mode_emits_one_result_per_record_at_one_record_per_batch(session, folder):
    path = write_lines(folder, *BILLS)
    run.drain(averages(bills_stream(session, path)), sinks.batch_folders(f"{folder}/out"), f"{folder}/cp", "update")
    held = sinks.read_batches(session, f"{folder}/out").orderBy("batch").select("userId", "avg").collect()
    assert [tuple(r) for r in held] == [("bill", 10.0), ("alice", 20.0), ("bill", 15.0), ("tom", 50.0), ("bill", 80.0)]
    versions = sinks.read_batches(session, f"{folder}/out")
    log = versions_changelog(versions, ["userId", "w_start", "w_end"], "batch").orderBy("batch", "op")
    assert [tuple(r) for r in log.select("op", "userId", "avg").collect()] == [
        (True, "bill", 10.0), (True, "alice", 20.0), (False, "bill", 10.0), (True, "bill", 15.0),
        (True, "tom", 50.0), (True, "bill", 80.0),
    ]


def test_late_rows_drop_and_lateness_keeps_them(session, folder):
    # Spark drops rows behind the watermark of the batch before, so one more batch passes before the late row
    late = [["bill 10 1577259310000"], ["bill 20 1577259325000"], ["bill 20 1577259326000"], ["bill 30 1577259311000"]]
    path = write_lines(folder, *late)
    counts = {}
    for name, lateness in (("strict", "0 seconds"), ("lenient", "1 minute")):
        parsed = lines.parse_fields(lines.stream_lines(session, path, 1), schemas.BILL)
        stamped = run.with_lateness(timewin.with_event_time(parsed, "timestamp", "ms"), "ts", "0 seconds", lateness)
        out = f"{folder}/{name}"
        run.drain(averages(stamped), sinks.batch_folders(out), f"{folder}/cp-{name}", "update")
        newest = sinks.read_upserts(session, out, ["userId", "w_start", "w_end"])
        counts[name] = sorted(r["avg"] for r in newest.collect())
    assert counts == {"strict": [10.0, 20.0], "lenient": [20.0, 20.0]}


def test_out_of_order_row_within_the_delay_counts(session, folder):
    path = write_lines(folder, ["a 1 1577259310000"], ["a 1 1577259325000"], ["a 4 1577259311000"], ["a 1 1577259900000"])
    run.drain(averages(bills_stream(session, path, "10 seconds")), sinks.file_sink(f"{folder}/out"), f"{folder}/cp")
    held = session.read.parquet(f"{folder}/out").orderBy("w_start").collect()
    # the watermark trails the second row by ten seconds, so the third row's window is still open
    assert [r["avg"] for r in held] == [2.5, 1.0]


def test_running_totals_continue_over_batches_and_restarts(session, folder):
    schema = "word string, seq bigint, v bigint"
    data = [("a", 0, 1), ("b", 1, 5), ("a", 2, 2), ("a", 3, 4), ("b", 4, 1), ("c", 5, 3), ("a", 6, 7)]

    def feed(*parts):
        for part in parts:
            session.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")

    def go():
        stream = files.stream_table(session, f"{folder}/in", schema, files_per_batch=1)
        sink = carry.running_total_sink(f"{folder}/out", f"{folder}/totals", ["word"], "v", "seq")
        run.drain(stream, sink, f"{folder}/cp")

    feed(data[:3], data[3:5])
    go()
    feed(data[5:6], data[6:])
    go()
    held = sinks.read_batches(session, f"{folder}/out").orderBy("seq").collect()
    assert [(r["word"], r["total"]) for r in held] == [
        ("a", 1), ("b", 5), ("a", 3), ("a", 7), ("b", 6), ("c", 3), ("a", 14),
    ]
    assert len({r["batch"] for r in held}) == 4


def test_processors_keep_totals_record_by_record(session, folder):
    path = write_lines(folder, ["a 1 0"], ["a 2 1"], ["b 5 2"], ["a 0 3"], ["a 4 4"])
    parsed = lines.parse_fields(lines.stream_lines(session, path, 1), "key string, value bigint, seq bigint")
    run.drain(stateful.running_total(parsed, "key"), sinks.file_sink(f"{folder}/t"), f"{folder}/cp-t")
    totals = session.read.parquet(f"{folder}/t").orderBy("seq").collect()
    assert [(r["key"], r["total"]) for r in totals] == [("a", 1), ("a", 3), ("b", 5), ("a", 3), ("a", 7)]

    log = stateful.retracting_sum(parsed.select("key", "value"), "key")
    run.drain(log, sinks.file_sink(f"{folder}/r"), f"{folder}/cp-r")
    changes = session.read.parquet(f"{folder}/r").orderBy("key", "step", "op").collect()
    assert [(r["op"], r["key"], r["total"]) for r in changes] == [
        (True, "a", 1), (False, "a", 1), (True, "a", 3), (False, "a", 3), (True, "a", 7), (True, "b", 5),
    ]
    table = sinks.changelog_view(session.read.parquet(f"{folder}/r"), ["key"], "step")
    assert sorted(tuple(r) for r in table.collect()) == [("a", 7), ("b", 5)]


def test_state_with_expiry_runs_as_a_standing_query(session, folder):
    path = write_lines(folder, ["a 1"], ["a 2"])
    parsed = lines.parse_fields(lines.stream_lines(session, path, 1), "key string, value bigint")
    log = stateful.retracting_sum(parsed, "key", ttl_ms=3_600_000)
    query = run.continuous(log, lambda writer: writer.format("memory"), f"{folder}/cp", "200 milliseconds", name="expiring")
    deadline = time.time() + 60
    while session.table("expiring").count() < 3 and time.time() < deadline:
        time.sleep(0.5)
    query.stop()
    held = session.table("expiring").orderBy("step", "op").collect()
    assert [(r["op"], r["total"]) for r in held] == [(True, 1), (False, 1), (True, 3)]


def test_equal_average_is_suppressed_across_batches(session, folder):
    path = write_lines(folder, *BILLS, ["tom 50 1577259321000"], ["end 0 1577269321000"])
    changed = jobs.emit_on_change(averages(bills_stream(session, path)), "userId", "avg")
    run.drain(changed, sinks.file_sink(f"{folder}/out"), f"{folder}/cp")
    held = session.read.parquet(f"{folder}/out").select("userId", "avg").collect()
    assert sorted(tuple(r) for r in held) == [("alice", 20.0), ("bill", 15.0), ("bill", 80.0), ("tom", 50.0)]


def test_words_carried_over_windows(session, folder):
    path = write_lines(folder, ["a,1,1000"], ["a,2,2000", "b,5,2500"], ["a,4,4000"], ["z,0,900000"])
    parsed = lines.parse_csv_payload(lines.stream_lines(session, path, 1), schemas.WORD_EVENT)
    stamped = timewin.with_event_time(parsed, "timestamp", "ms", delay="1 second")
    sums = windowed.window_aggregate(stamped, "ts", ["word"], {"total": ("sum", "frequency")}, "3 seconds")
    run.drain(jobs.carried_total(sums, "word", "total"), sinks.file_sink(f"{folder}/out"), f"{folder}/cp")
    held = session.read.parquet(f"{folder}/out").collect()
    assert sorted((r["word"], r["w_start"].second, r["total"]) for r in held) == [("a", 0, 3), ("a", 3, 7), ("b", 0, 5)]


def test_scripted_source_to_csv(session, folder):
    log = [
        (1510365660000, "ShangHai", "U0010"), (1510365660000, "BeiJing", "U1001"), (1510366200000, "BeiJing", "U2032"),
        (1510366260000, "BeiJing", "U1100"), (1510373400000, "ShangHai", "U0011"),
    ]
    for row in log:
        session.createDataFrame([row], schemas.ACCESS_LOG).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = files.stream_table(session, f"{folder}/in", schemas.ACCESS_LOG, files_per_batch=1)
    timed = timewin.with_event_time(stream, "accessTime", "ms", "accessTime", delay="0 seconds")
    counted = windowed.window_aggregate(timed, "accessTime", ["region"], {"pv": ("count", "region")}, "2 minutes")
    run.drain(counted, sinks.csv_sink(f"{folder}/out"), f"{folder}/cp")
    held = files.read_csv(session, f"{folder}/out", schemas.REGION_PV).collect()
    assert sorted((r[0], f"{r[1]:%H:%M}", f"{r[2]:%H:%M}", r[3]) for r in held) == [
        ("BeiJing", "02:00", "02:02", 1), ("BeiJing", "02:10", "02:12", 2), ("ShangHai", "02:00", "02:02", 1),
    ]


def test_csv_stream_console_and_standing_query(session, folder):
    session.createDataFrame([(1, 2, 3, "pv", 1577259310)], schemas.USER_BEHAVIOR_CSV).write.csv(f"{folder}/in")
    stream = files.stream_csv(session, f"{folder}/in", schemas.USER_BEHAVIOR_CSV).where("behavior = 'pv'")
    query = run.continuous(stream, sinks.console_sink("views"), f"{folder}/cp", "100 milliseconds")
    query.processAllAvailable()
    query.stop()
    assert query.name == "views" and query.recentProgress[0]["numInputRows"] == 1


def test_early_page_views_and_visitors(session, folder):
    visits = [["111 one 1"], ["111 two 2"], ["111 one 3"], ["222 two 4"]]
    path = write_lines(folder, *visits)
    parsed = lines.parse_fields(lines.stream_lines(session, path, 1), schemas.VISIT)
    run.drain(jobs.early_views(parsed, ["date"]), sinks.batch_folders(f"{folder}/pv"), f"{folder}/cp-pv", "update")
    run.drain(
        jobs.early_visitors(parsed, ["date"], "eventId"), sinks.batch_folders(f"{folder}/uv"), f"{folder}/cp-uv", "update"
    )
    pv = sinks.read_batches(session, f"{folder}/pv").orderBy("batch").collect()
    assert [(r["date"], r["pv"]) for r in pv] == [("111", 1), ("111", 2), ("111", 3), ("222", 1)]
    dealt = jobs.early_visitors(parsed, ["date"], "eventId", salts=3, salt_by="timestamp")
    run.drain(dealt, sinks.batch_folders(f"{folder}/dealt"), f"{folder}/cp-dealt", "update")
    for name in ("uv", "dealt"):
        uv = sinks.read_upserts(session, f"{folder}/{name}", ["date"]).collect()
        assert sorted(tuple(r) for r in uv) == [("111", 2), ("222", 1)]


def test_shared_folder_needs_a_setting_off_the_local_master(spark):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda name, default=None: default)

    with pytest.raises(ValueError):
        shared_folder(Session())


def test_visitors_changelog_over_batches_and_a_retry(spark, folder):
    """Page views and visitors continue over micro-batches, null keys and visitors included; a repeated batch changes nothing."""
    first = [("h1", 1, "a"), ("h1", 2, "b"), ("h1", 3, None), ("h2", 4, "a"), (None, 5, "a")]
    second = [("h1", 6, "a"), ("h1", 7, "c"), (None, 8, "a"), (None, 9, None), (None, 10, "b")]
    schema, held = "dt string, seq int, visitor string", []

    class Writer:
        def foreachBatch(self, write):
            held.append(write)

    carry.visitors_changelog_sink(f"{folder}/out", f"{folder}/state", ["dt"], "seq", "visitor")(Writer())
    for number, rows in ((0, first), (1, second), (1, second)):
        held[0](spark.createDataFrame(rows, schema), number)
    whole = spark.createDataFrame(first + second, schema)
    want = aggregate_changelog(whole, ["dt"], "seq", {"pv": ("count", "*"), "uv": ("count_distinct", "visitor")})
    got = sinks.read_batches(spark, f"{folder}/out").select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_word_count_stream_adds_counts_up_without_a_state_store(spark, monkeypatch):
    import os

    from pyspark.sql import functions as F

    from tests.conftest import SF_DIR
    from tidetable.plans import streams
    from tidetable.plans.tables import table, utc_wall

    made = []
    monkeypatch.setattr(streams, "shared_folder", lambda caller: made.append(shared_folder(caller)) or made[-1])
    got = streams.stream_word_count(spark, SF_DIR)
    docs = table(spark, SF_DIR, "documents").select(F.timestamp_seconds("doc_id").alias("arrival"), "text")
    want = windowed.word_count(docs, "text", "arrival", "5 minutes").withColumns({c: utc_wall(c) for c in streams.WINDOW})
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))
    assert not os.path.exists(f"{made[0]}/checkpoint/state")
