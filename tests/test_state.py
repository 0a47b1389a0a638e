"""State between micro-batches: what a batch touches, retries, expiry, and results equal to those of the whole input."""

from __future__ import annotations

import pathlib
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidetable.operators import joins, running
from tidetable.operators.changelog import aggregate_changelog, apply_changelog
from tidetable.session import shared_folder
from tidetable.streaming import carry, panes, sinks, state_table
from tidetable.streaming.state_table import StateTable


@pytest.fixture
def folder(spark):
    return shared_folder(spark)


def feeder(sink):
    """The sink's function for one micro-batch."""
    held = []

    class Writer:
        def foreachBatch(self, write):
            held.append(write)

    sink(Writer())
    return held[0]


def text(df, columns=None) -> list[str]:
    return sorted(str(tuple(r)) for r in df.select(*(columns or df.columns)).collect())


def files_of(folder: str) -> dict[str, float]:
    return {str(p): p.stat().st_mtime for p in pathlib.Path(folder).rglob("*.parquet")}


def counts(spark, rows):
    return spark.createDataFrame(rows, "k string, n long")


def test_a_batch_of_one_key_writes_one_bucket_and_reads_one(spark, folder):
    table = StateTable(spark, f"{folder}/s", ["k"], buckets=8)
    table.commit(0, counts(spark, [(f"k{i}", i) for i in range(100)]))
    before = files_of(folder)
    assert len(before) == 8
    table.commit(1, counts(spark, [("k7", 700)]))
    after = files_of(folder)
    assert len(after) == 9 and all(after[f] == t for f, t in before.items())
    one = counts(spark, [("k7", 0)])
    assert len(table.touched(one)) == 1 and text(table.opening(one, 2)) == ["('k7', 700)"]
    near = table.opening(one, 2, exact=False)
    read = {f.split("/data/")[1].split("-")[0] for f in near.inputFiles()}
    assert read == {"0", "1"} and len(near.inputFiles()) == 2
    assert text(table.read()) == text(counts(spark, [(f"k{i}", 700 if i == 7 else i) for i in range(100)]))


def test_versions_stay_until_they_are_old_and_repeats_change_nothing(spark, folder):
    table = StateTable(spark, f"{folder}/s", ["k"], buckets=2, most_deltas=2)
    for number in range(7):
        table.commit(number, counts(spark, [("a", number), (None, -number)]))
        held = files_of(folder)
        table.commit(number, counts(spark, [("a", 999)]))
        assert files_of(folder) == held
        assert text(table.read()) == text(counts(spark, [("a", number), (None, -number)]))
        if number:
            assert text(table.read(table.version(number))) == text(counts(spark, [("a", number - 1), (None, 1 - number)]))
    # bounded: at most three deltas of either bucket for each of the versions that stay
    assert len(files_of(folder)) <= 2 * 3 * state_table.KEPT and len(table.numbers()) == state_table.KEPT
    assert all(len(folders) <= 2 for folders in table.version().entries.values())
    assert StateTable(spark, f"{folder}/s", ["k"], buckets=64).buckets == 2


def test_a_failed_attempt_leaves_no_trace(spark, folder):
    table = StateTable(spark, f"{folder}/s", ["k"], buckets=2)
    table.commit(0, counts(spark, [("a", 1)]))
    table._write(counts(spark, [("a", 50)]).withColumn("__version", F.lit(1).cast("long")), 1)  # then the driver dies
    assert not table.has(1) and text(table.read()) == ["('a', 1)"]
    table.commit(1, counts(spark, [("a", 2)]))
    assert text(table.read()) == ["('a', 2)"]
    for number in (2, 3, 4):
        table.commit(number, counts(spark, [("b", number)]))
    assert not any(p.name.startswith("1-") and "a" in p.name and not list(p.rglob("*.parquet")) for p in pathlib.Path(f"{folder}/s/data").iterdir())


def test_periods_leave_as_a_whole(spark, folder):
    table = StateTable(spark, f"{folder}/s", ["k"], F.col("n"), buckets=2)
    table.commit(0, counts(spark, [("a", 10), ("b", 20), ("c", 30)]))
    table.commit(1, counts(spark, [("d", 30)]), high=5, drop_below=20)
    assert text(table.read()) == text(counts(spark, [("b", 20), ("c", 30), ("d", 30)]))
    assert table.version().high == 5 and all(period >= 20 for period, _ in table.version().entries)
    table.commit(2, counts(spark, []), drop_below=99)
    assert table.read() is None and table.opening(counts(spark, [("a", 10)]), 3) is None


def test_keyed_table_behind_a_changelog(spark, folder):
    rng = random.Random(4)
    schema = "op boolean, k string, seq long, v long"
    log = [(rng.random() < 0.7, rng.choice(["a", "b", "c", "d", None]), rng.randrange(60), rng.randrange(9)) for _ in range(120)]
    seen, rows = set(), []
    for row in log:  # one change per key, number and kind
        if row[:3] not in seen:
            seen.add(row[:3])
            rows.append(row)
    write = feeder(state_table.keyed_table_sink(f"{folder}/t", ["k"], "seq", buckets=2, most_deltas=2))
    for number in range(8):  # changes come in any order
        for _ in range(1 + number % 2):
            write(spark.createDataFrame(rows[number::8], schema), number)
    want = apply_changelog(spark.createDataFrame(rows, schema), ["k"], "seq")
    assert text(state_table.read_keyed_table(spark, f"{folder}/t", ["k"], "seq"), ["k", "v"]) == text(want, ["k", "v"])


def test_visitors_of_repeated_records(spark, folder):
    """A source that repeats records: equal numbers are one step, and a visitor counts once."""
    schema = "dt string, seq int, visitor string"
    batches = [
        [("h", 1, "a"), ("h", 1, "a"), ("h", 2, "b")],
        [("h", 2, "b"), ("h", 3, "c"), ("h", 3, "c"), (None, 4, "a"), (None, 4, "a")],
    ]
    write = feeder(carry.visitors_changelog_sink(f"{folder}/out", f"{folder}/s", ["dt"], "seq", "visitor"))
    for number, rows in enumerate(batches):
        write(spark.createDataFrame(rows, schema), number)
    got = sinks.read_batches(spark, f"{folder}/out")
    assert text(got.where("dt = 'h'").orderBy("batch", "seq", "op"), ["op", "seq", "pv", "uv"]) == sorted(
        map(str, [(True, 1, 2, 1), (False, 2, 2, 1), (True, 2, 3, 2), (False, 2, 3, 2), (True, 2, 4, 2), (False, 3, 4, 2), (True, 3, 6, 3)])
    )
    whole = spark.createDataFrame([r for r in batches[0]], schema)
    want = aggregate_changelog(whole, ["dt"], "seq", {"pv": ("count", "*"), "uv": ("count_distinct", "visitor")})
    assert text(got.where("batch = 0"), want.columns) == text(want)


START = datetime(2024, 1, 1)
EVENTS = "seq long, k string, ts timestamp, visitor string, v double, cents long, isleft boolean"


def events(seed: int = 6, n: int = 240) -> list[tuple]:
    """Events in rising time over three days, one key with most of them, nulls in every column but the number."""
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        key = rng.choice(["hot"] * 5 + ["b", "c", None])
        rows.append(
            (seq, key, START + timedelta(minutes=seq * 18), rng.choice(["x", "y", "z", None]), rng.choice([1.5, None]),
             rng.choice([100, 250, None]), rng.random() < 0.5)
        )
    return rows


def fed(spark, folder, sink, rows, cuts=(0, 1, 60, 61, 150, 240), schema=EVENTS):
    """What the sink holds after micro-batches cut at these places, every other one tried twice."""
    write = feeder(sink)
    for number, (first, end) in enumerate(zip(cuts, cuts[1:])):
        for _ in range(1 + number % 2):
            write(spark.createDataFrame(rows[first:end], schema), number)
    return sinks.read_batches(spark, f"{folder}/out").drop(sinks.BATCH)


def test_panes_over_batches_equal_those_of_the_whole(spark, folder):
    rows, whole = events(), spark.createDataFrame(events(), EVENTS)
    sink = panes.average_panes_sink(f"{folder}/a/out", f"{folder}/a/s", "ts", ["k"], "cents", "seq", "1 day")
    want = running.average_panes(whole, "ts", ["k"], "cents", "seq", "1 day")
    assert text(fed(spark, f"{folder}/a", sink, rows), want.columns) == text(want)
    sink = panes.pv_uv_panes_sink(f"{folder}/b/out", f"{folder}/b/s", "ts", ["k"], "visitor", "seq", "1 day")
    want = running.pv_uv_panes(whole, "ts", ["k"], "visitor", "seq", "1 day")
    assert text(fed(spark, f"{folder}/b", sink, rows), want.columns) == text(want)
    # yesterday's windows have left the state
    ends = StateTable(spark, f"{folder}/b/s/seen", ["k", "w_start", "w_end", "visitor"], F.col("__at"), plain=True)
    assert {p for p, _ in ends.version().entries} == {int((START + timedelta(days=d) - datetime(1970, 1, 1)).total_seconds()) * 10**6 for d in (2,)}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_panes_over_batches_equal_those_of_the_whole(spark, folder, how):
    rows, whole = events(), spark.createDataFrame(events(), EVENTS)
    left = whole.where("isleft").select("k", "seq", F.col("ts").alias("l_ts"), "visitor")
    right = whole.where("not isleft").select("k", "seq", F.col("ts").alias("r_ts"), "cents")
    want = joins.window_join_panes(left, right, "k", "l_ts", "r_ts", "seq", "1 day", how, ["cents"])
    sink = panes.join_panes_sink(
        f"{folder}/out", f"{folder}/s", "k", ["seq", "l_ts", "visitor"], ["right_seq", "r_ts", "cents"], "seq", "1 day", how, ["cents"]
    )
    write = feeder(sink)
    for number, (first, end) in enumerate(((0, 1), (1, 90), (90, 91), (91, 240))):
        part = spark.createDataFrame(rows[first:end], EVENTS)
        a = part.where("isleft").select("k", "seq", F.col("ts").alias("l_ts"), "visitor")
        b = part.where("not isleft").select("k", "seq", F.col("ts").alias("r_ts"), "cents")
        write(panes.tagged(a, b, "k", "l_ts", "r_ts", "seq"), number)
    got = panes.emitted_panes(sinks.read_batches(spark, f"{folder}/out"))
    assert text(got, want.columns) == text(want) and want.count() > 500
    assert max(r["fires"] for r in want.collect()) > 20


def test_late_records_find_their_window_gone(spark, folder):
    rows = [(0, "a", START, "x", None, 100, True), (1, "a", START + timedelta(days=2), "x", None, 100, True)]
    rows += [(2, "a", START + timedelta(hours=1), "y", None, 900, True), (3, "a", START + timedelta(days=2, hours=1), "x", None, 300, True)]
    sink = panes.average_panes_sink(f"{folder}/out", f"{folder}/s", "ts", ["k"], "cents", "seq", "1 day")
    got = fed(spark, folder, sink, rows, cuts=(0, 2, 4))
    assert text(got, ["seq", "avg"]) == ["(0, 100.0)", "(1, 100.0)", "(3, 200.0)"]


def test_hours_of_visitors_expire(spark, folder):
    schema = "dt string, ts timestamp, visitor string"
    hour = lambda h, v: (f"h{h}", START + timedelta(hours=h, minutes=5), v)
    retention = carry.Retention("ts", "1 hour", "2 hours")
    write = feeder(carry.visitors_sink(f"{folder}/out", f"{folder}/s", ["dt"], "visitor", retention))
    batches = [[hour(0, "a"), hour(0, "b")], [hour(1, "a"), hour(0, "a"), hour(0, None)], [hour(6, "a")], [hour(0, "c"), hour(6, "b"), hour(6, "a")]]
    for number, rows in enumerate(batches):
        write(spark.createDataFrame(rows, schema), number)
    newest = sinks.read_upserts(spark, f"{folder}/out", ["dt"])
    assert text(newest, ["dt", "pv", "uv"]) == ["('h0', 4, 2)", "('h1', 1, 1)", "('h6', 3, 2)"]
    seen = StateTable(spark, f"{folder}/s/seen", ["dt", "visitor"], F.col("__at"), plain=True)
    assert text(seen.read(), ["dt", "visitor"]) == ["('h6', 'a')", "('h6', 'b')"]


CLOSED = "k string, w_start timestamp, w_end timestamp, value double"


def windows(values, key="a", first=0):
    day = timedelta(days=1)
    return [(key, START + (first + i) * day, START + (first + i + 1) * day, v) for i, v in enumerate(values)]


def test_changes_compare_nulls_and_nans_by_value(spark, folder):
    nan = float("nan")
    batches = [windows([1.0, 1.0, nan]), windows([nan, None, None, 2.0], first=3) + windows([nan], None), windows([2.0, nan], first=7) + windows([nan], None, 1)]
    write = feeder(carry.emit_on_change_sink(f"{folder}/out", f"{folder}/s", ["k"], "value"))
    for number, rows in enumerate(batches):
        write(spark.createDataFrame(rows, CLOSED), number)
    got = sinks.read_batches(spark, f"{folder}/out").orderBy("w_start").collect()
    assert [((r["w_start"] - START).days, str(r["value"])) for r in got if r["k"] == "a"] == [(0, "1.0"), (2, "nan"), (4, "None"), (6, "2.0"), (8, "nan")]
    assert [((r["w_start"] - START).days, str(r["value"])) for r in got if r["k"] is None] == [(0, "nan")]


def test_totals_of_a_hot_key_over_many_windows(spark, folder):
    write = feeder(carry.carried_total_sink(f"{folder}/out", f"{folder}/s", ["k"], "value"))
    for number in range(3):
        ids = spark.range(number * 50_000, (number + 1) * 50_000, numPartitions=4)
        start = F.timestamp_seconds(F.col("id") * 60)
        write(ids.select(F.lit("hot").alias("k"), start.alias("w_start"), (start + F.expr("interval 1 minute")).alias("w_end"), F.lit(2).cast("long").alias("value")), number)
    got = sinks.read_batches(spark, f"{folder}/out")
    wrong = got.where(F.col("total") != 2 * (F.unix_seconds("w_start") / 60 + 1))
    assert got.count() == 150_000 and wrong.count() == 0


def plain_versions(rows, early=6, late=3, lateness=24) -> list[str]:
    out, hour = [], 3_600
    groups: dict = {}
    for key, ts, arrival in rows:
        at, s = (arrival - START).total_seconds(), (ts - START).days * 24 * hour
        end = s + 24 * hour
        if at <= end + lateness * hour:
            step = early if at <= end else late
            tick = -(-at // (step * hour)) * step * hour
            groups.setdefault((key, s), []).append(min(tick, end) if at <= end else tick)
    for (key, s), ticks in groups.items():
        for version, tick in enumerate(sorted(set(ticks)), 1):
            end = s + 24 * hour
            kind = "early" if tick < end else "on time" if tick == end else "late"
            out.append(str((key, START + timedelta(seconds=s), START + timedelta(seconds=tick), kind, version, sum(t <= tick for t in ticks))))
    return sorted(out)


@pytest.mark.parametrize("cuts", [(0, 60), (0, 7, 20, 21, 22, 45, 60)])
def test_versions_fire_in_two_rhythms_wherever_batches_are_cut(spark, folder, cuts):
    rng = random.Random(8)
    rows = []
    for i in range(59):
        arrival = START + timedelta(hours=1.5 * i, minutes=rng.randrange(60))
        rows.append((rng.choice(["a", "b", None]), max(START, arrival - timedelta(hours=rng.choice([0, 0, 0, 5, 20, 60]))), arrival))
    rows.append(("end", START + timedelta(days=900), START + timedelta(days=900)))
    sink = panes.firing_sink(f"{folder}/out", f"{folder}/s", "ts", "at", ["k"], "1 day", "6 hours", "3 hours", "1 day")
    got = fed(spark, folder, sink, rows, cuts, "k string, ts timestamp, at timestamp")
    want = plain_versions(rows[:-1])
    assert text(got.where("k is null or k <> 'end'"), ["k", "w_start", "fired_at", "kind", "version", "n"]) == want
    assert {"early", "on time", "late"} == {row.split("'")[-2] for row in want}
