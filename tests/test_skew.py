"""Hot keys cut into blocks give the same rows as plain loops over the input."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidetable.operators import changelog, custom, joins, ordered, running
from tidetable.plans import tables

WIDTH = 5
START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def records():
    """A third of the rows under one key, one more hot key, a hot null key, many cold ones; some values null."""
    rng = random.Random(7)
    keys = ["hot"] * 60 + ["warm"] * 20 + [None] * 20 + [f"k{i % 40}" for i in range(80)]
    rng.shuffle(keys)
    rows = []
    for seq, key in enumerate(keys):
        ts = START + timedelta(seconds=rng.randrange(0, 40))
        rows.append((key, seq * 3, ts, rng.choice([None, 0, 1, 2, 5]), f"v{rng.randrange(4)}"))
    return rows


@pytest.fixture(scope="module")
def frame(spark, records):
    df = spark.createDataFrame(records, "k string, seq bigint, ts timestamp, v bigint, visitor string")
    return df.repartition(7, F.xxhash64("seq")).persist()


def ordered_by(records, field):
    return sorted(records, key=lambda r: r[field])


def test_running_total_with_and_without_opening(spark, records, frame):
    opening = spark.createDataFrame([("hot", 100), ("k1", 7), (None, 1000)], "k string, total bigint")
    for start, totals in ((None, {}), (opening, {"hot": 100, "k1": 7, None: 1000})):
        want = {}
        run = dict(totals)
        for k, seq, _, v, _ in records:
            run[k] = run.get(k, 0) + (v or 0)
            want[seq] = run[k]
        got = running.running_total(frame, ["k"], "v", "seq", opening=start, width=WIDTH)
        assert {r["seq"]: r["total"] for r in got.collect()} == want
        closing = running.closing_totals(frame, ["k"], "v", opening=start)
        assert {r["k"]: r["total"] for r in closing.collect()} == run


def test_page_view_panes(records, frame):
    seen, pv, want = {}, {}, {}
    for k, seq, ts, _, visitor in records:
        place = (k, ts.second // 10)
        seen.setdefault(place, set()).add(visitor)
        pv[place] = pv.get(place, 0) + 1
        want[seq] = (pv[place], len(seen[place]))
    got = running.pv_uv_panes(frame, "ts", ["k"], "visitor", "seq", "10 seconds", width=WIDTH)
    rows = got.collect()
    assert len(rows) == len(records)
    # a null key's first sightings count like any other
    assert {r["seq"]: (r["pv"], r["uv"]) for r in rows} == want


def test_average_panes_and_emission_on_change(records, frame):
    sums, want, last, changed = {}, {}, {}, set()
    for k, seq, ts, v, _ in records:
        s, n = sums.get((k, ts.second // 10), (0, 0))
        sums[k, ts.second // 10] = s, n = s + (v or 0), n + (v is not None)
        want[seq] = s / n if n else None
        if k not in last or last[k] != want[seq]:
            changed.add(seq)
        last[k] = want[seq]
    panes = running.average_panes(frame, "ts", ["k"], "v", "seq", "10 seconds", width=WIDTH)
    assert {r["seq"]: r["avg"] for r in panes.collect()} == want
    kept = running.emit_on_change(panes, ["k"], "seq", "avg", WIDTH)
    assert {r["seq"] for r in kept.collect()} == changed


def test_carried_totals_and_changed_averages_over_windows(records, frame):
    windows = {}
    for k, _, ts, v, _ in records:
        windows.setdefault((k, ts.second), []).append(v)
    totals, run, changes, last = {}, {}, set(), {}
    for (k, second), held in sorted(windows.items(), key=lambda w: w[0][1]):
        known = [v for v in held if v is not None]
        run[k] = run.get(k, 0) + sum(known)
        totals[k, second] = run[k]
        average = sum(known) / len(known) if known else None
        if k not in last or last[k] != average:
            changes.add((k, second))
        last[k] = average
    got = running.carried_total(frame, "ts", ["k"], "v", "1 second", width=WIDTH)
    assert {(r["k"], r["w_start"].second): r["total"] for r in got.collect()} == totals
    kept = running.changed_window_averages(frame, "ts", ["k"], "v", "1 second", width=WIDTH)
    assert {(r["k"], r["w_start"].second) for r in kept.collect()} == changes


def test_over_range(records, frame):
    want = {
        seq: sum(r[3] or 0 for r in records if r[0] == k and r[2] <= ts) for k, seq, ts, _, _ in records
    }
    got = running.over_range(frame, "ts", ["k"], "v", width=WIDTH)
    assert {r["seq"]: r["total"] for r in got.collect()} == want


@pytest.mark.parametrize("unchanged", [False, True])
def test_changelog(records, frame, unchanged):
    held, want = {}, set()
    for k, seq, _, v, visitor in records:
        old = held.get(k)
        total, n, seen = old or (None, 0, frozenset())
        new = (total if v is None else (total or 0) + v, n + (v is not None), seen | {visitor})
        before = old and (old[0], old[1], len(old[2]))
        after = (new[0], new[1], len(new[2]))
        if unchanged or before != after:
            if old:
                want.add((False, k, seq, *before))
            want.add((True, k, seq, *after))
        held[k] = new
    measures = {"total": ("sum", "v"), "n": ("count", "v"), "uv": ("count_distinct", "visitor")}
    log = changelog.aggregate_changelog(frame, ["k"], "seq", measures, unchanged, width=WIDTH)
    rows = [tuple(r) for r in log.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want
    table = changelog.apply_changelog(log, ["k"], "seq").collect()
    assert {r["k"]: (r["total"], r["n"], r["uv"]) for r in table} == {k: (t, n, len(s)) for k, (t, n, s) in held.items()}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_panes(records, frame, how):
    sides = {"v0": [], "v1": []}
    for k, seq, ts, _, visitor in records:
        if k is not None and visitor in sides:
            sides[visitor].append((k, seq, ts.second // 10))
    arrivals = sides["v0"] + sides["v1"]
    want = []
    for k, seq, w in arrivals:
        lefts = [a for a in sides["v0"] if a[0] == k and a[2] == w and a[1] <= seq]
        rights = [b for b in sides["v1"] if b[0] == k and b[2] == w and b[1] <= seq]
        pane = sum(1 for a in arrivals if a[0] == k and a[2] == w and a[1] <= seq)
        for a in lefts:
            want += [(a[1], b[1], pane) for b in rights]
            if how == "left" and not rights:
                want.append((a[1], None, pane))
    keyed = frame.where("k is not null")
    left = keyed.where("visitor = 'v0'").select("k", "seq", F.col("ts").alias("l_ts"))
    right = keyed.where("visitor = 'v1'").select("k", "seq", F.col("ts").alias("r_ts"))
    panes = joins.window_join_panes(left, right, "k", "l_ts", "r_ts", "seq", "10 seconds", how, width=WIDTH)
    got = [(r["seq"], r["right_seq"], r["pane"]) for r in joins.expand_panes(panes).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_joins_equal_plain_ones(frame, how):
    left = frame.where("visitor = 'v0'").select("k", "seq", F.col("ts").alias("l_ts"))
    right = frame.where("visitor = 'v1'").select("k", F.col("seq").alias("r_seq"), F.col("ts").alias("r_ts"))
    plain, salted = [
        joins.window_join(left, right, "k", "l_ts", "r_ts", "10 seconds", how, salts=n).collect() for n in (1, 5)
    ]
    assert sorted(plain, key=str) == sorted(salted, key=str) and plain
    near, dealt = [
        joins.interval_join(left, right, "k", "l_ts", "r_ts", "7 seconds", bucketed=b, salts=n).collect()
        for b, n in ((False, 1), (True, 4))
    ]
    assert sorted(near, key=str) == sorted(dealt, key=str) and near


def test_changelog_goes_on_from_a_state(frame):
    measures = {"total": ("sum", "v"), "n": ("count", "*")}
    whole = changelog.aggregate_changelog(frame, ["k"], "seq", measures, width=WIDTH).collect()
    parts, state = [], None
    for condition in ("seq < 150", "seq >= 150 and seq < 300", "seq >= 300"):
        part = frame.where(condition)
        log = changelog.aggregate_changelog(part, ["k"], "seq", measures, opening=state, width=WIDTH)
        parts += log.collect()
        state = changelog.closing_state(part, ["k"], "seq", measures, state)
    assert sorted(parts, key=str) == sorted(whole, key=str)
    with pytest.raises(ValueError):
        changelog.closing_state(frame, ["k"], "seq", {"uv": ("count_distinct", "visitor")})


def test_user_accumulators_pass_on_what_they_cannot_hold(records, frame):
    def accumulate(pdf):
        return pdf.groupby("k", as_index=False, dropna=False).agg(top=("seq", "max"), n=("seq", "count"))

    def merge(accumulators):
        return accumulators.groupby("k", as_index=False, dropna=False).agg(top=("top", "max"), n=("n", "sum"))

    want = {}
    for k, seq, *_ in records:
        top, n = want.get(k, (0, 0))
        want[k] = max(top, seq), n + 1
    for held in (2, 1000):
        got = custom.user_aggregate(frame.select("k", "seq"), ["k"], accumulate, merge, "k string, top bigint, n bigint", held)
        rows = got.collect()
        assert len(rows) == len(want) and {r["k"]: (r["top"], r["n"]) for r in rows} == want


def test_no_window_group_is_wider_than_a_block(spark):
    """Even when one key holds all rows, with dense numbers and with sparse ones."""
    for spread in (1, 1 << 30):
        df = spark.range(10_000).select(F.lit("hot").alias("k"), (F.col("id") * spread).alias("seq"), F.lit(1).alias("v"))
        placed = ordered._placed(df, ["k"], "seq", 256)
        assert placed.groupBy("__key", "__block").count().agg(F.max("count")).first()[0] <= 256
        blocks = placed.select("__key", "__large", "__block").distinct()
        assert blocks.groupBy("__key", "__large").count().agg(F.max("count")).first()[0] <= 256
        total = running.running_total(df, ["k"], "v", "seq", width=256)
        assert total.where(F.col("total") * spread != F.col("seq") + spread).count() == 0


def test_decimals_keep_their_scale(spark):
    rows = [("a", i, Decimal("1.0123456789") * i) for i in range(1, 9)] + [("a", 9, None)]
    for kind in ("decimal(12,10)", "decimal(30,10)", "decimal(38,10)"):
        df = spark.createDataFrame(rows, "k string, seq bigint, v decimal(12,10)").withColumn("v", F.col("v").cast(kind))
        want, run = {}, Decimal(0)
        for _, seq, v in rows:
            run += v or 0
            want[seq] = run
        got = running.running_total(df, ["k"], "v", "seq", width=WIDTH)
        assert {r["seq"]: r["total"] for r in got.collect()} == want
        log = changelog.aggregate_changelog(df, ["k"], "seq", {"total": ("sum", "v")}, width=WIDTH).collect()
        assert {r["seq"]: r["total"] for r in log if r["op"]} == {s: t for s, t in want.items() if s < 9}
        assert {r["seq"]: r["total"] for r in log if not r["op"]} == {s: want[s - 1] for s in range(2, 9)}


def test_types_stay_when_input_goes_on(spark):
    """With an int arrival number results of the first and of later batches have one schema."""
    df = spark.createDataFrame([("a", 1, 5), ("b", 2, 6)], "k string, seq int, v int")
    measures = {"total": ("sum", "v"), "n": ("count", "*")}
    first = running.closing_totals(df, ["k"], "v")
    state = changelog.closing_state(df, ["k"], "seq", measures)
    pairs = [
        (running.running_total(df, ["k"], "v", "seq"), running.running_total(df, ["k"], "v", "seq", opening=first)),
        (first, running.closing_totals(df, ["k"], "v", opening=first)),
        (changelog.aggregate_changelog(df, ["k"], "seq", measures), changelog.aggregate_changelog(df, ["k"], "seq", measures, opening=state)),
        (state, changelog.closing_state(df, ["k"], "seq", measures, state)),
    ]
    for one, two in pairs:
        assert [(f.name, f.dataType) for f in one.schema] == [(f.name, f.dataType) for f in two.schema]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_rows_without_a_time_come_first(spark, kind):
    rows = [("a", None, 1), ("a", datetime(2024, 1, 2), 10), ("a", datetime(2024, 1, 2), 100), ("a", None, None), (None, None, 7), ("a", datetime(1969, 5, 1), 4)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, v bigint").withColumn("ts", F.col("ts").cast(kind))
    got = sorted((str(r["k"]), str(r["v"]), r["total"]) for r in running.over_range(df, "ts", ["k"], "v", width=WIDTH).collect())
    assert got == [("None", "7", 7), ("a", "1", 1), ("a", "10", 115), ("a", "100", 115), ("a", "4", 5), ("a", "None", 1)]


def test_left_join_panes_keep_rows_of_null_keys(spark):
    rows = [(None, 1, START, "l"), ("a", 2, START, "l"), ("a", 4, START, "l"), (None, 6, START, "l")]
    left = spark.createDataFrame(rows, "k string, seq bigint, lt timestamp, l string")
    right = spark.createDataFrame([("a", 3, START, 5), (None, 5, START, 6)], "k string, seq bigint, rt timestamp, r bigint")
    panes = joins.window_join_panes(left, right, "k", "lt", "rt", "seq", "1 day", "left", width=WIDTH)
    got = sorted((str(r["k"]), r["seq"], str(r["right_seq"]), r["first_pane"], r["fires"]) for r in panes.collect())
    # the null group has three arrivals, the other three as well
    assert got == [("None", 1, "None", 1, 3), ("None", 6, "None", 3, 1), ("a", 2, "3", 2, 2), ("a", 2, "None", 1, 1), ("a", 4, "3", 3, 1)]


def test_products_are_refused(spark):
    a, b = spark.range(3).toDF("x"), spark.range(3).toDF("y")
    assert joins.cross_where(a, b, "x = y").count() == 3
    with pytest.raises(ValueError, match="equality"):
        joins.cross_where(a, b, "x < y")


def test_wall_clocks_ignore_the_sessions_zone(spark):
    sibling = spark.newSession()
    sibling.conf.set("spark.sql.session.timeZone", "America/New_York")
    # both sides of the hour that clocks there show twice, and before the epoch
    seconds = [1730611800, 1730615400, 1710054000, -86400 * 365]
    df = sibling.createDataFrame([(s,) for s in seconds], "s bigint").withColumn("ts", F.timestamp_seconds("s"))
    df = df.withColumn("wall", tables.utc_wall("ts"))
    texts = [str(r[0]) for r in df.select(F.col("wall").cast("string")).collect()]
    assert texts == [str(datetime(1970, 1, 1) + timedelta(seconds=s)) for s in seconds]
    assert df.where(tables.utc_instant("wall") != F.col("ts")).count() == 0


def test_dates_of_a_key_fall_into_many_blocks(spark):
    days = spark.range(100).selectExpr("1 AS k", "date_add(DATE'2024-01-01', CAST(id AS INT)) AS d", "id AS v")
    placed = ordered._placed(days, ["k"], "d", ordered.BLOCK_WIDTH)
    assert placed.select(ordered._BLOCK).distinct().count() == 100
