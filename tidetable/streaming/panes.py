"""Windows of a stream that give results before they close: at every record, or in a rhythm.

The state of a window lies in a `StateTable` with the window as its period: a micro-batch reads and writes the buckets
of the windows it touches, and windows behind the watermark leave as a whole. The watermark of a batch is the highest
event time of the batches before it, less the delay; rows of windows that ended by then are late and dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidetable.functions import timewin
from tidetable.operators import ordered, running
from tidetable.streaming.carry import AT, Retention, Visitors, attached, kept
from tidetable.streaming.sinks import BATCH
from tidetable.streaming.state_table import BUCKETS, StateTable, same_keys


def _placed(rows: DataFrame, ts: str, size: str) -> DataFrame:
    """Rows with their window's bounds; the start, as microseconds, is the period of the state."""
    stamped = timewin.assign(rows, ts, size).select("*", *timewin.bounds(size)).drop("w")
    return stamped.withColumn(AT, F.unix_micros(F.col("w_start").cast("timestamp")))


def average_panes_sink(
    path: str,
    state: str,
    ts: str,
    keys: Sequence[str],
    value: str,
    seq: str,
    size: str,
    delay: str = "0 seconds",
    into: str = "avg",
    buckets: int = BUCKETS,
):
    """Write every record with the average of its key and window so far to ``path/batch=<id>``."""
    retention, groups = Retention(ts, size, delay), [*keys, "w_start", "w_end"]

    def write(batch: DataFrame, batch_id: int) -> None:
        table = StateTable(batch.sparkSession, state, groups, F.col(AT), buckets=buckets)
        if table.has(batch_id):
            return
        before = table.version(batch_id)
        with (
            kept(_placed(retention.timely(batch, before), ts, size)) as records,
            kept(table.opening(records, batch_id)) as opening,
        ):
            shown = running.running_average(records, groups, value, seq, into, opening=opening)
            shown.drop(AT).write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")
            kind = ordered.sum_type(records, F.col(value))
            amount = F.coalesce(F.col(value).cast(kind), F.lit(0).cast(kind))
            amounts = records.select(*groups, AT, amount.alias("total"), F.col(value).isNotNull().cast("long").alias("n"))
            amounts = amounts if opening is None else amounts.unionByName(opening)
            closing = amounts.groupBy(*groups, AT).agg(F.sum("total").cast(kind).alias("total"), F.sum("n").alias("n"))
            high = retention.high(records, before)
            table.commit(batch_id, closing, high, retention.oldest(high))

    return attached(write)


def pv_uv_panes_sink(
    path: str,
    state: str,
    ts: str,
    keys: Sequence[str],
    visitor: str,
    seq: str,
    size: str,
    delay: str = "0 seconds",
    buckets: int = BUCKETS,
):
    """Write every record with the page views and exact unique visitors of its key and window so far."""
    retention, groups = Retention(ts, size, delay), [*keys, "w_start", "w_end"]

    def write(batch: DataFrame, batch_id: int) -> None:
        held = Visitors(batch.sparkSession, state, groups, visitor, retention, buckets)
        if held.totals.has(batch_id):
            return
        with (
            kept(_placed(retention.timely(batch, held.totals.version(batch_id)), ts, size)) as records,
            kept(held.firsts(records, seq, batch_id)) as firsts,
            kept(held.totals.opening(records, batch_id)) as opening,
        ):
            shown = running.running_counts(records, [*groups, AT], visitor, seq, opening=opening, firsts=firsts)
            shown.drop(AT).write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")
            held.commit(batch_id, records, firsts, held.counts(records, firsts, opening))

    return attached(write)


SIDE, PANE, FROM = "__left", "__pane", "first_pane"


def tagged(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, seq: str, ts: str = "ts") -> DataFrame:
    """Both inputs of a join as one stream: ``key, ts, seq`` and the other columns of each side, null on the other one.

    ``seq`` numbers the arrivals of both; the right side's is kept as ``right_<seq>`` too.
    """
    a = left.select(F.lit(True).alias(SIDE), F.col(left_ts).alias(ts), *left.columns)
    b = right.select(F.lit(False).alias(SIDE), F.col(right_ts).alias(ts), F.col(seq).alias(f"right_{seq}"), *right.columns)
    return a.unionByName(b, allowMissingColumns=True)


def join_panes_sink(
    path: str,
    state: str,
    key: str,
    left: Sequence[str],
    right: Sequence[str],
    seq: str,
    size: str,
    how: str = "inner",
    zero_time: Sequence[str] = (),
    delay: str = "0 seconds",
    ts: str = "ts",
    buckets: int = BUCKETS,
):
    """Window join of a `tagged` stream that fires at every arrival and emits again all pairs its key and window hold.

    Every micro-batch writes, per pair (or left row without a right one) of the windows it touches, ``first_pane``: the first
    arrival of this batch that emits it, counted within key and window, and ``fires``: how many arrivals of this batch
    do. `emitted_panes` adds batches up. ``left`` and ``right`` name the columns of either side that are returned,
    without the key; both sides are held until their window ends.
    """
    retention, groups = Retention(ts, size, delay), [key, "w_start"]

    def write(batch: DataFrame, batch_id: int) -> None:
        table = StateTable(batch.sparkSession, state, groups, F.col(AT), plain=True, buckets=buckets)
        if table.has(batch_id):
            return
        before = table.version(batch_id)
        with (
            kept(_placed(retention.timely(batch, before), ts, size)) as records,
            kept(_numbered(records, table.opening(records, batch_id), groups, seq)) as arrivals,
        ):
            shown = _fired(arrivals, groups, key, left, right, how, zero_time)
            shown.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")
            high = retention.high(records, before)
            table.commit(batch_id, arrivals.where("__new").drop("__new"), high, retention.oldest(high))

    return attached(write)


def _numbered(records: DataFrame, held: DataFrame | None, groups: Sequence[str], seq: str) -> DataFrame:
    """New arrivals, numbered on behind those that their key and window hold, and these."""
    fresh = ordered.running_sums(records, groups, seq, {PANE: F.lit(1).cast("long")}).withColumn("__new", F.lit(True))
    if held is None:
        return fresh
    ahead = held.groupBy(*groups).agg(F.count("*").alias("__ahead")).withColumnsRenamed({c: f"__{c}" for c in groups})
    moved = fresh.join(ahead, same_keys(groups), "left").drop(*[f"__{c}" for c in groups])
    moved = moved.withColumn(PANE, F.col(PANE) + F.coalesce("__ahead", F.lit(0))).drop("__ahead")
    return moved.unionByName(held.withColumn("__new", F.lit(False)))


def _fired(arrivals: DataFrame, groups: Sequence[str], key: str, left, right, how: str, zero_time: Sequence[str]) -> DataFrame:
    """What the new ones among the numbered arrivals emit."""
    spans = arrivals.groupBy(*groups).agg(
        F.min(F.when(F.col("__new"), F.col(PANE))).alias("__from"),
        F.max(PANE).alias("__to"),
        F.min(F.when(~F.col(SIDE), F.col(PANE))).alias("__match"),
    )
    spans = spans.withColumnsRenamed({c: f"__{c}" for c in groups})
    a = arrivals.where(SIDE).join(spans, same_keys(groups)).select(*groups, "w_end", *left, PANE, "__from", "__to", "__match")
    b = arrivals.where(f"not {SIDE}").select(*groups, *right, F.col(PANE).alias("__right_pane"))
    first = F.greatest(PANE, "__right_pane", "__from")
    columns = [key, "w_start", "w_end", *left]
    pairs = a.join(b, list(groups)).select(*columns, *right, first.alias(FROM), (F.col("__to") - first + 1).alias("fires"))
    if how == "inner":
        return pairs
    first = F.greatest(PANE, "__from")
    # rows of a null key match nothing
    until = F.when(F.col(key).isNull(), F.col("__to")).otherwise(F.coalesce(F.col("__match") - 1, F.col("__to")))
    alone = a.select(*columns, first.alias(FROM), (until - first + 1).alias("fires")).where("fires > 0")
    both = pairs.unionByName(alone, allowMissingColumns=True)
    return both.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in zero_time})


def emitted_panes(batches: DataFrame) -> DataFrame:
    """All emissions of `join_panes_sink`, one row per pair: ``first_pane`` and ``fires`` of the whole window."""
    rows = [c for c in batches.columns if c not in (FROM, "fires", BATCH)]
    return batches.groupBy(*rows).agg(F.min(FROM).alias(FROM), F.sum("fires").alias("fires"))


def firing_sink(
    path: str,
    state: str,
    ts: str,
    arrival: str,
    keys: Sequence[str],
    size: str,
    early: str,
    late: str,
    lateness: str,
    buckets: int = BUCKETS,
):
    """Counts per key and tumbling window as versions that fire in two rhythms of the arrival clock.

    Until a window ends it fires every ``early`` (at whole multiples of it) and at its end, afterwards every ``late``, if records have come
    since. A firing happens when the clock, the highest arrival time of the batches so far, has reached it, so
    results do not depend on where batches are cut. Rows: ``keys, w_start, w_end, fired_at, kind, version, n``; kind is
    ``early``, ``on time`` or ``late``, n counts all records of the window so far. A window leaves the state ``lateness``
    after its end on the clock; records that arrive later are dropped.
    """
    groups, length = [*keys, "w_start", "w_end"], timewin.micros_of(size)
    rhythm = {name: F.lit(timewin.micros_of(t)) for name, t in (("early", early), ("late", late))}
    allowed = timewin.micros_of(lateness)

    def micros(column: str):
        return F.unix_micros(F.col(column).cast("timestamp"))

    def next_tick(name: str):
        return -F.floor(-micros(arrival) / rhythm[name]).cast("long") * rhythm[name]

    def write(batch: DataFrame, batch_id: int) -> None:
        table = StateTable(batch.sparkSession, state, groups, F.col(AT), buckets=buckets)
        if table.has(batch_id):
            return
        before = table.version(batch_id)
        end = F.col(AT) + length
        timely = _placed(batch, ts, size).where(micros(arrival) <= end + allowed)
        at = F.when(micros(arrival) <= end, F.least(next_tick("early"), end)).otherwise(next_tick("late"))
        with kept(timely.groupBy(*groups, AT, at.alias("__tick")).agg(F.count("*").alias("n"))) as ticks:
            top = batch.agg(F.max(micros(arrival))).first()[0]
            clock = max([t for t in (top, before.high if before else None) if t is not None], default=0)
            opening = table.opening(ticks, batch_id)
            if before and (waiting := table.read(before)) is not None:
                # windows without new records may have a firing that has become due
                due = waiting.where((F.col("__tick") <= clock) & (F.col("pending") > 0))
                opening = due if opening is None else opening.unionByName(due).distinct()
            with kept(_versions(ticks, opening, [*groups, AT], clock)) as run:
                kind = F.when(F.col("__tick") < end, "early").when(F.col("__tick") == end, "on time").otherwise("late")
                shown = run.where("__fires").select(
                    *groups, F.timestamp_micros("__tick").alias("fired_at"), kind.alias("kind"), "version", F.col("total").alias("n")
                )
                shown.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")
                fired = F.max(F.when(F.col("__tick") <= clock, F.col("total")))
                closing = run.groupBy(*groups, AT).agg(
                    F.max("__tick").alias("__tick"),
                    F.coalesce(fired, F.lit(0).cast("long")).alias("n"),
                    F.max("total").alias("__all"),
                    F.max("version").alias("fired"),
                )
                closing = closing.select(*groups, AT, "__tick", "n", (F.col("__all") - F.col("n")).alias("pending"), "fired")
                table.commit(batch_id, closing, clock, clock - allowed - length - timewin.micros_of(late))

    return attached(write)


def _versions(ticks: DataFrame, opening: DataFrame | None, groups: Sequence[str], clock: int) -> DataFrame:
    """Counts so far at every tick: new records, those that waited for their tick, and what had fired before in front."""
    none = F.lit(0).cast("long")
    steps = ticks.select(*groups, "__tick", "n", none.alias("fired"))
    if opening is not None:
        done = opening.select(*groups, F.lit(ordered.BEFORE_ALL).alias("__tick"), "n", "fired")
        waiting = opening.where("pending > 0").select(*groups, "__tick", F.col("pending").alias("n"), none.alias("fired"))
        steps = steps.unionByName(done).unionByName(waiting)
    steps = steps.groupBy(*groups, "__tick").agg(F.sum("n").alias("n"), F.sum("fired").alias("fired"))
    fires = (F.col("__tick") > ordered.BEFORE_ALL) & (F.col("__tick") <= clock) & (F.col("n") > 0)
    version = F.when(fires, F.lit(1).cast("long")).otherwise(F.col("fired"))
    return ordered.running_sums(steps.withColumn("__fires", fires), groups, "__tick", {"total": F.col("n"), "version": version})
