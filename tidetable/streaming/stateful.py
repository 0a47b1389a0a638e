"""Stateful processors for live streams, for per-key logic that Spark's own streaming operators cannot express.

A processor gets the records of one key as Arrow batches, computes on whole columns and keeps its state in the state store.
All records of a key go to one task, whatever their number: for keys that may hold a large
share of a stream take the micro-batch forms in `carry`, which give the same values. State may expire after ``ttl_ms`` without an update. Expiry runs on
processing time, for which Spark keeps scheduling batches, so such a query must be a standing one (`run.continuous`): a drain
would not end. `CarriedTotal` and `EmitOnChange` sort, and their rows are the closed windows of one key, not its records.

Nulls reach a processor as flags beside the values, made before the rows leave the JVM, so that a null differs from NaN and large
integers stay exact.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

# executors receive the processors by value, so they need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _masked(values: np.ndarray, given: np.ndarray) -> pd.Series:
    """Integers with nulls where there is no value."""
    return pd.Series(pd.arrays.IntegerArray(np.asarray(values, np.int64), ~np.asarray(given, bool)))


def _ordered(rows: Iterable[pd.DataFrame], by: str) -> pd.DataFrame:
    return pd.concat(list(rows), ignore_index=True).sort_values(by, kind="stable", ignore_index=True)


class _Processor(StatefulProcessor):
    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def close(self) -> None:
        pass


class RunningTotal(_Processor):
    """Every record with its key's total so far: ``key, seq, value, total``, from ``key, seq, amount, given``."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", "total bigint", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.total.get()
        total = held[0] if held else 0
        for frame in rows:
            amount = frame["amount"].to_numpy(np.int64)
            totals = total + np.cumsum(amount)
            total = int(totals[-1]) if len(totals) else total
            value = _masked(amount, frame["given"].to_numpy(bool))
            yield pd.DataFrame({"key": frame["key"], "seq": frame["seq"], "value": value, "total": totals})
        self.total.update((total,))


class Retracting(_Processor):
    """Sum per key as change-log ``op, key, step, total``; ``step`` numbers the records of a key."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("held", "step bigint, total bigint, given boolean", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.held.get()
        step, total, given = (held[0], held[1], held[2]) if held else (0, 0, False)
        for frame in rows:
            if not len(frame):
                continue
            new = total + np.cumsum(frame["amount"].to_numpy(np.int64))
            known = np.logical_or.accumulate(np.r_[given, frame["given"].to_numpy(bool)])
            old, was, known = np.r_[total, new[:-1]], known[:-1], known[1:]
            steps = step + 1 + np.arange(len(new))
            changed = (steps == 1) | (known != was) | (known & (new != old))
            # an old result in front of every new one, but for the first step of a key
            rows_of = np.repeat(np.flatnonzero(changed), 2)
            op = np.arange(len(rows_of)) % 2 == 1
            shown = op | (steps[rows_of] > 1)
            rows_of, op = rows_of[shown], op[shown]
            result = _masked(np.where(op, new[rows_of], old[rows_of]), np.where(op, known[rows_of], was[rows_of]))
            keys = frame["key"].iloc[rows_of].reset_index(drop=True)
            yield pd.DataFrame({"op": op, "key": keys, "step": steps[rows_of], "total": result})
            step, total, given = int(steps[-1]), int(new[-1]), bool(known[-1])
        self.held.update((step, total, given))


class CarriedTotal(_Processor):
    """Closed windows of a key with the total carried over from all earlier ones."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", "total bigint", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.total.get()
        frame = _ordered(rows, "w_start")
        totals = (held[0] if held else 0) + np.cumsum(frame["amount"].to_numpy(np.int64))
        yield pd.DataFrame({"key": frame["key"], "w_start": frame["w_start"], "w_end": frame["w_end"], "total": totals})
        self.total.update((int(totals[-1]),))


class EmitOnChange(_Processor):
    """Closed windows of a key whose value differs from the last one emitted; null and NaN equal themselves."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "value double, given boolean", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.last.get()
        frame = _ordered(rows, "w_start")
        value, given = frame["amount"].to_numpy(float), frame["given"].to_numpy(bool)
        before, was = np.r_[held[0] if held else 0.0, value[:-1]], np.r_[bool(held and held[1]), given[:-1]]
        same = (given == was) & (~given | (value == before) | (np.isnan(value) & np.isnan(before)))
        if held is None:
            same[0] = False
        changed = frame[~same].reset_index(drop=True)
        yield changed[["key", "w_start", "w_end", "amount", "given"]]
        self.last.update((float(value[-1]), bool(given[-1])))


class WindowTopK(StatefulProcessor):
    """The k largest counts per window end and share, emitted by an event-time timer one millisecond after the end.

    Only the best k rows are ever held. The window's end comes as a number of milliseconds, so that no zone or clock change
    is involved; items are of any type that orders.
    """

    def __init__(self, k: int = 5, item_type: str = "bigint"):
        self.k, self.item_type = k, item_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getListState("best", f"item {self.item_type}, n bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = [(r[0], r[1]) for r in (self.best.get() if self.best.exists() else ())]
        for frame in rows:
            few = frame.sort_values(["n", "item"], ascending=[False, True]).head(self.k)
            held += list(zip(few["item"].tolist(), few["n"].tolist()))
            held = sorted(held, key=lambda r: (-r[1], r[0]))[: self.k]
        self.best.put(held)
        self.handle.registerTimer(int(key[0]) + 1)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        rows = [(r[0], r[1]) for r in self.best.get()]
        self.best.clear()
        yield pd.DataFrame({"end": [int(key[0])] * len(rows), "item": [r[0] for r in rows], "n": [r[1] for r in rows]})

    def close(self) -> None:
        pass


def _process(df: DataFrame, processor: StatefulProcessor, schema: str, ttl_ms: int | None) -> DataFrame:
    """The processor over rows grouped by ``key``, with its value as ``amount`` and whether it is ``given``."""
    zero = F.lit(0).cast(df.schema["value"].dataType)
    flagged = df.withColumn("amount", F.coalesce("value", zero)).withColumn("given", F.col("value").isNotNull()).drop("value")
    mode = "processingTime" if ttl_ms else "none"
    return flagged.groupBy("key").transformWithStateInPandas(processor, schema, "append", mode)


def _keyed(df: DataFrame, key: str) -> DataFrame:
    return df.withColumnRenamed(key, "key")


def running_total(df: DataFrame, key: str, key_type: str = "string", ttl_ms: int | None = None) -> DataFrame:
    """`RunningTotal` over a stream with columns ``key, seq, value``, in the order the records come in."""
    schema = f"key {key_type}, seq bigint, value bigint, total bigint"
    rows = _keyed(df, key).withColumn("value", F.col("value").cast("long"))
    return _process(rows, RunningTotal(ttl_ms), schema, ttl_ms)


def retracting_sum(df: DataFrame, key: str, key_type: str = "string", ttl_ms: int | None = None) -> DataFrame:
    """`Retracting` over a stream with columns ``key, value``."""
    schema = f"op boolean, key {key_type}, step bigint, total bigint"
    rows = _keyed(df, key).withColumn("value", F.col("value").cast("long"))
    return _process(rows, Retracting(ttl_ms), schema, ttl_ms)


def carried_total(df: DataFrame, key: str, key_type: str = "string", ttl_ms: int | None = None) -> DataFrame:
    """`CarriedTotal` over closed windows ``key, w_start, w_end, value``."""
    schema = f"key {key_type}, w_start timestamp, w_end timestamp, total bigint"
    rows = _keyed(df, key).withColumn("value", F.col("value").cast("long"))
    return _process(rows, CarriedTotal(ttl_ms), schema, ttl_ms)


def emit_on_change(df: DataFrame, key: str, key_type: str = "string", ttl_ms: int | None = None) -> DataFrame:
    """`EmitOnChange` over closed windows ``key, w_start, w_end, value``."""
    schema = f"key {key_type}, w_start timestamp, w_end timestamp, amount double, given boolean"
    rows = _keyed(df, key).withColumn("value", F.col("value").cast("double"))
    changed = _process(rows, EmitOnChange(ttl_ms), schema, ttl_ms)
    # on the way back NaN has become null
    value = F.when(F.col("given"), F.coalesce("amount", F.lit(float("nan"))))
    return changed.select("key", "w_start", "w_end", value.alias("value"))


def window_top_k(df: DataFrame, window_end: str, k: int = 5, shares: int = 8) -> DataFrame:
    """Candidates for the top k per window of closed windows with columns ``item, n`` and the window's end.

    The items of a window are dealt into ``shares`` groups that keep their best k each, so one huge window spreads
    over many tasks; all groups of a window fire together, and `jobs.top_k_sink` ranks what is left of them.
    """
    item_type = df.schema["item"].dataType.simpleString()
    dealt = df.select(
        F.unix_millis(window_end).alias("__end"), F.pmod(F.xxhash64("item"), F.lit(shares)).alias("__share"), window_end, "item", "n"
    )
    best = dealt.groupBy("__end", "__share").transformWithStateInPandas(
        WindowTopK(k, item_type), f"end bigint, item {item_type}, n bigint", "append", "eventTime"
    )
    return best.select(F.timestamp_millis("end").alias("w_end"), "item", "n")
