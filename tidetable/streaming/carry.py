"""Values of a stream that go on from micro-batch to micro-batch, computed with bounded-table operators.

Every micro-batch is a bounded table in which values run in order of the arrival number, hot keys split over many tasks.
It starts from the state of its own keys and leaves their new state behind (`state_table`), so a batch costs what it
changes. A batch that is tried again finds its starting state unchanged; one whose state is there already is done.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidetable.functions import timewin
from tidetable.operators import changelog, running
from tidetable.operators.running import first_sightings
from tidetable.streaming.sinks import BATCH
from tidetable.streaming.state_table import BUCKETS, Manifest, StateTable

Step = Callable[[DataFrame, DataFrame | None], DataFrame]


def attached(write: Callable[[DataFrame, int], None]):
    def attach(writer: DataStreamWriter) -> DataStreamWriter:
        return writer.foreachBatch(write)

    return attach


@contextmanager
def kept(rows: DataFrame | None) -> Iterator[DataFrame | None]:
    """Rows that several steps of a micro-batch read, computed once."""
    held = None if rows is None else rows.persist()
    try:
        yield held
    finally:
        if held is not None:
            held.unpersist()


def _continued(path: str, state: str, keys: Sequence[str], result: Step, closing: Step, buckets: int):
    """Sink that writes ``result(batch, opening)`` to ``path/batch=<id>`` and keeps ``closing(batch, opening)`` per key."""

    def write(batch: DataFrame, batch_id: int) -> None:
        table = StateTable(batch.sparkSession, state, keys, buckets=buckets)
        if table.has(batch_id):
            return
        with kept(batch) as records, kept(table.opening(records, batch_id)) as opening:
            result(records, opening).write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")
            table.commit(batch_id, closing(records, opening))

    return attached(write)


def running_total_sink(
    path: str, state: str, keys: Sequence[str], value: str, seq: str, into: str = "total", buckets: int = BUCKETS
):
    """Write every record with its key's total so far to ``path/batch=<id>``."""
    return _continued(
        path,
        state,
        keys,
        lambda batch, opening: running.running_total(batch, keys, value, seq, into, opening),
        lambda batch, opening: running.closing_totals(batch, keys, value, into, opening),
        buckets,
    )


def carried_total_sink(
    path: str,
    state: str,
    keys: Sequence[str],
    value: str,
    into: str = "total",
    shown: Callable[[DataFrame], DataFrame] = lambda totals: totals,
    buckets: int = BUCKETS,
):
    """Write the closed windows of a stream (``keys, w_start, w_end, value``) with the total of all windows so far.

    ``shown`` may turn the rows into what is to be written.
    """

    def result(batch: DataFrame, opening: DataFrame | None) -> DataFrame:
        sums = batch.select(*keys, "w_start", "w_end", F.col(value).alias("__value"))
        return shown(running.running_total(sums, keys, "__value", "w_start", into, opening).drop("__value"))

    def closing(batch: DataFrame, opening: DataFrame | None) -> DataFrame:
        return running.closing_totals(batch.select(*keys, F.col(value).alias("__value")), keys, "__value", into, opening)

    return _continued(path, state, keys, result, closing, buckets)


def emit_on_change_sink(path: str, state: str, keys: Sequence[str], value: str, buckets: int = BUCKETS):
    """Write the closed windows (``keys, w_start, w_end, value``) whose value differs from the key's window before.

    Null and NaN are values like others: each equals itself.
    """
    return _continued(
        path,
        state,
        keys,
        lambda batch, opening: running.emit_on_change(batch, keys, "w_start", value, opening=opening),
        lambda batch, opening: running.last_values(batch, keys, "w_start", value),
        buckets,
    )


def changelog_sink(
    path: str, state: str, keys: Sequence[str], seq: str, measures: changelog.Measures, buckets: int = BUCKETS
):
    """Write the change-log of sums and counts per key to ``path/batch=<id>``."""
    return _continued(
        path,
        state,
        keys,
        lambda batch, opening: changelog.aggregate_changelog(batch, keys, seq, measures, opening=opening),
        lambda batch, opening: changelog.closing_state(batch, keys, seq, measures, opening),
        buckets,
    )


class Retention:
    """How long state stays: periods of event time, ``keep`` behind the highest time seen.

    A row's period is the tumbling window of ``size`` that its time ``ts`` lies in, and has to be fixed by its keys (an hour
    label, a window). Rows of a period that is gone already are late and dropped, as behind a watermark; the highest time
    counts as of the batch before.
    """

    def __init__(self, ts: str, size: str, keep: str):
        self.ts, self.size, self.keep = ts, timewin.micros_of(size), timewin.micros_of(keep)

    @property
    def period(self) -> Column:
        """The start of the period, in microseconds."""
        micros = F.unix_micros(F.col(self.ts).cast("timestamp"))
        return micros - F.pmod(micros, F.lit(self.size))

    def oldest(self, high: int | None) -> int | None:
        """The least start of a period whose end lies behind ``keep`` before the highest time."""
        return None if high is None else ((high - self.keep) // self.size) * self.size

    def timely(self, rows: DataFrame, before: Manifest | None) -> DataFrame:
        oldest = self.oldest(before.high) if before else None
        return rows if oldest is None else rows.where(F.coalesce(self.period >= oldest, F.lit(True)))

    def high(self, rows: DataFrame, before: Manifest | None) -> int | None:
        """The highest time after these rows."""
        top = rows.agg(F.max(F.unix_micros(F.col(self.ts).cast("timestamp")))).first()[0]
        known = [t for t in (top, before.high if before else None) if t is not None]
        return max(known, default=None)


#: The column that holds the period in stored state
AT = "__at"


class Visitors:
    """Stored state of records and distinct visitors per key: totals in one table, the visitors seen in another."""

    def __init__(self, spark, state: str, keys: Sequence[str], visitor: str, retention: Retention | None, buckets: int):
        self.keys, self.visitor, self.retention = list(keys), visitor, retention
        at = F.col(AT)
        self.totals = StateTable(spark, f"{state}/totals", keys, at, buckets=buckets)
        self.seen = StateTable(spark, f"{state}/seen", [*keys, visitor], at, plain=True, buckets=buckets)

    def timely(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """The batch's rows that are not late, with their period."""
        rows = batch
        if self.retention:
            rows = self.retention.timely(batch, self.totals.version(batch_id))
        period = self.retention.period if self.retention else F.lit(0).cast("long")
        return rows.withColumn(AT, F.coalesce(period, F.lit(0).cast("long")))

    def firsts(self, records: DataFrame, seq: str, batch_id: int) -> DataFrame:
        """``keys, visitor, seq`` and period of visitors that no earlier batch has seen."""
        known = records.where(F.col(self.visitor).isNotNull())
        seen = self.seen.opening(known, batch_id, exact=False)
        return first_sightings(records, [*self.keys, AT], self.visitor, seq, seen)

    def counts(self, records: DataFrame, firsts: DataFrame, opening: DataFrame | None) -> DataFrame:
        """``keys``, period, ``pv`` and ``uv`` after these records."""
        grouped, none, one = [*self.keys, AT], F.lit(0).cast("long"), F.lit(1).cast("long")
        parts = records.select(*grouped, one.alias("pv"), none.alias("uv"))
        parts = parts.unionByName(firsts.select(*grouped, none.alias("pv"), one.alias("uv")))
        parts = parts if opening is None else parts.unionByName(opening.select(*grouped, "pv", "uv"))
        return parts.groupBy(*grouped).agg(F.sum("pv").alias("pv"), F.sum("uv").alias("uv"))

    def commit(self, batch_id: int, records: DataFrame, firsts: DataFrame, closing: DataFrame) -> None:
        """The totals last: they tell that the batch is done."""
        high = drop = None
        if self.retention:
            high = self.retention.high(records, self.totals.version(batch_id))
            drop = self.retention.oldest(high)
        self.seen.commit(batch_id, firsts.select(*self.keys, self.visitor, AT), high, drop)
        self.totals.commit(batch_id, closing, high, drop)


def visitors_changelog_sink(
    path: str,
    state: str,
    keys: Sequence[str],
    seq: str,
    visitor: str,
    pv: str = "pv",
    uv: str = "uv",
    retention: Retention | None = None,
    buckets: int = BUCKETS,
):
    """Write the change-log of records and distinct visitors per key to ``path/batch=<id>``.

    A batch reads the visitors of the buckets and periods that its own records touch, and adds those it sees first. With a
    ``retention`` old periods leave the state, and what comes for them later is dropped. Records of equal numbers are
    one step, and a visitor counts once whatever the repetition.
    """
    measures = {pv: ("count", "*"), uv: ("count_distinct", visitor)}

    def write(batch: DataFrame, batch_id: int) -> None:
        held = Visitors(batch.sparkSession, state, keys, visitor, retention, buckets)
        if held.totals.has(batch_id):
            return
        with (
            kept(held.timely(batch, batch_id)) as records,
            kept(held.firsts(records, seq, batch_id)) as firsts,
            kept(held.totals.opening(records, batch_id)) as opening,
        ):
            grouped = [*keys, AT]
            log = changelog.aggregate_changelog(records, grouped, seq, measures, opening=opening, firsts=firsts)
            log.drop(AT).write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")
            closing = changelog.closing_state(records, grouped, seq, measures, opening, firsts)
            held.commit(batch_id, records, firsts, closing)

    return attached(write)


def visitors_sink(
    path: str,
    state: str,
    keys: Sequence[str],
    visitor: str,
    retention: Retention | None = None,
    buckets: int = BUCKETS,
):
    """Write ``keys, pv, uv`` of the keys that a micro-batch changed to ``path/batch=<id>``: results that keep updating."""

    def write(batch: DataFrame, batch_id: int) -> None:
        held = Visitors(batch.sparkSession, state, keys, visitor, retention, buckets)
        if held.totals.has(batch_id):
            return
        needed = dict.fromkeys([*keys, visitor, AT, *([retention.ts] if retention else [])])
        with (
            kept(held.timely(batch, batch_id).select(*needed)) as records,
            kept(held.firsts(records.withColumn("__seq", F.lit(0)), "__seq", batch_id)) as firsts,
            kept(held.counts(records, firsts, held.totals.opening(records, batch_id))) as closing,
        ):
            closing.drop(AT).write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")
            held.commit(batch_id, records, firsts, closing)

    return attached(write)
