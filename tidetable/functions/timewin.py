"""Time columns and time windows.

Durations are Spark interval texts such as ``'10 seconds'`` or ``'1 hour'``.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F

_UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
}


def micros_of(duration: str) -> int:
    """Length of ``'<n> <unit>'`` in microseconds."""
    number, unit = duration.split()
    return int(number) * _UNIT_MICROS[unit.lower().removesuffix("s")]


def _interval(micros: int) -> Column:
    return F.lit(timedelta(microseconds=micros))


def interval(duration: str) -> Column:
    """A day-time interval literal."""
    return _interval(micros_of(duration))


def with_event_time(df: DataFrame, source: str, unit: str, into: str = "ts", delay: str | None = None) -> DataFrame:
    """Derive the event time from an epoch column (``unit`` 's' or 'ms') or a timestamp (``unit`` 'ts').

    ``delay`` is the bounded disorder of a stream: ``'0 seconds'`` for ascending times.
    """
    stamp = {"s": F.timestamp_seconds, "ms": F.timestamp_millis, "ts": lambda c: c.cast("timestamp")}[unit]
    df = df.withColumn(into, stamp(F.col(source)))
    return df.withWatermark(into, delay) if delay else df


def with_arrival_time(df: DataFrame, into: str = "procTime", arrival: Column | None = None) -> DataFrame:
    """Append the processing-time attribute as last column; ``arrival`` replaces the clock in replays."""
    return df.withColumn(into, F.current_timestamp() if arrival is None else arrival)


def at_zone(ts: str | Column, zone: str = "Asia/Shanghai") -> Column:
    """Local wall-clock rendering of a UTC time."""
    return F.from_utc_timestamp(ts, zone)


def hour_label(ts: str | Column) -> Column:
    """Text label of the hour, e.g. ``2019-12-25 15:00``."""
    return F.date_format(ts, "yyyy-MM-dd HH:00")


def last_milli(end: Column) -> Column:
    """The row time of a closed window: one millisecond before its end."""
    return end - _interval(1_000)


def is_gapped(size: str, slide: str | None) -> bool:
    """A hop longer than the window leaves stretches of time that no window covers."""
    return slide is not None and micros_of(slide) > micros_of(size)


def assign(df: DataFrame, ts: str, size: str, slide: str | None = None, into: str = "w") -> DataFrame:
    """Attach the window column: tumbling without ``slide``, hopping with it.

    In the gapped case rows between two windows belong to none and drop out; the attached struct then spans
    the hop (Spark's watermark bookkeeping needs its own window column), so read bounds with `bounds`.
    """
    if is_gapped(size, slide):
        hop = F.window(ts, slide)
        return df.withColumn(into, hop).where(F.col(ts) < F.col(into)["start"] + interval(size))
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    return df.withColumn(into, window)


def starts(ts: str, size: str, slide: str | None = None, into: str = "w_start") -> Column:
    """Start of the window a time lies in, or one row per start with an overlapping ``slide``; for bounded input."""
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    return window["start"].alias(into)


def seconds_of(ts: Column, kind: str) -> Column:
    """Whole seconds from the epoch to a time of type ``kind``, rounded down; zoneless times by their own clock."""
    if kind == "timestamp":
        return F.unix_seconds(ts)
    since = ts.cast("timestamp_ntz") - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.floor(since.cast("interval second").cast("decimal(18,6)")).cast("long")


def time_of(seconds: Column, kind: str) -> Column:
    """The time of type ``kind`` so many seconds after the epoch."""
    if kind == "timestamp":
        return F.timestamp_seconds(seconds)
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def shifts(size: str, slide: str) -> Column:
    """How far before a slide-wide slice the overlapping windows that cover it start."""
    last = micros_of(size) - micros_of(slide)
    numbers = F.sequence(F.lit(0), F.lit(last), F.lit(micros_of(slide)))
    return F.transform(numbers, lambda back: F.make_dt_interval(secs=back / F.lit(1_000_000).cast("decimal(18,6)")))


def bounds(size: str, slide: str | None = None, of: str = "w", start: str = "w_start", end: str = "w_end") -> list[Column]:
    """Start and end columns of an attached window."""
    w = F.col(of)
    last = w["start"] + interval(size) if is_gapped(size, slide) else w["end"]
    return [w["start"].alias(start), last.alias(end)]
