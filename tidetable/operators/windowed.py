"""Aggregates per key and time window."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidetable.functions import timewin
from tidetable.functions.text import tokens

# measure -> (function, column): 'count' of '*' counts rows, of a column its non-null values
Measures = Mapping[str, tuple[str, str]]


def _direct(fn: str, col: str) -> Column:
    if fn == "count":
        return F.count("*") if col == "*" else F.count(col)
    return {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max}[fn](col)


def _partials(measures: Measures) -> dict[str, tuple[Column, str]]:
    """Slice-level pieces of each measure and how pieces of several slices combine."""
    parts: dict[str, tuple[Column, str]] = {}
    for name, (fn, col) in measures.items():
        if fn == "avg":
            parts[f"{name}__sum"] = (F.sum(col), "sum")
            parts[f"{name}__n"] = (F.count(col), "sum")
        else:
            parts[name] = (_direct(fn, col), "sum" if fn in ("count", "sum") else fn)
    return parts


def window_aggregate(
    df: DataFrame,
    ts: str,
    keys: Sequence[str],
    measures: Measures,
    size: str,
    slide: str | None = None,
    preaggregate: bool = True,
) -> DataFrame:
    """``keys, w_start, w_end, *measures`` per key and window.

    Overlapping hops aggregate once per slide-wide slice and copy only those partial rows into the windows that cover
    them, instead of copying every input row ``size / slide`` times. The sum of an average's slice and its count combine
    exactly. A stream does this as two chained aggregations, which only append mode allows: pass ``preaggregate=False``
    for update mode.
    """
    hops = timewin.micros_of(size) / timewin.micros_of(slide or size)
    sliced = preaggregate and hops > 1 and hops.is_integer()
    if df.isStreaming and sliced:
        parts = _partials(measures)
        slices = timewin.assign(df, ts, slide, into="__slice").groupBy("__slice", *keys).agg(
            *[piece.alias(name) for name, (piece, _) in parts.items()]
        )
        merged = slices.groupBy(F.window("__slice", size, slide).alias("w"), *keys).agg(*_combined(parts))
        return merged.select(*keys, *timewin.bounds(size, slide), *_outputs(measures))
    if df.isStreaming or timewin.is_gapped(size, slide):
        aggregates = [_direct(fn, col).alias(name) for name, (fn, col) in measures.items()]
        counted = timewin.assign(df, ts, size, slide).groupBy("w", *keys).agg(*aggregates)
        return counted.select(*keys, *timewin.bounds(size, slide), *measures)
    if sliced and _adds_up(df, ts, measures, size, slide):
        counted = _in_stretches(df, ts, keys, measures, size, slide)
    elif sliced:
        counted = _sliced(df, ts, keys, measures, size, slide)
    else:
        aggregates = [_direct(fn, col).alias(name) for name, (fn, col) in measures.items()]
        counted = df.groupBy(timewin.starts(ts, size, slide), *keys).agg(*aggregates)
    return counted.select(*keys, "w_start", (F.col("w_start") + timewin.interval(size)).alias("w_end"), *measures)


def _combined(parts: Mapping[str, tuple[Column, str]]) -> list[Column]:
    return [{"sum": F.sum, "min": F.min, "max": F.max}[how](name).alias(name) for name, (_, how) in parts.items()]


def _outputs(measures: Measures) -> list[Column]:
    return [
        F.try_divide(f"{name}__sum", f"{name}__n").alias(name) if fn == "avg" else F.col(name)
        for name, (fn, _) in measures.items()
    ]


# a key's time is dealt out in stretches of so many windows
STRETCH = 16


def _sliced(df: DataFrame, ts: str, keys: Sequence[str], measures: Measures, size: str, slide: str) -> DataFrame:
    """Slices of a key and stretch of time meet before they are copied, so the copies need no shuffle of their own.

    A stretch holds the windows that start in it. A slice goes to the stretch it lies in, and to the one before if a
    window that starts there still covers it: one slice in ``STRETCH`` goes twice, and no task gets a key's whole history.
    """
    parts = _partials(measures)
    slices = df.groupBy(timewin.starts(ts, slide).alias("__slice"), *keys).agg(
        *[piece.alias(name) for name, (piece, _) in parts.items()]
    )
    length = f"{timewin.micros_of(size) * STRETCH} microseconds"
    earliest = timewin.interval(f"{timewin.micros_of(size) - timewin.micros_of(slide)} microseconds")
    dealt = slices.withColumn("__own", F.window("__slice", length)["start"])
    dealt = dealt.withColumn("__first", F.col("__slice") - earliest).withColumn("__before", F.window("__first", length)["start"])
    dealt = dealt.withColumn("__stretch", F.explode(F.array_distinct(F.array("__own", "__before"))))
    # the number is given, because run-time coalescing would judge by the size before copying
    dealt = dealt.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys, "__stretch")
    panes = dealt.withColumn("__shift", F.explode(timewin.shifts(size, slide))).withColumn(
        "w_start", F.col("__slice") - F.col("__shift")
    )
    inside = (F.col("w_start") >= F.col("__stretch")) & (F.col("w_start") < F.col("__stretch") + timewin.interval(length))
    merged = panes.where(inside).groupBy("__stretch", "w_start", *keys).agg(*_combined(parts))
    return merged.select(*keys, "w_start", *_outputs(measures))


# so many windows start in a stretch of which a key has one row
STARTS = 16
MOST_CELLS = 64


def _adds_up(df: DataFrame, ts: str, measures: Measures, size: str, slide: str) -> bool:
    """Whether a stretch of slices fits in one row: few overlaps, and measures that are counts or sums of whole numbers."""
    whole = {name for name, kind in df.dtypes if kind in ("tinyint", "smallint", "int", "bigint")}
    adds = all(fn == "count" or fn == "sum" and col in whole for fn, col in measures.values())
    hops = timewin.micros_of(size) // timewin.micros_of(slide)
    few = 2 * hops <= STARTS and (STARTS + hops) * len(measures) <= MOST_CELLS
    return adds and few and dict(df.dtypes).get(ts, "").startswith("timestamp") and timewin.micros_of(slide) % 1_000_000 == 0


def _in_stretches(df: DataFrame, ts: str, keys: Sequence[str], measures: Measures, size: str, slide: str) -> DataFrame:
    """One row per key and stretch of time with a cell per slice; its windows add neighbouring cells up.

    So there is one shuffle, of partial rows, and no second aggregation over copies. The first slices of a stretch also
    count in the one before, whose last windows cover them. No row holds more of a key's history than a stretch.
    """
    step, hops = timewin.micros_of(slide) // 1_000_000, timewin.micros_of(size) // timewin.micros_of(slide)
    length, kind = step * STARTS, dict(df.dtypes)[ts]
    dealt = df.where(F.col(ts).isNotNull()).withColumn("__second", timewin.seconds_of(F.col(ts), kind))
    dealt = dealt.withColumn("__slice", F.col("__second") - F.pmod("__second", F.lit(step)))
    dealt = dealt.withColumn("__own", F.col("__slice") - F.pmod("__slice", F.lit(length)))
    dealt = dealt.withColumn("__place", ((F.col("__slice") - F.col("__own")) / F.lit(step)).cast("int"))
    also = F.when(F.col("__place") < hops - 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    dealt = dealt.withColumn("__back", F.explode(also))
    dealt = dealt.withColumn("__stretch", F.col("__own") - F.col("__back") * F.lit(length))
    dealt = dealt.withColumn("__cell", F.col("__place") + F.col("__back") * F.lit(STARTS))

    places = range(STARTS + hops - 1)
    inside = lambda i, col: F.when(F.col("__cell") == i, F.lit(1) if col == "*" else F.col(col))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("__cell"))
    cells = [{"count": F.count, "sum": F.sum}[fn](inside(i, col)).alias(f"__{m}_{i}") for m, (fn, col) in enumerate(measures.values()) for i in places]
    rows = dealt.groupBy("__stretch", *keys).agg(F.bit_or(bit).alias("__filled"), *cells)
    rows = rows.withColumn("__begin", timewin.time_of(F.col("__stretch"), kind))

    held = [F.array(*[F.col(f"__{m}_{i}") for i in places]).alias(f"__{m}") for m in range(len(measures))]
    windows = rows.select(*keys, "__begin", "__filled", *held, F.explode(F.array(*[F.lit(i) for i in range(STARTS)])).alias("__start"))
    covered = F.call_function("shiftleft", F.lit((1 << hops) - 1).cast("long"), F.col("__start"))
    windows = windows.where(F.col("__filled").bitwiseAND(covered) != 0)

    def total(m: int) -> Column:
        of = [F.get(f"__{m}", F.col("__start") + i) for i in range(hops)]
        return F.when(F.coalesce(*of).isNotNull(), sum(F.coalesce(c, F.lit(0).cast("long")) for c in of))

    begin = F.col("__begin") + timewin.interval(slide) * F.col("__start")
    return windows.select(*keys, begin.alias("w_start"), *[total(m).alias(name) for m, name in enumerate(measures)])


def pv_uv(df: DataFrame, keys: Sequence[str | Column], visitor: str, exact: bool = True) -> DataFrame:
    """Page views and unique visitors per group.

    Exact counting first reduces to distinct (group, visitor) pairs on both sides of the shuffle, so one huge
    group spreads over its visitors. ``exact=False`` keeps a fixed-size sketch per group instead.
    """
    distinct = F.count_distinct(visitor) if exact else F.approx_count_distinct(visitor)
    return df.groupBy(*keys).agg(F.count("*").alias("pv"), distinct.alias("uv"))


def hourly_pv_uv(df: DataFrame, ts: str, visitor: str, exact: bool = True) -> DataFrame:
    """Page views and unique visitors per hour label over the whole input, without a window."""
    return pv_uv(df, [timewin.hour_label(ts).alias("dt")], visitor, exact)


def window_pv_uv(df: DataFrame, ts: str, keys: Sequence[str], visitor: str, size: str, exact: bool = True) -> DataFrame:
    """Page views and unique visitors per key and tumbling window."""
    counted = pv_uv(df, [timewin.starts(ts, size), *keys], visitor, exact)
    return counted.select(*keys, "w_start", (F.col("w_start") + timewin.interval(size)).alias("w_end"), "pv", "uv")


def words(df: DataFrame, text: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row ``(word, n=1)`` per word of each line."""
    return df.select(*keep, F.explode(tokens(text)).alias("word")).withColumn("n", F.lit(1).cast("long"))


def word_count(df: DataFrame, text: str, ts: str, size: str, slide: str | None = None) -> DataFrame:
    """Word totals per tumbling or hopping window."""
    return window_aggregate(words(df, text, [ts]), ts, ["word"], {"n": ("sum", "n")}, size, slide)
