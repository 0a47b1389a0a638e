"""Values that build up record by record or window by window.

``seq`` is the arrival number of a record: integral and unique in the input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidetable.functions import timewin
from tidetable.operators import ordered, windowed
from tidetable.operators.ordered import BLOCK_WIDTH


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    seq: str,
    into: str = "total",
    opening: DataFrame | None = None,
    width: int = BLOCK_WIDTH,
) -> DataFrame:
    """Every record with its key's total so far.

    ``opening`` has columns ``keys, into``: the totals the keys start from, for input that continues earlier input.
    """
    zero = F.lit(0).cast(df.schema[value].dataType)
    steps = df.withColumn("__amount", F.coalesce(F.col(value), zero)).withColumn("__record", F.lit(True))
    if opening is not None:
        before = opening.select(*keys, ordered.before_all(df, seq).alias(seq), F.col(into).alias("__amount"))
        steps = steps.unionByName(before, allowMissingColumns=True)
    run = ordered.running_sums(steps, keys, seq, {into: F.col("__amount")}, width=width)
    total = ordered.sum_type(df, F.col(value))
    return ordered.typed_like(run.where("__record").select(*df.columns, F.col(into).cast(total).alias(into)), df)


def closing_totals(
    df: DataFrame, keys: Sequence[str], value: str, into: str = "total", opening: DataFrame | None = None
) -> DataFrame:
    """Totals per key after all records: the ``opening`` of the input that follows."""
    total = ordered.sum_type(df, F.col(value))
    amounts = df.select(*keys, F.coalesce(F.col(value).cast(total), F.lit(0).cast(total)).alias(into))
    if opening is not None:
        amounts = amounts.unionByName(opening.select(*keys, into))
    return ordered.typed_like(amounts.groupBy(*keys).agg(F.sum(into).cast(total).alias(into)), df.drop(into))


def carried_total(
    df: DataFrame,
    ts: str,
    keys: Sequence[str],
    value: str,
    size: str,
    into: str = "total",
    width: int = BLOCK_WIDTH,
) -> DataFrame:
    """Per key and tumbling window that has records: the total of this and all earlier windows."""
    sums = windowed.window_aggregate(df, ts, keys, {into: ("sum", value)}, size)
    zero = F.lit(0).cast(sums.schema[into].dataType)
    return ordered.running_sums(sums, keys, "w_start", {into: F.coalesce(F.col(into), zero)}, width=width)


def pv_uv_panes(
    df: DataFrame,
    ts: str,
    keys: Sequence[str],
    visitor: str,
    seq: str,
    size: str,
    width: int = BLOCK_WIDTH,
) -> DataFrame:
    """Page views and unique visitors of the record's key and window after each record.

    A visitor's first record per key and window, found by a minimum, adds one visitor at that position.
    """
    placed = timewin.assign(df, ts, size).select("*", *timewin.bounds(size)).drop("w")
    groups = [*keys, "w_start", "w_end"]
    return running_counts(placed, groups, visitor, seq, width)


def first_sightings(
    df: DataFrame, keys: Sequence[str], visitor: str, seq: str, seen: DataFrame | None = None
) -> DataFrame:
    """``keys, visitor, seq`` of the record at which a non-null visitor shows first, unless ``seen`` has it."""
    firsts = df.where(F.col(visitor).isNotNull()).groupBy(*keys, visitor).agg(F.min(seq).alias(seq))
    if seen is None:
        return firsts
    named = [*keys, visitor]
    known = seen.select(*[F.col(c).alias(f"__{c}") for c in named])
    same = F.lit(True)
    for c in named:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return firsts.join(known, same, "left_anti")


def running_counts(
    df: DataFrame,
    keys: Sequence[str],
    visitor: str,
    seq: str,
    width: int = BLOCK_WIDTH,
    opening: DataFrame | None = None,
    firsts: DataFrame | None = None,
) -> DataFrame:
    """Every record with ``pv`` and ``uv``: records and distinct non-null visitors of its key so far.

    For input that goes on from earlier input, ``opening`` has ``keys, pv, uv`` to start from and ``firsts`` the
    `first_sightings` of visitors that the earlier input had not seen.
    """
    records = df.select("*", F.lit(1).alias("__pv"), F.lit(0).alias("__uv"))
    firsts = first_sightings(df, keys, visitor, seq) if firsts is None else firsts
    firsts = firsts.select(*keys, seq, F.lit(0).alias("__pv"), F.lit(1).alias("__uv"))
    steps = records.withColumn("__record", F.lit(True)).unionByName(firsts, allowMissingColumns=True)
    if opening is not None:
        before = opening.select(*keys, ordered.before_all(df, seq).alias(seq), F.col("pv").alias("__pv"), F.col("uv").alias("__uv"))
        steps = steps.unionByName(before, allowMissingColumns=True)
    sums = {"pv": F.col("__pv").cast("long"), "uv": F.col("__uv").cast("long")}
    run = ordered.running_sums(steps, keys, seq, sums, peers=True, width=width)
    return ordered.typed_like(run.where("__record").select(*df.columns, "pv", "uv"), df)


def average_panes(
    df: DataFrame,
    ts: str,
    keys: Sequence[str],
    value: str,
    seq: str,
    size: str,
    into: str = "avg",
    width: int = BLOCK_WIDTH,
) -> DataFrame:
    """The average of the record's key and window after each record."""
    placed = timewin.assign(df, ts, size).select("*", *timewin.bounds(size)).drop("w")
    return running_average(placed, [*keys, "w_start", "w_end"], value, seq, into, width)


def running_average(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    seq: str,
    into: str = "avg",
    width: int = BLOCK_WIDTH,
    opening: DataFrame | None = None,
) -> DataFrame:
    """Every record with the average of its key's values so far.

    ``opening`` has ``keys, total, n``: the sums and numbers of values that the keys start from.
    """
    kind = df.schema[value].dataType
    steps = df.select("*", F.coalesce(F.col(value), F.lit(0).cast(kind)).alias("__amount"), F.col(value).isNotNull().cast("long").alias("__one"))
    sums = {"__sum": F.col("__amount"), "__n": F.col("__one")}
    if opening is None:
        run = ordered.running_sums(steps, keys, seq, sums, width=width)
    else:
        steps = steps.withColumn("__record", F.lit(True))
        before = opening.select(*keys, ordered.before_all(df, seq).alias(seq), F.col("total").alias("__amount"), F.col("n").alias("__one"))
        steps = steps.unionByName(before, allowMissingColumns=True)
        run = ordered.typed_like(ordered.running_sums(steps, keys, seq, sums, width=width).where("__record"), df)
    return run.select(*df.columns, F.try_divide("__sum", "__n").alias(into))


def emit_on_change(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: str,
    width: int = BLOCK_WIDTH,
    opening: DataFrame | None = None,
) -> DataFrame:
    """Only the rows whose value differs from the key's previous row (its first row always stays).

    Values are compared, not object identities, so an equal value is suppressed, null and NaN too. ``opening`` has
    ``keys, value``: the last values of earlier input.
    """
    steps = df
    if opening is not None:
        before = opening.select(*keys, ordered.before_all(df, order).alias(order), value)
        steps = df.withColumn("__record", F.lit(True)).unionByName(before, allowMissingColumns=True)
    seen = ordered.with_previous(steps, keys, order, F.col(value), "__previous", width)
    changed = F.col("__previous").isNull() | ~F.col("__previous")["v"].eqNullSafe(F.col(value))
    if opening is not None:
        seen = ordered.typed_like(seen.where("__record").drop("__record"), df)
    return seen.where(changed).drop("__previous")


def last_values(df: DataFrame, keys: Sequence[str], order: str, value: str) -> DataFrame:
    """``keys, value``: the value of the last row of each key, the ``opening`` of the input that follows."""
    return df.groupBy(*keys).agg(F.max_by(F.struct(value), order).alias("__last")).select(*keys, F.col("__last")[value].alias(value))


def changed_window_averages(
    df: DataFrame,
    ts: str,
    keys: Sequence[str],
    value: str,
    size: str,
    width: int = BLOCK_WIDTH,
) -> DataFrame:
    """Average per key and tumbling window, kept only where it differs from the key's previous window."""
    averages = windowed.window_aggregate(df, ts, keys, {"avg": ("avg", value)}, size)
    return emit_on_change(averages, keys, "w_start", "avg", width)


def over_range(
    df: DataFrame, ts: str, keys: Sequence[str], value: str, into: str = "total", width: int = BLOCK_WIDTH
) -> DataFrame:
    """Sum of all rows of the key up to and including the row's time; rows of one time share it, those without come first.

    Equal times collapse into one step before anything runs, so a burst at one instant is one row.
    """
    steps = df.groupBy(*keys, ts).agg(F.sum(value).alias("__step"))
    zero = F.lit(0).cast(steps.schema["__step"].dataType)
    run = ordered.running_sums(steps, keys, ts, {into: F.coalesce(F.col("__step"), zero)}, width=width)
    names = [*keys, ts]
    right = run.select(*[F.col(c).alias(f"__{c}") for c in names], into)
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in names]
    return df.join(right, same).select(*df.columns, into)
