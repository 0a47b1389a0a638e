"""Window, interval and dimension joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidetable.functions import timewin
from tidetable.operators import ordered
from tidetable.operators.ordered import BLOCK_WIDTH
from tidetable.session import written_once


def _windowed(df: DataFrame, ts: str, size: str) -> DataFrame:
    assigned = timewin.assign(df, ts, size)
    if not df.isStreaming:
        return assigned
    # a stream carries one event-time column; from here on that is the window, and the time itself is plain data
    return assigned.withColumn(ts, F.col(ts) + timewin.interval("0 seconds"))


def _salted(a: DataFrame, b: DataFrame, columns: Sequence[str], salts: int) -> tuple[DataFrame, DataFrame]:
    """Each left row gets one salt, from the text of its columns, each right row a copy per salt."""
    dealt = F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in columns]), F.lit(salts)).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    return a.withColumn("__salt", dealt), b.withColumn("__salt", copies)


def window_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_ts: str,
    right_ts: str,
    size: str,
    how: str = "inner",
    zero_time: Sequence[str] = (),
    salts: int = 1,
) -> DataFrame:
    """Equi-join of two inputs within tumbling windows; columns of ``right`` other than the key must be distinct.

    In a left join, ``zero_time`` names right-hand columns that read 0 instead of null for unmatched rows. On
    streams both inputs need watermarks.

    On bounded input Spark splits a skewed (key, window) at run time. It does not on streams: there ``salts`` deals the
    left rows of a key over that many tasks, each of which gets all right rows.
    """
    a = _windowed(left, left_ts, size)
    b = _windowed(right, right_ts, size)
    on = [key, "w"]
    if salts > 1:
        a, b = _salted(a, b, left.columns, salts)
        on.append("__salt")
    joined = a.join(b, on, how)
    columns = [c for c in [*left.columns, *right.columns] if c != key]
    values = [F.coalesce(F.col(c), F.lit(0)).alias(c) if c in zero_time else F.col(c) for c in columns]
    return joined.select(key, *timewin.bounds(size), *values)


def window_join_panes(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_ts: str,
    right_ts: str,
    seq: str,
    size: str,
    how: str = "inner",
    zero_time: Sequence[str] = (),
    width: int = BLOCK_WIDTH,
) -> DataFrame:
    """Window join that fires at every arrival and re-emits all pairs its key and window hold by then.

    The repetition is kept as numbers, not as rows: ``first_pane`` is the arrival (counted within key and window)
    at which a row first shows, ``fires`` how many arrivals in a row emit it. A left join also has the unmatched
    left rows that show until the first right row arrives. `expand_panes` spells the emissions out.

    ``seq`` is the arrival number, named alike and unique over both inputs; the right one is returned as
    ``right_<seq>``.
    """
    groups = [key, "w_start"]

    def placed(df: DataFrame, ts: str, is_left: bool) -> DataFrame:
        stamped = timewin.assign(df, ts, size).withColumn("w_start", F.col("w")["start"]).drop("w")
        return stamped.withColumn("__left", F.lit(is_left))

    arrivals = placed(left, left_ts, True).unionByName(placed(right, right_ts, False), allowMissingColumns=True)
    step = {"__pane": F.lit(1).cast("long")}
    # the spans, the left and the right rows all come from the numbered arrivals
    numbered = written_once(ordered.running_sums(arrivals, groups, seq, step, width=width))
    # the last pane and the first right one of every group, null keys too
    spans = numbered.groupBy(*groups).agg(
        F.max("__pane").alias("__panes"), F.min(F.when(~F.col("__left"), F.col("__pane"))).alias("__match")
    )
    spans = spans.withColumnsRenamed({c: f"__of_{c}" for c in groups})
    same_group = F.lit(True)
    for c in groups:
        same_group = same_group & F.col(c).eqNullSafe(F.col(f"__of_{c}"))

    numbered_left = numbered.where("__left").select("w_start", "__pane", *left.columns)
    numbered_left = numbered_left.join(spans, same_group).drop(*[f"__of_{c}" for c in groups])
    numbered_right = numbered.where("not __left").select("w_start", "__pane", *right.columns)
    numbered_right = numbered_right.withColumnsRenamed({"__pane": "__right_pane", seq: f"right_{seq}"})

    columns = [c for c in left.columns if c != key]
    right_columns = [f"right_{seq}" if c == seq else c for c in right.columns if c != key]
    bounds = ["w_start", (F.col("w_start") + timewin.interval(size)).alias("w_end")]
    shown = F.greatest("__pane", "__right_pane")
    pairs = numbered_left.join(numbered_right, groups).select(
        key, *bounds, *columns, *right_columns, shown.alias("first_pane"), (F.col("__panes") - shown + 1).alias("fires")
    )
    if how == "inner":
        return pairs
    # rows of a null key match nothing and show to the end
    until = F.when(F.col(key).isNull(), F.col("__panes")).otherwise(F.coalesce(F.col("__match") - 1, F.col("__panes")))
    alone = numbered_left.select(
        key, *bounds, *columns, F.col("__pane").alias("first_pane"), (until - F.col("__pane") + 1).alias("fires")
    ).where("fires > 0")
    both = pairs.unionByName(alone, allowMissingColumns=True)
    return both.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in zero_time})


def expand_panes(panes: DataFrame) -> DataFrame:
    """One row per emission of `window_join_panes`, numbered by ``pane``."""
    last = F.col("first_pane") + F.col("fires") - 1
    return panes.withColumn("pane", F.explode(F.sequence("first_pane", last))).drop("first_pane", "fires")


def interval_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_ts: str,
    right_ts: str,
    within: str,
    bucketed: bool | None = None,
    salts: int = 1,
) -> DataFrame:
    """Pairs of equal key whose right time lies in ``[left_ts, left_ts + within]``, both ends included.

    Bounded inputs also join on time buckets as long as the interval: a left row enters the two buckets its interval
    can touch, a right row its own, so a key with a long history meets only its neighbourhood in time and spreads
    over many tasks. Streams join on the key and the range, which bounds their state; ``salts`` spreads a hot key there as
    in `window_join`.
    """
    right_columns = [c for c in right.columns if c != key]
    left_columns, right = left.columns, right.withColumnRenamed(key, f"__{key}")
    same = F.col(f"l.{key}") == F.col(f"r.__{key}")
    if salts > 1:
        left, right = _salted(left, right, left_columns, salts)
        same = same & (F.col("l.__salt") == F.col("r.__salt"))
    low, high = F.col(f"l.{left_ts}"), F.col(f"l.{left_ts}") + timewin.interval(within)
    near = (F.col(f"r.{right_ts}") >= low) & (F.col(f"r.{right_ts}") <= high)
    columns = [*[F.col(f"l.{c}") for c in left_columns], *[F.col(f"r.{c}") for c in right_columns]]
    if bucketed is None:
        bucketed = not (left.isStreaming or right.isStreaming)
    if bucketed:
        start = F.window(left_ts, within)["start"]
        left = left.withColumn("__start", start).withColumn(
            "__bucket", F.explode(F.array("__start", F.col("__start") + timewin.interval(within)))
        )
        right = right.withColumn("__bucket", F.window(right_ts, within)["start"])
        same = same & (F.col("l.__bucket") == F.col("r.__bucket"))
    return left.alias("l").join(right.alias("r"), same & near).select(*columns)


def dimension_join(rows: DataFrame, dimension: DataFrame, on: Column, how: str = "inner") -> DataFrame:
    """Enrich a table or stream from a bounded dimension.

    No broadcast is forced: Spark broadcasts the dimension when its measured size is below
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles both sides.
    """
    return rows.join(dimension, on, how)


def cross_where(rows: DataFrame, dimension: DataFrame, condition: str) -> DataFrame:
    """Product of two tables filtered by a text condition; the optimizer turns its equalities into join keys.

    A condition that leaves a true product, for want of an equality between the two, is refused.
    """
    joined = rows.join(dimension, how="inner").where(condition)
    operators = joined._jdf.queryExecution().sparkPlan().toString()
    if "CartesianProduct" in operators or "BroadcastNestedLoopJoin" in operators:
        raise ValueError(f"no equality between the two tables in: {condition}")
    return joined
