"""Change-logs: rows that retract an old result (``op`` false) or add a new one (``op`` true)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType

from tidetable.operators import ordered, running
from tidetable.operators.ordered import BEFORE_ALL, BLOCK_WIDTH

# result column -> (function, column)
Measures = Mapping[str, tuple[str, str]]


def _steps(
    df: DataFrame, keys: Sequence[str], seq: str, measures: Measures, firsts: DataFrame | None = None
) -> tuple[DataFrame, list[str]]:
    """What every record adds to its key's running state: ``keys, seq, __record`` and one column per state name."""
    distinct = [col for fn, col in measures.values() if fn == "count_distinct"]
    if len(distinct) > 1:
        raise ValueError("at most one count_distinct per change-log")
    steps = df.select("*", F.lit(1).alias("__record"), F.lit(0).alias("__first"))
    if distinct:
        firsts = running.first_sightings(df, keys, distinct[0], seq) if firsts is None else firsts
        firsts = firsts.select(*keys, seq, F.lit(0).alias("__record"), F.lit(1).alias("__first"))
        steps = steps.unionByName(firsts, allowMissingColumns=True)

    state = {"__rows": F.col("__record").cast("long")}
    for name, (fn, col) in measures.items():
        if fn == "sum":
            if isinstance(df.schema[col].dataType, (FloatType, DoubleType)):
                raise ValueError(f"sum of {col}: cast to an integral or decimal type first")
            kind = ordered.sum_type(df, F.col(col))
            state[f"__new_{name}"] = F.coalesce(F.col(col).cast(kind), F.lit(0).cast(kind))
            state[f"__set_{name}"] = F.col(col).isNotNull().cast("long")
        elif fn == "count":
            counted = F.col("__record") if col == "*" else F.col(col).isNotNull().cast("int") * F.col("__record")
            state[f"__new_{name}"] = counted.cast("long")
        else:
            state[f"__new_{name}"] = F.col("__first").cast("long")
    return steps.select(*keys, seq, "__record", *[e.alias(name) for name, e in state.items()]), list(state)


def aggregate_changelog(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    measures: Measures,
    emit_unchanged: bool = False,
    opening: DataFrame | None = None,
    width: int = BLOCK_WIDTH,
    firsts: DataFrame | None = None,
) -> DataFrame:
    """All updates of ``GROUP BY keys`` as records arrive: ``op, keys, seq, *measures``.

    Measures are ``('sum', column)``, ``('count', column or '*')`` and at most one ``('count_distinct', column)``.
    Each record retracts its key's last result, if any, and adds the new one; a record that leaves the result
    unchanged emits nothing unless ``emit_unchanged`` (the behaviour under idle-state retention). Records of one key with equal
    numbers, as a source that repeats itself delivers them, are one step. Sums need an exact
    type, so that what is retracted equals what was added. ``opening`` is the `closing_state` of earlier input; a distinct
    count then needs ``firsts``, the `running.first_sightings` that the earlier input had not seen.
    """
    steps, state = _steps(df, keys, seq, measures, firsts)
    if opening is not None:
        steps = steps.unionByName(opening.withColumn(seq, F.lit(BEFORE_ALL)).withColumn("__record", F.lit(0)))
    # a record and its visitor's first sighting share one position, so they form one step
    run = ordered.running_sums(
        steps,
        keys,
        seq,
        {name: F.col(name) for name in state},
        peers=True,
        step_suffix="__step",
        width=width,
        head=("__head", F.col("__record")),
    ).where("__record = 1 and __head")
    types = {f.name: f.dataType for f in run.schema}

    def result(before: bool) -> list:
        def at(name):
            return (F.col(name) - F.col(f"{name}__step")).cast(types[name]) if before else F.col(name)

        return [
            (F.when(at(f"__set_{name}") > 0, at(f"__new_{name}")) if fn == "sum" else at(f"__new_{name}")).alias(name)
            for name, (fn, _) in measures.items()
        ]

    first_step = (F.col("__rows") == F.col("__rows__step")).alias("__first_step")
    pairs = run.select(*keys, seq, first_step, F.struct(*result(True)).alias("__old"), F.struct(*result(False)).alias("__new"))
    if not emit_unchanged:
        pairs = pairs.where(F.col("__first_step") | ~F.col("__old").eqNullSafe(F.col("__new")))
    emitted = F.array(
        F.struct(F.lit(False).alias("op"), F.col("__old").alias("row")),
        F.struct(F.lit(True).alias("op"), F.col("__new").alias("row")),
    )
    log = pairs.select(*keys, seq, "__first_step", F.explode(emitted).alias("__change"))
    shown = log.where("__change.op or not __first_step").select("__change.op", *keys, seq, "__change.row.*")
    return ordered.typed_like(shown, df.select(*keys, seq))


def closing_state(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    measures: Measures,
    opening: DataFrame | None = None,
    firsts: DataFrame | None = None,
) -> DataFrame:
    """Per-key state after all records, from which the change-log of later input goes on.

    Distinct counts cannot be continued from totals alone: ``firsts`` says which visitors are new.
    """
    if firsts is None and any(fn == "count_distinct" for fn, _ in measures.values()):
        raise ValueError("a change-log of distinct counts cannot be continued without first sightings")
    steps, state = _steps(df, keys, seq, measures, firsts)
    steps = steps.select(*keys, *state)
    if opening is not None:
        steps = steps.unionByName(opening)
    types = {f.name: f.dataType for f in steps.schema}
    closed = steps.groupBy(*keys).agg(*[F.sum(name).cast(types[name]).alias(name) for name in state])
    return ordered.typed_like(closed, df.select(*keys))


def apply_changelog(log: DataFrame, keys: Sequence[str], seq: str, op: str = "op") -> DataFrame:
    """The table a change-log describes: per key the last change wins, and a last retraction removes the key."""
    values = [c for c in log.columns if c not in (*keys, seq, op)]
    last = log.groupBy(*keys).agg(F.max_by(F.struct(op, *values), F.struct(seq, op)).alias("__last"))
    return last.where(F.col("__last")[op]).select(*keys, *[F.col("__last")[v].alias(v) for v in values])


def versions_changelog(versions: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Change-log of an update-mode result kept as numbered versions: each new version retracts the one before.

    Versions of a key that equal their predecessor emit nothing.
    """
    values = [c for c in versions.columns if c not in (*keys, version)]
    row = F.struct(*values)
    seen = ordered.with_previous(versions, keys, version, row, "__previous")
    known = F.col("__previous").isNotNull()
    changed = seen.where(~known | ~F.col("__previous")["v"].eqNullSafe(row))
    emitted = F.array(
        F.struct(F.lit(False).alias("op"), F.col("__previous")["v"].alias("row"), known.alias("shown")),
        F.struct(F.lit(True).alias("op"), row.alias("row"), F.lit(True).alias("shown")),
    )
    log = changed.select(*keys, version, F.explode(emitted).alias("__change")).where("__change.shown")
    return log.select("__change.op", *keys, version, "__change.row.*")


def latest_by_key(versions: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """The newest version of each key from a table of appended versions."""
    values = [c for c in versions.columns if c not in (*keys, version)]
    last = versions.groupBy(*keys).agg(F.max_by(F.struct(*values), version).alias("__last"))
    return last.select(*keys, *[F.col("__last")[v].alias(v) for v in values])
