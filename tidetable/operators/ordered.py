"""Running values along an order, safe for keys that hold a large share of all rows.

A window function puts all rows of one key into one task. Every key is therefore cut into blocks along its order:
values run inside each block, one pre-aggregated row per block runs over the blocks of a larger block, those over the
key, and every row adds what its block starts from. A block is a range of ``width`` order numbers (a time counts in
microseconds), a larger block one of ``width ** 2``, so with a unique arrival number no task gets more than ``width`` rows
at the two lower levels, be the numbers dense or sparse; three levels of the default width span 64 bits. All keys go
this one way, whatever their size. Rows without an order come first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DataType, DateType, DecimalType, IntegralType, TimestampNTZType, TimestampType

BLOCK_WIDTH = 1 << 22
# an order number in front of every arrival number
BEFORE_ALL = -(1 << 62)

_KEY, _PLACE, _BLOCK, _LARGE = "__key", "__place", "__block", "__large"
_LEAST = -(1 << 63)


def _number(df: DataFrame, order: str) -> Column:
    """The order column as a long that grows with it; null in front."""
    column, kind = F.col(order), df.schema[order].dataType
    if isinstance(kind, DateType):
        column = F.unix_date(column).cast("long") * 86_400_000_000  # as timestamps, so that a day is a block
    elif isinstance(kind, TimestampType):
        column = F.unix_micros(column)
    elif isinstance(kind, TimestampNTZType):  # by its fields, so that no zone is involved
        minutes = F.hour(column) * 60 + F.minute(column)
        seconds = (F.extract(F.lit("SECOND"), column) * 1_000_000).cast("long")
        days = F.unix_date(column.cast("date")).cast("long")
        column = (days * 1440 + minutes) * 60_000_000 + seconds
    return F.coalesce(column.cast("long"), F.lit(_LEAST))


def before_all(df: DataFrame, order: str) -> Column:
    """An order value in front of all others, for what earlier input leaves behind."""
    kind = df.schema[order].dataType
    return F.lit(BEFORE_ALL) if isinstance(kind, IntegralType) else F.lit(None).cast(kind)


def _placed(df: DataFrame, keys: Sequence[str], order: str, width: int) -> DataFrame:
    bits = max(width - 1, 1).bit_length()
    place = df.select("*", F.struct(*keys).alias(_KEY), _number(df, order).alias(_PLACE))
    return place.select("*", F.shiftright(_PLACE, bits).alias(_BLOCK), F.shiftright(_PLACE, 2 * bits).alias(_LARGE))


def _with_carry(rows: DataFrame, carry: DataFrame, *places: str) -> DataFrame:
    """Rows with what their block starts from; every block is in ``carry``."""
    right = carry.withColumnsRenamed({c: f"__c{c}" for c in (_KEY, *places)})
    same = F.lit(True)
    for c in (_KEY, *places):
        same = same & (F.col(c) == F.col(f"__c{c}"))
    return rows.join(right, same, "left").drop(*[f"__c{c}" for c in (_KEY, *places)])


def sum_type(df: DataFrame, expression: Column) -> DataType:
    """The type of running totals: that of the sum, with a digit to spare so that adding two keeps all decimals."""
    kind = df.select(F.sum(expression).alias("s")).schema["s"].dataType
    return DecimalType(min(kind.precision, 37), kind.scale) if isinstance(kind, DecimalType) else kind


def running_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    sums: Mapping[str, Column],
    peers: bool = False,
    step_suffix: str | None = None,
    width: int = BLOCK_WIDTH,
    head: tuple[str, Column] | None = None,
) -> DataFrame:
    """Add, per key and along ``order``, the running total of each non-null expression in ``sums``.

    With ``peers`` rows of equal order share one total (a range frame), otherwise each row is a step of its own.
    ``step_suffix`` also adds what that last step contributed, under the total's name plus the suffix. ``head`` names a column
    that is true for one row of each order number, the one where the given column is largest.
    """
    types = {name: sum_type(df, e) for name, e in sums.items()}
    placed = _placed(df, keys, order, width)
    steps = Window.partitionBy(_KEY, _BLOCK).orderBy(_PLACE)
    between = steps.rangeBetween if peers else steps.rowsBetween
    frame = between(Window.unboundedPreceding, Window.currentRow)
    own = between(Window.currentRow, Window.currentRow)
    local = placed.select(
        "*",
        *[F.sum(e).over(frame).cast(types[name]).alias(f"__in_{name}") for name, e in sums.items()],
        *[F.sum(e).over(own).cast(types[name]).alias(name + step_suffix) for name, e in sums.items() if step_suffix],
    )
    if head:
        peers_of = Window.partitionBy(_KEY, _BLOCK, _PLACE).orderBy(head[1].desc())
        local = local.withColumn(head[0], F.row_number().over(peers_of) == 1)

    def added(*parts: str):
        """Columns summed name by name; a missing one is nothing."""
        for name, kind in types.items():
            total = F.lit(0).cast(kind)
            for part in parts:
                total = (total + F.coalesce(F.col(part + name), F.lit(0).cast(kind))).cast(kind)
            yield name, total

    def before(level: str, place: str, *by: str) -> list[Column]:
        """What the rows in front of this one, within ``by``, add up to."""
        ahead = Window.partitionBy(_KEY, *by).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
        return [F.sum(f"__of_{name}").over(ahead).cast(kind).alias(level + name) for name, kind in types.items()]

    blocks = placed.groupBy(_KEY, _LARGE, _BLOCK).agg(*[F.sum(e).cast(types[n]).alias(f"__of_{n}") for n, e in sums.items()])
    # a larger block comes together once: what is in front of each of its blocks, and its sum in the row of the last one
    last = F.lead(_BLOCK).over(Window.partitionBy(_KEY, _LARGE).orderBy(_BLOCK)).isNull()
    near = blocks.select("*", *before("__near_", _BLOCK, _LARGE), last.alias("__last"))
    whole = [(F.coalesce(f"__of_{n}", F.lit(0).cast(t)) + F.coalesce(f"__near_{n}", F.lit(0).cast(t))).cast(t).alias(f"__of_{n}") for n, t in types.items()]
    to_large = near.where("__last").select(_KEY, _LARGE, *whole).select(_KEY, _LARGE, *before("__far_", _LARGE))
    to_block = _with_carry(near.select(_KEY, _LARGE, _BLOCK, *[f"__near_{name}" for name in types]), to_large, _LARGE)
    carry = to_block.select(_KEY, _BLOCK, *[e.alias(f"__to_{name}") for name, e in added("__far_", "__near_")])

    kept = [c for c in df.columns if c not in sums]
    kept += [name + step_suffix for name in sums if step_suffix] + ([head[0]] if head else [])
    return _with_carry(local, carry, _BLOCK).select(*kept, *[e.alias(name) for name, e in added("__in_", "__to_")])


def with_previous(
    df: DataFrame, keys: Sequence[str], order: str, value: Column, into: str, width: int = BLOCK_WIDTH
) -> DataFrame:
    """Add ``into``: a struct holding the value ``v`` of the key's previous row, null where there is none."""
    held = F.struct(value.alias("v"))
    placed = _placed(df, keys, order, width)
    steps = Window.partitionBy(_KEY, _BLOCK).orderBy(_PLACE)
    local = placed.select("*", F.lag(held).over(steps).alias("__in"))

    blocks = placed.groupBy(_KEY, _LARGE, _BLOCK).agg(F.max_by(held, _PLACE).alias("__last"))
    within = Window.partitionBy(_KEY, _LARGE).orderBy(_BLOCK)
    near = blocks.select("*", F.lag("__last").over(within).alias("__near"), F.lead(_BLOCK).over(within).isNull().alias("__end"))
    ends = near.where("__end")
    to_large = ends.select(_KEY, _LARGE, F.lag("__last").over(Window.partitionBy(_KEY).orderBy(_LARGE)).alias("__far"))
    to_block = _with_carry(near.select(_KEY, _LARGE, _BLOCK, "__near"), to_large, _LARGE)
    carry = to_block.select(_KEY, _BLOCK, F.coalesce("__near", "__far").alias("__to"))
    return _with_carry(local, carry, _BLOCK).select(*df.columns, F.coalesce("__in", "__to").alias(into))


def typed_like(df: DataFrame, like: DataFrame) -> DataFrame:
    """``df`` with the columns it shares with ``like`` in that one's types, so that results of all batches agree."""
    types = {f.name: f.dataType for f in like.schema}
    return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])
