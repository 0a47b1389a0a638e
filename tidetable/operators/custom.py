"""Aggregates with user-supplied accumulators, for logic that column expressions cannot express."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

Frame = Callable[[pd.DataFrame], pd.DataFrame]

HELD_KEYS = 100_000


def user_aggregate(
    df: DataFrame,
    keys: Sequence[str],
    accumulate: Frame,
    merge: Frame,
    accumulator: str | StructType,
    held_keys: int = HELD_KEYS,
) -> DataFrame:
    """One accumulator row per key; derive the result from it with column expressions.

    ``accumulate`` turns input rows into accumulator rows (schema ``accumulator``, which includes the keys), ``merge``
    combines accumulator rows of equal keys into one each and must not depend on their order. Each task folds its rows
    batch by batch before the shuffle and passes on what it holds beyond ``held_keys`` keys. A key so reaches its final
    task as a few accumulators per task, not as its rows.
    """

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            fresh = accumulate(batch)
            held = fresh if held is None else merge(pd.concat([held, fresh], ignore_index=True))
            if len(held) > held_keys:
                yield held
                held = None
        if held is not None:
            yield held

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_key = None
        for batch in batches:
            rows = batch if open_key is None else pd.concat([open_key, batch], ignore_index=True)
            if rows.empty:
                continue
            last = rows[list(keys)].iloc[-1]
            of_last = ((rows[list(keys)] == last) | (rows[list(keys)].isna() & last.isna())).all(axis=1)
            if not of_last.all():
                yield merge(rows[~of_last])
            open_key = merge(rows[of_last])
        if open_key is not None:
            yield open_key

    # equal keys arrive next to each other, so all but the last key of a batch are complete
    partial = df.mapInPandas(fold, accumulator)
    return partial.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(finish, accumulator)
