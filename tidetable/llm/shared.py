"""What the operators of this subpackage share: text columns, written intermediate tables, code for the executors."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidetable.session import shared_folder

PACKAGE = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that tasks can import it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="tidetable-code-")) / f"{PACKAGE.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(PACKAGE.rglob("*.py")):
            out.write(file, file.relative_to(PACKAGE.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def text_of(column: str) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` into the shared folder and read it back: no lineage, and no second computation."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query that is run are removed when it ends, not when the driver collects its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``most`` in sum, and one row at least."""
    first, held = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if held and held + size > most:
            yield first, row
            first, held = row, 0
        held += size
    if first < len(sizes):
        yield first, len(sizes)


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text or binary column without nulls, and where each row's bytes begin (one more entry)."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    held = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[offsets[0] : offsets[-1]], offsets - offsets[0]


SLOT_BITS = 24


def _slot(key: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 64 - SLOT_BITS)


def flagged(df: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """``df`` with ``__flag``: false only where ``key`` is surely not among ``keys`` (one column of the same type).

    The broadcast is a bitmap of ``2 ** SLOT_BITS`` bits, 2^18 rows of 64 bits at most whatever the number of keys. Rows
    without the flag need no shuffle; a join decides about the others. With more keys more rows get the flag.
    """
    slot = _slot(F.col(keys.columns[0]))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)).cast("int"))
    words = materialize(keys.groupBy(F.shiftright(slot, 6).alias("__word")).agg(F.bit_or(bit).alias("__bits")))
    marked = df.withColumn("__slot", _slot(key))
    joined = marked.join(F.broadcast(words), F.shiftright("__slot", 6) == F.col("__word"), "left")
    hit = F.getbit("__bits", F.col("__slot").bitwiseAND(F.lit(63)).cast("int")) == 1
    return joined.withColumn("__flag", F.coalesce(hit, F.lit(False))).drop("__slot", "__word", "__bits")


def without(df: DataFrame, key: str, dropped: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``key`` is not in ``dropped`` (one column); only rows that may be are shuffled."""
    gone = dropped.select(F.col(dropped.columns[0]).alias("__gone"))
    marked = flagged(df, F.col(key), gone)
    free = marked.where(~F.col("__flag")).drop("__flag")
    unsure = marked.where("__flag").drop("__flag")
    return free.unionByName(unsure.join(gone, F.col(key) == F.col("__gone"), "left_anti"))
