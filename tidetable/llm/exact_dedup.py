"""Exact duplicates of whole texts by counting quotient filters.

Every task builds a counting quotient filter of the 64-bit fingerprints of its texts: the leading bits of a
fingerprint (its quotient) name a run, the run holds the remaining bits sorted, each with a count. Nothing of a
fingerprint is lost, so filters merge by merging their sorted runs and adding counts. A filter travels in blocks of
neighbouring quotients, one shuffled row per task and block, and is far smaller than the texts.

Fingerprints whose merged count is above one set a bit in a bitmap of fixed size (``BLOCKS * WORDS`` longs, 2 MB,
whatever the input). Texts whose bit is not set are unique and pass without a shuffle. The others are compared byte
by byte: grouped by the text itself, combined before the shuffle, so a group of copies costs one row per task.

Null texts are empty texts. A repeated row counts as a copy. Rows with a null id are grouped like others but never
win against a row with an id. Other columns are ignored by `duplicate_groups` and kept by `drop_duplicates`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidetable.llm.shared import materialize, ship, text_of

QUOTIENT_BITS = 12
BLOCKS = 256
WORDS = 1024
_SLOT_BITS = 16  # bits of a fingerprint that choose a bit of a block's words: 1024 words of 64


class CountingQuotientFilter:
    """Sorted runs of remainders with counts, one run per quotient; equal contents have equal forms."""

    def __init__(self, fingerprints: np.ndarray, counts: np.ndarray, remainder_bits: int = 64 - QUOTIENT_BITS):
        self.remainder_bits = remainder_bits
        order = np.argsort(fingerprints, kind="stable")
        held = fingerprints[order]
        first = np.flatnonzero(np.r_[True, held[1:] != held[:-1]]) if len(held) else np.zeros(0, np.int64)
        held = held[first]
        quotients = (held >> np.uint64(remainder_bits)).astype(np.int64)
        runs = 1 << (64 - remainder_bits)
        self.run_starts = np.searchsorted(quotients, np.arange(runs + 1))
        self.remainders = held & np.uint64((1 << remainder_bits) - 1)
        self.counts = np.add.reduceat(counts[order], first) if len(first) else np.zeros(0, np.int64)

    def fingerprints(self) -> np.ndarray:
        """What the filter holds, in order: each run's quotient put back before its remainders."""
        quotients = np.repeat(np.arange(len(self.run_starts) - 1), np.diff(self.run_starts)).astype(np.uint64)
        return (quotients << np.uint64(self.remainder_bits)) | self.remainders

    def merged(self, other: CountingQuotientFilter) -> CountingQuotientFilter:
        """Both contents in one filter, counts added."""
        return CountingQuotientFilter(
            np.concatenate([self.fingerprints(), other.fingerprints()]),
            np.concatenate([self.counts, other.counts]),
            self.remainder_bits,
        )


_BLOCK_SCHEMA = pa.schema([("block", pa.int32()), ("held", pa.binary()), ("counts", pa.binary())])


def _filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The filter of a task's fingerprints, in blocks of neighbouring quotients."""
    total = CountingQuotientFilter(np.zeros(0, np.uint64), np.zeros(0, np.int64))
    for batch in batches:
        new = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        total = total.merged(CountingQuotientFilter(new, np.ones(len(new), np.int64)))
    held, counts = total.fingerprints(), total.counts
    blocks = (held >> np.uint64(56)).astype(np.int32)
    cuts = np.searchsorted(blocks, np.arange(BLOCKS + 1))
    full = [b for b in range(BLOCKS) if cuts[b] < cuts[b + 1]]
    if full:
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(full, pa.int32()),
                pa.array([held[cuts[b] : cuts[b + 1]].tobytes() for b in full], pa.binary()),
                pa.array([counts[cuts[b] : cuts[b + 1]].tobytes() for b in full], pa.binary()),
            ],
            schema=_BLOCK_SCHEMA,
        )


def _repeated_bits(table: pa.Table) -> pa.Table:
    """Bits of the fingerprints of a block whose counts over all tasks add up to more than one."""
    held = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("held")]
    counts = [np.frombuffer(x.as_py(), np.int64) for x in table.column("counts")]
    total = CountingQuotientFilter(np.concatenate(held), np.concatenate(counts))
    found = total.fingerprints()[total.counts > 1]
    slots = (found >> np.uint64(56 - _SLOT_BITS)) & np.uint64((1 << _SLOT_BITS) - 1)
    words = np.zeros(WORDS, np.uint64)
    np.bitwise_or.at(words, (slots >> np.uint64(6)).astype(np.int64), np.uint64(1) << (slots & np.uint64(63)))
    return pa.table(
        {
            "block": pa.array([table.column("block")[0].as_py()], pa.int32()),
            "words": pa.array([words.view(np.int64).tolist()], pa.list_(pa.int64())),
        }
    )


def repeated_bitmap(fingerprints: DataFrame) -> DataFrame:
    """Bitmap of the fingerprints (first column, long) that occur more than once: at most ``BLOCKS`` rows."""
    ship(fingerprints.sparkSession)
    blocks = fingerprints.mapInArrow(_filters, "block int, held binary, counts binary")
    return blocks.groupBy("block").applyInArrow(_repeated_bits, "block int, words array<long>")


def _with_mark(docs: DataFrame, text: str) -> DataFrame:
    """All rows with ``__text`` and ``__again``: whether the text's fingerprint may occur elsewhere."""
    marked = docs.withColumn("__text", text_of(text))
    bitmap = materialize(repeated_bitmap(marked.select(F.xxhash64("__text"))))
    bitmap = bitmap.select(F.col("block").alias("__block"), F.col("words").alias("__words"))
    fingerprint = F.xxhash64("__text")
    slot = F.shiftrightunsigned(fingerprint, 56 - _SLOT_BITS).bitwiseAND(F.lit((1 << _SLOT_BITS) - 1))
    word = F.shiftright(slot, 6).cast("int")
    again = F.getbit(F.get("__words", word), slot.bitwiseAND(F.lit(63)).cast("int")) == 1
    # a broadcast of BLOCKS rows of WORDS longs: 2 MB at any input size
    joined = marked.join(F.broadcast(bitmap), F.shiftrightunsigned(fingerprint, 56).cast("int") == F.col("__block"), "left")
    return joined.withColumn("__again", F.coalesce(again, F.lit(False))).drop("__block", "__words")


def _digest() -> Column:
    return F.sha2(F.encode("__text", "utf-8"), 256)


def duplicate_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts the largest id is kept. An empty table gives an empty result.
    """
    marked = _with_mark(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("__given")), "__given")
    single = marked.where(~F.col("__again")).select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        _digest().alias("text_sha256"),
    )
    again = marked.where("__again")
    groups = again.groupBy("__text").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    groups = groups.select(_digest().alias("text_sha256"), "keep_id", "group_size")
    # the members follow by digest, so only the bytes of one copy per task and group were shuffled
    rows = again.select("doc_id", _digest().alias("text_sha256"))
    several = rows.join(groups, "text_sha256").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )
    return single.unionByName(several)


def drop_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns: one per text, that with the largest id.

    Of rows with equal id and text the one with the largest other columns stays.
    """
    marked = _with_mark(docs, text)
    names = docs.columns
    single = marked.where(~F.col("__again")).select(*names)
    row = F.struct(*[F.col(c) for c in names if c != text])
    order = F.struct(F.col(doc_id), *[F.col(c).cast("string") for c in names if c not in (doc_id, text)])
    given = F.max(F.col(text).isNotNull()).alias("__given")
    best = marked.where("__again").groupBy("__text").agg(F.max_by(row, order).alias("__row"), given)
    # a null text stays null unless its group also holds the empty text
    several = best.select(
        *[F.when(F.col("__given"), F.col("__text")).alias(c) if c == text else F.col("__row")[c].alias(c) for c in names]
    )
    return single.unionByName(several)
