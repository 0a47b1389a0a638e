"""Hard negatives of anchors: exact inner products in residue number systems, then a window below each positive.

Vectors become whole numbers, ``floor(256 * x)``. A tile (a block of anchors against a shard of rows) is multiplied once
per small prime: both matrices are reduced to residues of the prime and multiplied in float32, which is exact because
``DEPTH`` products of two residues stay below 2^24. Chinese remaindering (mixed radix digits) puts the signed score
together; a tile takes as many primes as its Cauchy-Schwarz bound needs, so scores are exact at any size of component.

Two passes over the tiles: the first finds the best rows of an anchor's own label, its positives; the second the best
rows of other labels inside the window of each positive. Rows are packed in the order of their labels, so the first pass
joins only tiles whose label ranges meet. Anchor blocks and shards meet in a grid of cells: a block is copied once per
band of shards and a shard once per band of anchors, about the square root of the number of tasks. A task keeps the
best of what it has seen per anchor and hands on one list per anchor and cell.

Rows with a null id, label or vector, or a null or non-finite component, take no part. An anchor leaves out its own row
only: a repeated row may be its positive. Vectors of other lengths than the anchor's are no candidates. Ties go to the
smaller id. An anchor without positives, and a positive without negatives, give no rows; so does an empty table. Other
columns are ignored. A score that is to be returned but doesn't fit 64 bits raises an error.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tidetable.llm.shared import materialize, shuffle_partitions, ship

SCALE = 256
SHARD_ROWS = 2048
ANCHOR_BLOCK = 512
DEPTH = 64  # components per float32 product: 64 * 510**2 < 2**24
LARGEST_PRIME = 1021
HELD_HITS = 1 << 21  # hits a task keeps before it hands them on


def primes() -> Iterator[int]:
    """Primes from ``LARGEST_PRIME`` downwards."""
    for n in range(LARGEST_PRIME, 2, -2):
        if all(n % d for d in range(3, math.isqrt(n) + 1, 2)):
            yield n


def _balanced(values: np.ndarray, prime: int) -> np.ndarray:
    """Residues from ``-(prime - 1) / 2`` to ``(prime - 1) / 2``, in place."""
    values -= np.rint(values * values.dtype.type(1 / prime)) * values.dtype.type(prime)
    half = (prime - 1) // 2
    values[values > half] -= prime
    values[values < -half] += prime
    return values


def _residues(matrix: np.ndarray, prime: int) -> np.ndarray:
    return _balanced(np.fmod(matrix, prime), prime).astype(np.float32)


def _product(left: np.ndarray, right: np.ndarray, prime: int) -> np.ndarray:
    """Inner products of all rows modulo a prime, balanced."""
    a, b = _residues(left, prime), _residues(right, prime)
    total = np.zeros((len(a), len(b)), np.float32)
    for first in range(0, a.shape[1], DEPTH):
        part = slice(first, first + DEPTH)
        total = _balanced(total + _balanced(a[:, part] @ b[:, part].T, prime), prime)
    return total


def exact_scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two matrices of whole numbers (float64): int64, or exact objects beyond 2^62."""
    norm = lambda m: math.sqrt(float(np.square(m).sum(axis=1).max(initial=0)))
    with np.errstate(over="ignore"):
        bound = norm(left) * norm(right) * (1 + 1e-6) + 1
    if not math.isfinite(bound):
        raise OverflowError("components too large for exact inner products")
    kind = np.int64 if bound < 2.0**62 else object
    scores, reach = np.zeros((len(left), len(right)), kind), 1
    for prime in primes():
        # the next digit in mixed radix: what this prime's residue says beyond the digits before
        digit = _product(left, right, prime).astype(np.int64)
        if reach > 1:
            digit = (digit - (scores % prime).astype(np.int64)) * pow(reach, -1, prime) % prime
            digit[digit > prime // 2] -= prime
        scores += digit.astype(kind) * reach
        reach *= prime
        if reach > 2 * bound:
            return scores
    raise OverflowError("components too large for exact inner products")


def firsts(group: np.ndarray, score: np.ndarray, ident: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores of each group, ties to the smaller id, in that order."""
    if score.dtype == object:
        score = np.unique(score, return_inverse=True)[1].reshape(-1)  # ranks in the same order
    order = np.lexsort((ident, -score, group))
    sorted_group = group[order]
    begins = np.flatnonzero(np.r_[True, sorted_group[1:] != sorted_group[:-1]]) if len(order) else np.zeros(0, np.int64)
    place = np.arange(len(order)) - np.repeat(begins, np.diff(np.r_[begins, len(order)]))
    return order[place < k]


# --- rows of a task as blocks of vectors of one length

_FIELDS = ["block", "width", "rows", "low", "high", "ids", "marks", "labels", "vectors", "positives"]
_PACKED = "block long, width int, rows int, low long, high long, ids binary, marks binary, labels binary, vectors binary, positives binary"
_PACKED_TYPES = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()] + [pa.binary()] * 5


def _pack(rows_at_most: int):
    """Blocks of at most so many rows. Input columns: id, mark, label, vector, and positives (ids and scores) or none."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = 0
        held: dict[int, list[tuple]] = {}

        def block(width: int) -> pa.RecordBatch:
            nonlocal made
            ids, marks, labels, vectors, positives = (np.concatenate(x) for x in zip(*held.pop(width)))
            number, made = (TaskContext.get().partitionId() << 32) | made, made + 1
            if np.abs(vectors).max(initial=0) < 2**24:
                vectors = vectors.astype(np.float32)
            values = [number, width, len(ids), int(labels.min()), int(labels.max())]
            values += [x.tobytes() for x in (ids, marks, labels, vectors, positives)]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _PACKED_TYPES)], names=_FIELDS)

        for batch in batches:
            ids, marks, labels = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in range(3))
            begins = batch.column(3).offsets.to_numpy()
            flat = batch.column(3).values.to_numpy(zero_copy_only=False)
            sizes = np.diff(begins)
            if batch.num_columns > 4:
                pairs = batch.column(4).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(ids), -1)
            else:
                pairs = np.zeros((len(ids), 0), np.int64)
            for width in np.unique(sizes).tolist():
                of_width = np.flatnonzero(sizes == width)
                vectors = flat[begins[of_width][:, None] + np.arange(width)].astype(np.float64).reshape(len(of_width), width)
                at = 0
                while at < len(of_width):
                    parts = held.setdefault(width, [])
                    room = rows_at_most - sum(len(p[0]) for p in parts)
                    chosen = of_width[at : at + room]
                    parts.append((ids[chosen], marks[chosen], labels[chosen], vectors[at : at + room], pairs[chosen]))
                    at += room
                    if at <= len(of_width):
                        yield block(width)
        for width in list(held):
            yield block(width)

    return pack


def _unpack(row: dict, prefix: str = "") -> tuple[np.ndarray, ...]:
    count, width = row[prefix + "rows"], row["width"]
    whole = [np.frombuffer(row[prefix + name], np.int64) for name in ("ids", "marks", "labels")]
    kind = np.float32 if len(row[prefix + "vectors"]) == 4 * count * width else np.float64
    vectors = np.frombuffer(row[prefix + "vectors"], kind).astype(np.float64).reshape(count, width)
    return *whole, vectors


# --- tiles

_HITS = "mark long, anchor_id long, slot int, positive_id long, positive_score long, vec_id long, score long"
_HITS_SCHEMA = pa.schema(
    [(n, pa.int32() if n == "slot" else pa.int64()) for n in ("mark", "anchor_id", "slot", "positive_id", "positive_score", "vec_id", "score")]
)


def _rows_of(columns: list) -> pa.RecordBatch:
    try:
        return pa.RecordBatch.from_arrays([pa.array(c.tolist(), f.type) for c, f in zip(columns, _HITS_SCHEMA)], schema=_HITS_SCHEMA)
    except (OverflowError, pa.ArrowInvalid) as error:
        raise OverflowError("a score does not fit 64 bits") from error


def _kept(choose, k: int):
    """Best hits per anchor and slot over all tiles of a task; ``choose`` names the hits of one tile."""

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                hits = choose(row, exact_scores(_unpack(row, "a_")[3], _unpack(row)[3]))
                if not len(hits[0]):
                    continue
                before = held.get(row["a_block"])
                hits = [np.concatenate(x) for x in zip(before, hits)] if before else hits
                keep = firsts(hits[0] * 64 + hits[2], hits[6], hits[5], k)
                held[row["a_block"]] = [x[keep] for x in hits]
            if sum(len(x[0]) for x in held.values()) > HELD_HITS:
                yield from (_rows_of([x[1], *x[7:], *x[2:7]]) for x in held.values())
                held = {}
        yield from (_rows_of([x[1], *x[7:], *x[2:7]]) for x in held.values())

    return best


def _positives_of(row: dict, scores: np.ndarray) -> list[np.ndarray]:
    """Hits of the anchors' own labels: row, mark, slot, two unused, id, score, anchor id."""
    ids, marks, labels, _ = _unpack(row)
    a_ids, a_marks, a_labels, _ = _unpack(row, "a_")
    fits = (a_labels[:, None] == labels[None, :]) & (a_marks[:, None] != marks[None, :])
    at, of = np.nonzero(fits)
    none = np.zeros(len(at), np.int64)
    return [at, a_marks[at], none, none, none, ids[of], scores[at, of], a_ids[at]]


def _negatives_of(slots: int):
    def hits(row: dict, scores: np.ndarray) -> list[np.ndarray]:
        """Hits of other labels inside a positive's window, from four fifths of its score up to the score."""
        ids, _, labels, _ = _unpack(row)
        a_ids, a_marks, a_labels, _ = _unpack(row, "a_")
        pairs = np.frombuffer(row["a_positives"], np.int64).reshape(len(a_ids), slots, 3)
        out: list[list[np.ndarray]] = []
        other = a_labels[:, None] != labels[None, :]
        for slot in range(slots):
            given, top = pairs[:, slot, 0] == 1, pairs[:, slot, 2]
            least = top - top // 5  # 80 * top <= 100 * score, without the products
            inside = other & given[:, None] & (scores >= least[:, None]) & (scores <= top[:, None])
            at, of = np.nonzero(inside)
            out.append([at, a_marks[at], np.full(len(at), slot), pairs[at, slot, 1], top[at], ids[of], scores[at, of], a_ids[at]])
        return [np.concatenate(x) for x in zip(*out)]

    return hits


def _cells(blocks: DataFrame, shards: DataFrame, n_anchors: int, n_rows: int, meet: Column) -> DataFrame:
    """Every anchor block with every shard of its width that it has to meet, dealt over a grid of cells."""
    tasks = shuffle_partitions(shards.sparkSession)
    across = min(max(1, round(math.sqrt(tasks * n_rows / max(n_anchors, 1)))), tasks)
    down = math.ceil(tasks / across)
    left = blocks.select(*[F.col(c).alias(f"a_{c}") for c in _FIELDS])
    band = F.pmod(F.xxhash64("a_block"), F.lit(down)).cast("int")
    left = left.withColumn("a_cell", F.explode(F.sequence(band * across, band * across + (across - 1))))
    band = F.pmod(F.xxhash64("block"), F.lit(across)).cast("int")
    right = shards.withColumn("cell", F.explode(F.sequence(band, band + across * (down - 1), F.lit(across))))
    # no broadcast: the planner knows the size of the blocks, not of their copies, which would all go through the driver
    return right.join(left.hint("merge"), (F.col("cell") == F.col("a_cell")) & (F.col("width") == F.col("a_width")) & meet).drop("positives")


def _packed(rows: DataFrame, n_rows: int, at_most: int) -> DataFrame:
    """Blocks of rows in the order of their labels; a task that runs again makes the same blocks."""
    parts = max(1, math.ceil(n_rows / (16 * at_most)))
    return rows.repartitionByRange(parts, "label", "mark").sortWithinPartitions("label", "mark").mapInArrow(_pack(at_most), _PACKED)


def _floor(x: Column) -> Column:
    """``floor(256 * x)`` as a double: scaling is exact, and beyond 2^53 a double is whole."""
    scaled = x * float(SCALE)
    return F.when(F.abs(scaled) < float(1 << 53), F.floor(scaled).cast("double")).otherwise(scaled)


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    label: Column,
    positives: int = 5,
    negatives: int = 5,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    anchor_block: int = ANCHOR_BLOCK,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows ``anchors`` holds for."""
    spark = vectors.sparkSession
    ship(spark)
    given = vectors.select(
        F.col(vec_id).cast("long").alias("id"),
        F.monotonically_increasing_id().alias("mark"),
        label.cast("long").alias("label"),
        F.col(embedding).cast("array<double>").alias("vector"),
        F.coalesce(anchors, F.lit(False)).alias("__anchor"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    given = given.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)
    # written once: the marks that tell a row from its copies have to be the same on both sides
    given = materialize(given.withColumn("vector", F.transform("vector", _floor)))
    columns = ["id", "mark", "label", "vector"]
    asked = given.where("__anchor").select(*columns)
    n_rows, n_anchors = given.count(), asked.count()
    shards = materialize(_packed(given.select(*columns), n_rows, shard_rows))

    blocks = _packed(asked, n_anchors, anchor_block)
    same = (F.col("low") <= F.col("a_high")) & (F.col("a_low") <= F.col("high"))
    found = _cells(blocks, shards, n_anchors, n_rows, same).mapInArrow(_kept(_positives_of, positives), _HITS)
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("down"), "vec_id", "score"))), 1, positives)
    found = found.groupBy(F.col("mark").alias("__mark")).agg(best.alias("best"))

    # per slot whether there is a positive, its id and its score
    slot = lambda i: F.get("best", i)
    triple = lambda i: F.array(slot(i).isNotNull().cast("long"), F.coalesce(slot(i)["vec_id"], F.lit(0).cast("long")), F.coalesce(slot(i)["score"], F.lit(0).cast("long")))
    asked = asked.join(found, F.col("mark") == F.col("__mark")).select(*columns, F.flatten(F.array(*[triple(i) for i in range(positives)])).alias("positives"))
    blocks = _packed(asked, n_anchors, anchor_block)
    differ = ~((F.col("low") == F.col("high")) & (F.col("a_low") == F.col("low")) & (F.col("a_high") == F.col("low")))
    found = _cells(blocks, shards, n_anchors, n_rows, differ).mapInArrow(_kept(_negatives_of(positives), negatives), _HITS)
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("down"), "vec_id", "score"))), 1, negatives)
    lists = found.groupBy("mark", "anchor_id", "slot", "positive_id", "positive_score").agg(best.alias("best"))
    return lists.select("anchor_id", "positive_id", "positive_score", F.posexplode("best").alias("place", "hit")).select(
        "anchor_id",
        "positive_id",
        (F.col("place") + 1).cast("int").alias("rank"),
        F.col("hit.vec_id").alias("negative_id"),
        "positive_score",
        F.col("hit.score").alias("negative_score"),
    )
