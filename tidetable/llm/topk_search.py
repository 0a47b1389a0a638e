"""Exact nearest vectors by inner product: tiled matrix products, a selection per tile, merged in a tree.

Vectors become integers (``floor(1024 * x)``) and are packed into shards, one row per shard; queries into blocks of
``QUERY_BLOCK``. Every query block meets every shard once, as a tile of bounded size: the blocks, a hundredth of the
rows, are dealt to groups of shards by an equi-join. A tile keeps the ``k`` best candidates of each of its queries, and a
task one list per query over its tiles; the lists of a query are merged ``FAN_IN`` at a time until one is left.

Vectors that are null or hold null or non-finite components take no part; vectors of another length than a query's
are no candidates for it. A query leaves out its own row only: a repeated row is a candidate. Ties go to the smaller
id. Products are exact: floats where all sums stay below 2^53, integers of 64 bits or of any size otherwise. Where a component,
or a score that is to be returned, does not fit 64 bits an error is raised.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tidetable.llm.shared import materialize, shuffle_partitions, ship

SCALE = 1024
SHARD_ROWS = 2048
QUERY_BLOCK = 512
FAN_IN = 16
HELD_HITS = 1 << 21  # hits a task keeps before it hands them on
LARGEST = (1 << 63) - 1

_PACKED = "shard long, width int, rows int, ids binary, marks binary, vectors binary"


def _pack(rows_at_most: int):
    """Rows of a task as blocks of vectors of one width; ids that are null are marked."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = 0
        held: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}

        def block(width: int, parts) -> pa.RecordBatch:
            nonlocal made
            ids, marks, vectors = (np.concatenate(x) for x in zip(*parts))
            shard, made = (TaskContext.get().partitionId() << 32) | made, made + 1
            most = max(int(vectors.max(initial=0)), -int(vectors.min(initial=0)))
            vectors = vectors.astype(np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64)
            values = [shard, width, len(ids), ids.tobytes(), marks.tobytes(), vectors.tobytes()]
            types = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            names = ["shard", "width", "rows", "ids", "marks", "vectors"]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names=names)

        for batch in batches:
            ids = batch.column(0)
            lists = batch.column(2)
            sizes = np.diff(lists.offsets.to_numpy())
            marks = batch.column(1).to_numpy()
            number = ids.to_numpy(zero_copy_only=False).astype(np.int64)
            flat = lists.values.to_numpy(zero_copy_only=False)
            begins = lists.offsets.to_numpy()
            for width in np.unique(sizes).tolist():
                of_width = np.flatnonzero(sizes == width)
                vectors = flat[begins[of_width][:, None] + np.arange(width)].astype(np.int64).reshape(len(of_width), width)
                for first in range(0, len(of_width), rows_at_most):
                    part = slice(first, first + rows_at_most)
                    chosen = of_width[part]
                    held.setdefault(width, []).append((number[chosen], marks[chosen], vectors[part]))
                    if sum(len(x[0]) for x in held[width]) >= rows_at_most:
                        yield block(width, held.pop(width))
        for width, parts in held.items():
            yield block(width, parts)

    return pack


_FOUND = "shard long, query_mark long, query_id long, best array<struct<score:long,vec_id:long>>"


def _matrix(data: pa.Buffer, rows: int, width: int) -> np.ndarray:
    kind = np.dtype(f"i{len(data) // (rows * width)}") if rows * width else np.int64
    return np.frombuffer(data, kind).reshape(rows, width)


def _scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products of all rows, exact at any size and then held at the ends of what 64 bits can say."""
    left, right = queries.astype(float), vectors.astype(float)
    most = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * max(queries.shape[1], 1)
    if most < 2**53:
        return (left @ right.T).astype(np.int64)
    if most < 2**62:
        return queries.astype(np.int64) @ vectors.astype(np.int64).T
    whole = queries.astype(object) @ vectors.astype(object).T
    return np.minimum(np.maximum(whole, -LARGEST), LARGEST).astype(np.int64)


def _firsts(at: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Of each query the ``k`` highest scores, ties to the smaller id."""
    order = np.lexsort((ids, -score, at))
    at = at[order]
    begins = np.searchsorted(at, at)
    keep = order[np.arange(len(at)) - begins < k]
    return at[np.arange(len(at)) - begins < k], score[keep], ids[keep]


def _tiles(k: int):
    """The best candidates of every query, selected per tile; what a task has seen of a query leaves it as one list."""

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, tuple] = {}  # by the marks of a query block: shard, marks, ids, hits

        def lists() -> Iterator[pa.RecordBatch]:
            for shard, q_marks, q_ids, (at, score, ids) in held.values():
                hits = pa.StructArray.from_arrays([pa.array(score), pa.array(ids)], ["score", "vec_id"])
                ends = pa.array(np.searchsorted(at, np.arange(len(q_ids) + 1)), pa.int32())
                columns = [pa.array(np.full(len(q_ids), shard)), pa.array(q_marks), pa.array(q_ids), pa.ListArray.from_arrays(ends, hits)]
                yield pa.RecordBatch.from_arrays(columns, names=["shard", "query_mark", "query_id", "best"])
            held.clear()

        for batch in batches:
            for row in range(batch.num_rows):
                shard, width = batch.column("shard")[row].as_py(), batch.column("width")[row].as_py()
                ids, marks, q_ids, q_marks = (np.frombuffer(batch.column(c)[row].as_buffer(), np.int64) for c in ("ids", "marks", "q_ids", "q_marks"))
                queries, vectors = (_matrix(batch.column(c)[row].as_buffer(), n, width) for c, n in (("q_vectors", len(q_ids)), ("vectors", len(ids))))
                scores = _scores(queries, vectors)
                own = marks[None, :] == q_marks[:, None]
                scores[own] = -LARGEST - 1  # below all others
                near = ~own
                if scores.shape[1] > k:
                    near &= scores >= np.partition(scores, -k, axis=1)[:, -k:-k + 1]
                at, of = np.nonzero(near)
                at, score, of_ids = _firsts(at, scores[at, of], ids[of], k)
                if len(score) and np.abs(score).max() == LARGEST:
                    raise OverflowError("an inner product does not fit 64 bits")
                block = q_marks.tobytes()
                if block in held:
                    at, score, of_ids = _firsts(*(np.concatenate(x) for x in zip(held[block][3], (at, score, of_ids))), k)
                held[block] = (shard, q_marks.copy(), q_ids.copy(), (at, score, of_ids))
                if sum(len(x[1]) for x in held.values()) * k > HELD_HITS:
                    yield from lists()
        yield from lists()

    return best


def _usable(embedding: str) -> Column:
    values = F.col(embedding)
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return values.isNotNull() & finite


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = 10,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for the rows that ``queries`` holds for, the ``k`` best other rows.

    Null ids are left out. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    ship(spark)
    too_large = F.raise_error(F.lit("a component does not fit 64 bits")).cast("long")
    scaled = lambda x: x.cast("double") * SCALE
    whole = F.transform(F.col("__x"), lambda x: F.when(F.abs(scaled(x)) < float(1 << 62), F.floor(scaled(x))).otherwise(too_large))
    given = (
        vectors.where(F.col(vec_id).isNotNull())
        .withColumn("__query", F.coalesce(queries, F.lit(False)))
        .select(F.col(vec_id).cast("long").alias("id"), F.monotonically_increasing_id().alias("mark"), F.col(embedding).cast("array<double>").alias("__x"), "__query")
        .where(_usable("__x"))
        .select("id", "mark", whole.alias("vector"), "__query")
    )
    # written once: the marks that tell a row from its copies have to be the same on both sides
    given = materialize(given)
    columns = ["id", "mark", "vector"]
    asked = given.where("__query").select(*columns)
    shards = materialize(given.select(*columns).mapInArrow(_pack(shard_rows), _PACKED))
    n_queries = asked.count()
    n_blocks = max(1, math.ceil(n_queries / QUERY_BLOCK))
    blocks = asked.repartition(n_blocks).mapInArrow(_pack(QUERY_BLOCK), _PACKED)
    blocks = blocks.select(*[F.col(c).alias(f"q_{c}") for c in ("width", "ids", "marks", "vectors")])
    # shards fall into groups, and every query block is sent to every group: one copy per group, not per shard
    groups = shuffle_partitions(spark)
    dealt = blocks.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    shards = shards.withColumn("group", F.pmod(F.xxhash64("shard"), F.lit(groups)).cast("int"))
    # no broadcast: the planner knows the size of the blocks, not of their copies, which would all go through the driver
    tiles = shards.join(dealt.hint("merge"), (shards["group"] == dealt["group"]) & (shards["width"] == dealt["q_width"])).select(
        "shard", "width", "ids", "marks", "vectors", "q_ids", "q_marks", "q_vectors"
    )
    return merged(tiles.mapInArrow(_tiles(k), _FOUND), k, min(shards.count(), groups))


def merged(lists: DataFrame, k: int, n_lists: int) -> DataFrame:
    """The lists of every query, one per task, merged in a tree in which about ``FAN_IN`` lists meet at a time."""
    order = lambda x: F.struct((-x["score"]).alias("down"), x["vec_id"].alias("vec_id"), x["score"].alias("score"))
    lists = lists.withColumn("best", F.transform("best", order))
    nodes = FAN_IN ** math.ceil(math.log(max(n_lists, 1), FAN_IN))
    lists = lists.withColumn("__node", F.xxhash64("shard"))
    while nodes:
        nodes = nodes // FAN_IN
        best = F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, k)
        lists = lists.withColumn("__node", F.pmod("__node", F.lit(max(nodes, 1)))).groupBy("query_mark", "query_id", "__node").agg(best.alias("best"))
    ranked = lists.select("query_id", F.posexplode("best").alias("place", "hit"))
    return ranked.select(
        "query_id",
        (F.col("place") + 1).cast("int").alias("rank"),
        F.col("hit.vec_id").alias("vec_id"),
        F.col("hit.score").alias("score"),
    )
