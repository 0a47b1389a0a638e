"""Concatenate and cut: documents as one long row of tokens, cut into windows of a fixed length.

The first pass tokenizes every text once, writes the ids and notes where each document begins within its task. The
token totals of the tasks, summed in order, say where each task begins in the whole. The second pass adds the two and
cuts every document at the window edges. Only the documents over an edge get more than one piece, and only the last
window is short. Nothing but one number per task is gathered.

Null and empty texts are one token, the end mark. Repeated rows are packed like others. Windows follow the order of
tasks, and of rows within them, so they are the same whenever the input splits are.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidetable.llm.chunks import PieceTable, pieces_of
from tidetable.llm.shared import materialize, ship, text_of

WINDOW = 2048
END_ID = 1
SPECIAL, SPECIAL_ID = "<|endoftext|>", 50256  # the added token of the tokenizers file, found inside texts too


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to id."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PieceTokenizer:
    """Ids of texts as bytes, 16 bits each. Pieces not met before are encoded together, in one call per text."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        ranks = read_ranks(path)
        size = max(ranks.values()) + 1
        if size > 1 << 16:
            raise ValueError("ids are kept in 16 bits")
        pattern = public_tokenizers.PATTERN
        self.encode = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.opens = np.zeros(size, bool)  # tokens that begin with a space, as every piece but the first does
        self.opens[[rank for token, rank in ranks.items() if token[:1] == b" "]] = True
        self.table = PieceTable()

    def ids(self, text: str) -> bytes:
        if SPECIAL in text:
            return np.array([SPECIAL_ID], np.uint16).tobytes().join([self.ids(x) if x else b"" for x in text.split(SPECIAL)])
        pieces = pieces_of(text)
        if pieces is None or len(pieces) < 3:
            return np.array(self.encode(text), np.uint16).tobytes()
        found: list[bytes | None] = [self._plain(pieces[0]), *map(self.table.held.get, pieces[1:])]
        missing = [i for i, ids in enumerate(found) if ids is None]
        if missing:
            new = np.array(self.encode(" " + " ".join([pieces[i] for i in missing])), np.uint16)
            cuts = (np.flatnonzero(self.opens[new]) * 2).tolist()
            new, cuts = new.tobytes(), [*cuts, len(new) * 2]
            for k, i in enumerate(missing):
                found[i] = new[cuts[k] : cuts[k + 1]]
                self.table.put(pieces[i], found[i])
        return b"".join(found)

    def _plain(self, piece: str) -> bytes:
        return np.array(self.encode(piece), np.uint16).tobytes()


@lru_cache(maxsize=2)
def _tokenizer_of(path: str) -> PieceTokenizer:
    return PieceTokenizer(path)


_TOKENS = pa.schema([("task", pa.int32()), ("first", pa.int64()), ("doc_id", pa.int64()), ("ids", pa.binary())])


def _tokenizer(path: str):
    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, task, first = _tokenizer_of(path).ids, TaskContext.get().partitionId(), 0
        end = np.array([END_ID], np.uint16).tobytes()
        for batch in batches:
            ids, starts = [], []
            for text in batch.column(1):
                ids.append(ids_of(text.as_py()) + end)
                starts.append(first)
                first += len(ids[-1]) // 2
            columns = [pa.array([task] * len(ids), pa.int32()), pa.array(starts, pa.int64()), batch.column(0), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema=_TOKENS)

    return tokens


def tokenized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ranks: str | None = None) -> DataFrame:
    """``task, first, doc_id, ids``: the ids (16 bits each, end mark included) and where they begin in their task."""
    ship(docs.sparkSession)
    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    return given.mapInArrow(_tokenizer(ranks or default_ranks()), "task int, first long, doc_id long, ids binary")


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _cutter(window: int, with_ids: bool):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            begins = batch.column(0).to_numpy(zero_copy_only=False)
            for begin, doc, held in zip(begins.tolist(), batch.column(1).to_pylist(), batch.column(2)):
                ids = np.frombuffer(held.as_buffer(), np.uint16).astype("<u4")
                start, total = 0, len(ids)
                while start < total:
                    sequence, offset = divmod(begin + start, window)
                    length = min(window - offset, total - start)
                    part = ids[start : start + length].tobytes()
                    rows.append((doc, start, length, zlib.crc32(part), total, sequence, offset) + ((part,) if with_ids else ()))
                    start += length
            columns = list(zip(*rows)) or [()] * (7 + with_ids)
            arrays = [pa.array(c, pa.int64()) for c in columns[:7]] + [pa.array(c, pa.binary()) for c in columns[7:]]
            yield pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in PIECES.split(", ")] + ["ids"] * with_ids)

    return pieces


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    ranks: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: its place in its document and in its window; ``with_ids`` adds the ids, 32 bits each."""
    held = materialize(tokenized(docs, doc_id, text, ranks))
    ends = held.groupBy("task").agg(F.max(F.col("first") + F.octet_length("ids") / 2).cast("long").alias("total"))
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    begins = ends.select("task", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    # one row of two numbers per task of the first pass
    placed = held.join(F.broadcast(begins), "task").select((F.col("base") + F.col("first")).alias("begin"), "doc_id", "ids")
    return placed.mapInArrow(_cutter(window, with_ids), PIECES + (", ids binary" if with_ids else ""))


def windows(pieces: DataFrame) -> DataFrame:
    """The packed windows of `pack` with ids: ``sequence_id, length, ids``, each joined from at most ``length`` pieces."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    joined = F.aggregate("parts", F.lit(b""), lambda done, part: F.concat(done, part["ids"]))
    return pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts")).select(
        "sequence_id", "length", joined.alias("ids")
    )
