"""Removal of repeated byte strings by a suffix sort that compares by hashes.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts anywhere else in any text. Strings that are
equal choose the same place in themselves, the least hash of ``GRAM`` bytes, leftmost among equals. These places
(anchors, one per about 137 bytes) bring equal strings together without shuffling texts: strings can be equal only if
their anchors have one hash, a run, and lie equally deep in them.

An anchor's context is all strings that choose it. Contexts equal as a whole, told by a 128-bit digest, need no
comparison, and a task sends one of them. Of runs of more than ``RUN`` different contexts the strings meet by a 128-bit
digest each, so no task holds such a run. What is left, smaller runs with different contexts, is sorted: the suffixes of the
contexts that hold the anchor equally deep, by a mergesort in which two suffixes are compared in a logarithmic number
of steps. Prefix sums of a polynomial hash give the hash of any stretch, and a binary search over them the length of
the common beginning. Neighbours in the sorted order that share ``LENGTH`` bytes are repeated. All neighbours are
checked on their bytes; where a hash misled, the suffixes that were sorted together are settled on their bytes.

Null texts are empty; texts shorter than ``LENGTH`` keep everything. A repeated row makes its text occur elsewhere.
Other columns are ignored. Long texts are worked on in stretches, so memory is bounded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidetable.llm.hashing import mixed, prefix_sums, stretch
from tidetable.llm.shared import bytes_of, flagged, materialize, shuffle_partitions, ship, slices, text_of

LENGTH = 400
GRAM = 128
BYTES_AT_ONCE = 1 << 20
_PLACE_BITS = 24
_PLACES = np.uint64((1 << _PLACE_BITS) - 1)
RUN = 2048  # contexts of one run that are sorted in one task
STRETCH = 1 << 22  # starts of a long text worked on at once; with their strings below 2 ** _PLACE_BITS


def anchors(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of texts one after the other: the text, place, first and last start of every anchor, and the hash at it."""
    none = np.zeros(0, np.int64)
    n_starts = len(data) - LENGTH + 1
    if n_starts <= 0:
        return none, none, none, none, none.view(np.uint64)
    at = np.arange(len(data) - GRAM + 1)
    grams = mixed(stretch(prefix_sums(data), at, at + GRAM), 1)
    least, size, window = (grams & ~_PLACES) | at.astype(np.uint64), 1, LENGTH - GRAM + 1
    while size * 2 <= window:
        least, size = np.minimum(least[:-size], least[size:]), size * 2
    if size < window:
        least = np.minimum(least[: len(least) - (window - size)], least[window - size :])
    chosen = (least & _PLACES).astype(np.int64)
    lengths = np.diff(begins)
    text = np.repeat(np.arange(len(lengths)), lengths)
    inside = text[:n_starts] == text[LENGTH - 1 :]
    fresh = np.r_[True, (chosen[1:] != chosen[:-1]) | ~inside[:-1]] & inside
    first = np.flatnonzero(fresh)
    done = inside & np.r_[fresh[1:] | ~inside[1:], True]
    last = np.flatnonzero(done)
    place = chosen[first]
    return text[first], place, first, last, grams[place]


_FOUND = pa.schema([
    ("run", pa.int64()), ("high", pa.int64()), ("low", pa.int64()), ("doc_id", pa.int64()), ("print", pa.int64()),
    ("place", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("settled", pa.bool_()),
])
_FOUND_DDL = "run long, high long, low long, doc_id long, print long, place long, first long, last long, settled boolean"


def _batch(columns: list[np.ndarray], no_id: np.ndarray, schema: pa.Schema) -> pa.RecordBatch:
    arrays = [pa.array(c, f.type, mask=no_id if f.name == "doc_id" else None) for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors of a task's texts. Contexts that the task holds more than once are settled: all of them are repeated.

    Of such contexts one goes on to meet others (``run`` set); the others only carry their result (``run`` null).
    """
    parts: list[list[np.ndarray]] = []
    for batch in batches:
        ids, prints = batch.column(0), batch.column(1).to_numpy()
        missing = ids.is_null().to_numpy(zero_copy_only=False)
        ids = ids.fill_null(0).to_numpy()
        data, begins = bytes_of(batch.column(2))
        for a, b in slices(np.diff(begins), BYTES_AT_ONCE):
            for start in range(int(begins[a]), int(begins[b]), STRETCH):
                # more than one round for a single long text only
                piece = data[start : min(start + STRETCH + LENGTH - 1, int(begins[b]))]
                cuts = np.clip(begins[a : b + 1] - start, 0, len(piece))
                text, place, first, last, grams = anchors(piece, cuts)
                digests = b"".join(
                    hashlib.blake2b(piece[f : e + LENGTH].tobytes() + (p - f).to_bytes(4), digest_size=16).digest()
                    for f, e, p in zip(first.tolist(), last.tolist(), place.tolist())
                )
                named = np.frombuffer(digests, np.int64).reshape(-1, 2)
                shift, row = start - begins[a + text], a + text
                parts.append([
                    grams.view(np.int64), named[:, 0], named[:, 1], ids[row], prints[row],
                    place + shift, first + shift, last + shift, missing[row],
                ])
                if b - a > 1:
                    break
    if not parts:
        return
    run, high, low, ids, prints, place, first, last, missing = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((low, high))
    high, low = high[order], low[order]
    fresh = np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])][: len(order)]
    sizes = np.diff(np.r_[np.flatnonzero(fresh), len(order)])
    settled = np.repeat(sizes > 1, sizes)
    rest = [c[order] for c in (ids, prints, place, first, last)]
    batch = _batch([run[order], high, low, *rest, settled], missing[order], _FOUND)
    yield batch.set_column(0, "run", pa.array(run[order], pa.int64(), mask=~fresh))


_CLASSES = pa.schema([
    ("run", pa.int64()), ("doc_id", pa.int64()), ("print", pa.int64()),
    ("place", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("settled", pa.bool_()), ("chosen", pa.bool_()),
])
_CLASSES_DDL = "run long, doc_id long, print long, place long, first long, last long, settled boolean, chosen boolean"


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts, sorted by digest: whether an equal one settles them, and of equal ones the first as chosen."""
    last, open_rows = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch] if open_rows is None else [*open_rows, batch])
        high, low = table.column("high").to_numpy(), table.column("low").to_numpy()
        starts = np.flatnonzero(np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])])
        # the last two rows stay: with them it is known whether the digest goes on
        first_open = max(int(starts[-1]), len(table) - 2)
        yield from _told(table, starts, first_open, last)
        last = (int(high[first_open - 1]), int(low[first_open - 1])) if first_open else last
        open_rows = table.slice(first_open).combine_chunks().to_batches()
    if open_rows is not None:
        table = pa.Table.from_batches(open_rows)
        high, low = table.column("high").to_numpy(), table.column("low").to_numpy()
        starts = np.flatnonzero(np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])])
        yield from _told(table, starts, len(table), last)


def _told(table: pa.Table, starts: np.ndarray, end: int, last: tuple[int, int] | None) -> Iterator[pa.RecordBatch]:
    if not end:
        return
    sizes = np.diff(np.r_[starts, len(table)])
    settled = np.logical_or.reduceat(table.column("settled").to_numpy(), starts) | (sizes > 1)
    chosen = np.zeros(len(table), bool)
    chosen[starts] = True
    if last == (table.column("high")[0].as_py(), table.column("low")[0].as_py()):
        settled[0], chosen[0] = True, False
    settled = np.repeat(settled, sizes)
    columns = [table.column(c).combine_chunks() for c in ("run", "doc_id", "print", "place", "first", "last")]
    told = pa.RecordBatch.from_arrays([*columns, pa.array(settled), pa.array(chosen)], schema=_CLASSES)
    yield told.slice(0, end)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the contexts that are to be compared."""
    names = ["run", "doc_id", "print", "depth", "first", "settled", "bytes"]
    for batch in batches:
        rows: list[tuple] = []
        for doc_id, fingerprint, text, wanted in zip(*(batch.column(i) for i in range(4))):
            held = memoryview(text.as_buffer())
            for x in wanted.as_py():
                part = bytes(held[x["first"] : x["last"] + LENGTH])
                rows.append((x["run"], doc_id.as_py(), fingerprint.as_py(), x["place"] - x["first"], x["first"], x["settled"], part))
        types = [pa.int64()] * 5 + [pa.bool_(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 7, types)], names=names)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of contexts of large runs, the digest of every string of ``LENGTH`` bytes and where it starts."""
    for batch in batches:
        for doc_id, fingerprint, text, wanted in zip(*(batch.column(i) for i in range(4))):
            held = memoryview(text.as_buffer())
            for x in wanted.as_py():
                starts = range(x["first"], x["last"] + 1)
                named = b"".join(hashlib.blake2b(held[i : i + LENGTH], digest_size=16).digest() for i in starts)
                named = np.frombuffer(named, np.int64).reshape(-1, 2)
                n = len(named)
                columns = [
                    pa.array(named[:, 0].copy()), pa.array(named[:, 1].copy()), pa.array([doc_id.as_py()] * n, pa.int64()),
                    pa.array(np.full(n, fingerprint.as_py())), pa.array(np.arange(starts.start, starts.stop)), pa.array(np.full(n, x["settled"])),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["high", "low", "doc_id", "print", "first", "settled"])


class SuffixOrder:
    """Suffixes of byte strings, compared over ``LENGTH`` bytes by the hashes of their common beginnings."""

    def __init__(self, data: np.ndarray):
        self.data, self.sums = data, prefix_sums(data)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many bytes from ``a`` and ``b`` on are equal, ``LENGTH`` at most; exact but for colliding hashes."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), LENGTH)
        while (low < high).any():
            middle = (low + high + 1) // 2
            equal = stretch(self.sums, a, a + middle) == stretch(self.sums, b, b + middle)
            low, high = np.where(equal, middle, low), np.where(equal, high, middle - 1)
        return low

    def before(self, a: np.ndarray, b: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Whether the suffix at ``a`` comes before that at ``b``."""
        shared = self.common(a, b)
        same = shared == LENGTH
        next_byte = np.minimum(shared, LENGTH - 1)
        return np.where(same, or_equal, self.data[a + next_byte] < self.data[b + next_byte])

    def sort(self, places: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Places sorted within their groups, which begin at ``first``: a mergesort of all groups at once."""
        places = places.copy()
        group_first, group_size = np.repeat(first, sizes), np.repeat(sizes, sizes)
        local = np.arange(len(places)) - group_first
        width = 1
        while width < (sizes.max() if len(sizes) else 0):
            rows = np.flatnonzero(group_size > width)
            block = local[rows] // width
            left = block % 2 == 0
            other = group_first[rows] + np.where(left, block + 1, block - 1) * width
            end = np.minimum(other + width, group_first[rows] + group_size[rows])
            # how many of the other block come before: strictly for the left block, so that equal ones keep their order
            low, high = np.minimum(other, end), end.copy()
            low_start = low.copy()
            while len(open_rows := np.flatnonzero(low < high)):
                middle = (low[open_rows] + high[open_rows]) // 2
                ahead = self.before(places[middle], places[rows[open_rows]], ~left[open_rows])
                low[open_rows] = np.where(ahead, middle + 1, low[open_rows])
                high[open_rows] = np.where(ahead, high[open_rows], middle)
            target = group_first[rows] + (block // 2) * 2 * width + local[rows] % width + (low - low_start)
            merged = places.copy()
            merged[target] = places[rows]
            places = merged
            width *= 2
        return places

    def repeated(self, places: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The places whose ``LENGTH`` bytes occur again in their group, checked on the bytes."""
        ordered = self.sort(places, first, sizes)
        group = np.repeat(np.arange(len(sizes)), sizes)
        near = np.flatnonzero(group[1:] == group[:-1])
        windows = np.lib.stride_tricks.sliding_window_view(self.data, LENGTH)
        same, misled = np.zeros(len(near), bool), np.zeros(len(near), bool)
        for at in range(0, len(near), 4096):
            rows = near[at : at + 4096]
            a, b = windows[ordered[rows]], windows[ordered[rows + 1]]
            differ = a != b
            place = differ.argmax(axis=1)
            line = np.arange(len(rows))
            same[at : at + 4096] = ~differ[line, place]
            misled[at : at + 4096] = a[line, place] > b[line, place]
        # a hash that misled puts neighbours in the wrong order, or a place into two
        stray = np.sort(ordered + group * len(self.data)) != np.sort(places + group * len(self.data))
        doubtful = np.unique(np.r_[group[near[misled]], group[stray]])
        sure = near[same & ~np.isin(group[near], doubtful)]
        found = [ordered[sure], ordered[sure + 1]]
        for g in doubtful.tolist():
            by_bytes: dict[bytes, list[int]] = {}
            for place in places[group == g].tolist():
                by_bytes.setdefault(windows[place].tobytes(), []).append(place)
            found += [np.array(x) for x in by_bytes.values() if len(x) > 1]
        return np.unique(np.concatenate(found))


def repeated_starts(held: list[bytes], depths: np.ndarray, runs: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Per context (row) the first and last of neighbouring starts whose strings occur in another context of its run."""
    data = np.frombuffer(b"".join(held), np.uint8)
    sizes = np.fromiter(map(len, held), np.int64, len(held))
    bases = np.cumsum(sizes) - sizes
    counts = sizes - LENGTH + 1
    row = np.repeat(np.arange(len(held)), counts)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    _, run = np.unique(runs, return_inverse=True)
    key = run[row] * LENGTH + (depths[row] - offset)
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.r_[True, np.diff(key[order]) != 0])
    group_sizes = np.diff(np.r_[first, len(order)])
    wide = np.repeat(group_sizes > 1, group_sizes)
    group_sizes = group_sizes[group_sizes > 1]
    places = (bases[row] + offset)[order[wide]]
    found = SuffixOrder(data).repeated(places, np.cumsum(group_sizes) - group_sizes, group_sizes)
    if not len(found):
        return
    of = np.searchsorted(bases, found, side="right") - 1
    cut = np.flatnonzero(np.r_[True, (np.diff(found) != 1) | (np.diff(of) != 0), True])
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
        yield int(of[a]), int(found[a] - bases[of[a]]), int(found[b - 1] - bases[of[a]])


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [batch for batch in batches if batch.num_rows]
    if not parts:
        return
    table = pa.Table.from_batches(parts)
    table = table.take(pa.array(np.argsort(table.column("run").to_numpy(), kind="stable")))
    runs = table.column("run").to_numpy()
    cuts = np.flatnonzero(np.r_[True, np.diff(runs) != 0, True])
    sizes = np.add.reduceat(np.array([len(x.as_buffer()) for x in table.column("bytes")]), cuts[:-1])
    for a, b in slices(sizes, BYTES_AT_ONCE):
        part = table.slice(cuts[a], cuts[b] - cuts[a])
        found = repeated_starts(part.column("bytes").to_pylist(), part.column("depth").to_numpy(), part.column("run").to_numpy())
        rows = np.array(list(found), np.int64).reshape(-1, 3)
        rows = rows[~part.column("settled").to_numpy()[rows[:, 0]]]
        of = part.take(pa.array(rows[:, 0])).combine_chunks()
        begin = of.column("first").to_numpy()
        yield pa.RecordBatch.from_arrays(
            [of.column("doc_id").combine_chunks(), of.column("print").combine_chunks(), pa.array(begin + rows[:, 1]), pa.array(begin + rows[:, 2])],
            names=["doc_id", "print", "first", "last"],
        )


def spans_of(ranges: list[dict]) -> list[tuple[int, int]]:
    """Ranges of starts as maximal runs of covered bytes, ends exclusive."""
    spans: list[tuple[int, int]] = []
    for first, last in sorted((x["first"], x["last"] + LENGTH) for x in ranges):
        if spans and first <= spans[-1][1]:
            spans[-1] = spans[-1][0], max(spans[-1][1], last)
        else:
            spans.append((first, last))
    return spans


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "spans", "kept"]
    kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        sizes, all_spans, kept = [], [], []
        for text, ranges in zip(batch.column(1), batch.column(2)):
            held, at, left = memoryview(text.as_buffer()), 0, []
            spans = spans_of(ranges.as_py() or [])
            for first, end in spans:
                left.append(held[at:first])
                at = end
            left.append(held[at:])
            sizes.append(len(held))
            all_spans.append([{"first": a, "end": b} for a, b in spans])
            kept.append(b"".join(left))
        columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(all_spans, kind), pa.array(kept, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row ``doc_id, n_bytes, spans, kept``: the removed runs of bytes and the bytes that are left."""
    spark = docs.sparkSession
    ship(spark)
    body = text_of(text)
    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(body).alias("print"), F.encode(body, "utf-8").alias("body"))
    long_enough = given.where(F.octet_length("body") >= LENGTH)
    contexts = materialize(long_enough.mapInArrow(_contexts, _FOUND_DDL))
    partitions = shuffle_partitions(spark)
    met = contexts.where("run IS NOT NULL").repartition(partitions, "high", "low").sortWithinPartitions("high", "low")
    met = materialize(met.mapInArrow(_classes, _CLASSES_DDL))
    counts = met.where("chosen").groupBy("run").agg(F.count("*").alias("n"), F.bool_or(~F.col("settled")).alias("open"))
    runs = counts.where("n > 1 AND open").select("run", (F.col("n") > RUN).alias("large"))
    compare = materialize(met.where("chosen").drop("chosen").join(runs, "run"))

    request = F.struct("run", "place", "first", "last", "settled")
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("print") == F.col("__print"))

    def with_texts(chosen: DataFrame) -> DataFrame:
        asked = materialize(chosen.groupBy("doc_id", "print").agg(F.collect_list(request).alias("wanted")))
        asked = asked.withColumnsRenamed({"doc_id": "__id", "print": "__print"})
        holders = flagged(long_enough, F.col("print"), asked.select("__print")).where("__flag")
        return holders.join(asked, same).select("doc_id", "print", "body", "wanted")

    wanted = with_texts(compare.where(~F.col("large")))
    cut = wanted.mapInArrow(_cut, "run long, doc_id long, print long, depth long, first long, settled boolean, bytes binary")
    compared = cut.repartition(partitions, "run").mapInArrow(_compared, "doc_id long, print long, first long, last long")
    large = compare.where("large")
    if not large.isEmpty():
        ddl = "high long, low long, doc_id long, print long, first long, settled boolean"
        strings = materialize(with_texts(large).mapInArrow(_digested, ddl))
        twice = strings.groupBy("high", "low").agg(F.count("*").alias("n")).where("n > 1").drop("n")
        found = strings.where(~F.col("settled")).join(twice, ["high", "low"])
        compared = compared.unionByName(found.select("doc_id", "print", "first", F.col("first").alias("last")))

    columns = ["doc_id", "print", "first", "last"]
    ranges = contexts.where("settled").select(*columns).unionByName(met.where("settled").select(*columns)).unionByName(compared)
    held = materialize(ranges.groupBy("doc_id", "print").agg(F.collect_list(F.struct("first", "last")).alias("ranges")))
    held = held.withColumnsRenamed({"doc_id": "__id", "print": "__print"})
    marked = flagged(given, F.col("print"), held.select("__print"))
    untouched = marked.where(~F.col("__flag")).select(
        "doc_id",
        F.octet_length("body").cast("long").alias("n_bytes"),
        F.array().cast("array<struct<first:long,end:long>>").alias("spans"),
        F.col("body").alias("kept"),
    )
    touched = marked.where("__flag").join(held, same, "left").select("doc_id", "body", "ranges")
    cleaned = touched.mapInArrow(_removed, "doc_id long, n_bytes long, spans array<struct<first:long,end:long>>, kept binary")
    return untouched.unionByName(cleaned)


def digests(cleaned: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of what `without_repeats` left, then the rest itself.

    ``n_bytes`` is the length of the input. ``n_kept`` is that of what is left, and ``text`` is it as a text, in which bytes of a
    character that was cut apart show as the replacement character.
    """
    return cleaned.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        F.octet_length("kept").cast("long").alias("n_kept"),
        F.make_valid_utf8(F.col("kept").cast("string")).alias("text"),
    )
