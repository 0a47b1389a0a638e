"""Near-duplicate documents: an exact Jaccard join of word shingles over count vectors.

Texts of equal shingle sets form a class, and only classes are compared. A class is a point: its shingles fall by hash
into groups, one or two to a shingle, and the coordinates are the counts per group. Two sets cannot share more shingles
than the sum of the smaller coordinates, and an R-tree of points gives the same bound for a whole node from its upper
corner. Pairs whose bound is high enough are verified on the sets.

Trees are built where pairs can meet. Of each set the rarest ``n - ceil(0.8 n) + 1`` shingles are posted; two sets that
link share a posted one. Rarity is read from a table of counts by hash of fixed size, filled from all documents, so
shingles of shared passages hardly get posted. Classes that meet at a shingle form a block; equal blocks are kept once.
Blocks of more than ``PART_BYTES`` are cut into parts by hash, one tree per part and task, and parts meet in tasks of
their own, all rows of a block those outside its commonest component.
Only components are wanted, so a large group is not spelled out in pairs: first each member meets a leader of its
block, then the likeliest others, and in the end all pairs of different components are verified, which leaves out no link.

Shingles are 64-bit hashes of five words, sets compare by them; counts and links are exact up to hash collisions (a
pair of sets of 10,000 shingles has one with a chance of 10^-11). Null texts are empty and linked with nothing. Rows of
equal text, repeated rows too, are in one component. Other columns are ignored. One text is held by one task, with
about forty bytes of working memory per byte.
"""

from __future__ import annotations

import tempfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidetable.llm.components import components
from tidetable.llm.hashing import mixed, prefix_sums, stretch
from tidetable.llm.shared import SLOT_BITS, flagged, materialize, shuffle_partitions, ship, slices, text_of, without

WORDS = 5
RARITY_BITS = 20
RARITY_BLOCKS = 64
LEAF = 64
ROUNDS = (4, None)  # partners tried per row and round; the last round tries all
BYTES_AT_ONCE = 1_000_000
PART_BYTES = 1 << 25  # of a block's points, unpacked, in one part
ROW_BYTES = 1 << 12
PAIRS_AT_ONCE = 1 << 18
HEAD_ROUNDS = 2
SMALL = 8  # classes; blocks of no more are never cut
KNOWN_BITS = 16
SPOOLED = 1 << 23

_FACTORS = [np.uint64(mixed(np.array([k + 1], np.uint64))[0] | np.uint64(1)) for k in range(WORDS)]


def sets_of(texts: list[bytes]) -> list[np.ndarray]:
    """Per text its distinct shingle hashes, sorted; none without words, one for fewer words than a shingle has."""
    joined = np.frombuffer(b" ".join(texts).lower() + b" ", np.uint8)
    begins = np.cumsum([0, *[len(x) + 1 for x in texts]])
    space = (joined == 32) | ((joined >= 9) & (joined <= 13))
    edges = np.flatnonzero(np.diff(np.r_[True, space].view(np.int8)))
    first, last = edges[::2], edges[1::2]
    words = mixed(stretch(prefix_sums(joined), first, last) + (last - first).astype(np.uint64))
    cuts = np.searchsorted(first, begins)
    size = max(len(words) - WORDS + 1, 0)
    whole = np.zeros(size, np.uint64)
    for k, factor in enumerate(_FACTORS):
        whole += words[k : k + size] * factor
    whole = mixed(whole)
    found = []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if b - a >= WORDS:
            found.append(np.unique(whole[a : b - WORDS + 1]))
        elif b > a:
            short = (words[a:b] * np.array(_FACTORS[: b - a])).sum(keepdims=True)
            found.append(mixed(short, b - a))
        else:
            found.append(np.zeros(0, np.uint64))
    return found


def class_of(held: np.ndarray) -> int:
    """A name for a set: equal sets, equal names."""
    return int(mixed(mixed(held, 77).sum(keepdims=True), len(held)).view(np.int64)[0])


def point_of(held: np.ndarray) -> bytes:
    """Counts per group, packed; the number of groups is a power of two, so halves of a point add up to a coarser one."""
    groups = 1 << max(3, len(held).bit_length())
    counts = np.bincount((held & np.uint64(groups - 1)).astype(np.int64), minlength=groups)
    return zlib.compress(counts.astype(np.uint8 if counts.max() < 256 else np.uint16).tobytes(), 1)


def unpacked(point: bytes, n: int) -> np.ndarray:
    held = zlib.decompress(point)
    wide = len(held) > 1 << max(3, n.bit_length())
    return np.frombuffer(held, np.uint16 if wide else np.uint8).astype(np.uint16)


def posted(n: int) -> int:
    return n - (4 * n + 4) // 5 + 1


def _each_set(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[np.ndarray]]]:
    for batch in batches:
        texts = pc.cast(batch.column(1), pa.binary())
        for a, b in slices(pc.binary_length(texts).to_numpy(), BYTES_AT_ONCE):
            yield batch.column(0).slice(a, b - a).to_pylist(), sets_of(texts.slice(a, b - a).to_pylist())


_SEEN = pa.schema([
    ("doc_id", pa.int64()), ("n", pa.int64()), ("class", pa.int64()), ("point", pa.binary()),
    ("block", pa.int32()), ("slots", pa.binary()), ("counts", pa.binary()),
])


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document its set's size and class, with the point where the task meets a class first; shingle counts."""
    seen: set[int] = set()
    counts = np.zeros(1 << RARITY_BITS, np.uint32)
    for ids, sets in _each_set(batches):
        names, points = [], []
        for held in sets:
            name = class_of(held)
            new = name not in seen and len(held) > 0
            names.append(name)
            points.append(point_of(held) if new else None)
            if new:
                seen.add(name)
                np.add.at(counts, (held >> np.uint64(64 - RARITY_BITS)).astype(np.int64), 1)
        none = [None] * len(ids)
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, f.type) for v, f in zip([ids, [len(x) for x in sets], names, points, none, none, none], _SEEN)],
            schema=_SEEN,
        )
    rows = []
    for block, part in enumerate(np.split(counts, RARITY_BLOCKS)):
        slots = np.flatnonzero(part).astype(np.uint32)
        if len(slots):
            rows.append((None, None, None, None, block, slots.tobytes(), part[slots].tobytes()))
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows), _SEEN)], schema=_SEEN)


def _summed(table: pa.Table) -> pa.Table:
    total = np.zeros((1 << RARITY_BITS) // RARITY_BLOCKS, np.uint64)
    for slots, counts in zip(table.column("slots"), table.column("counts")):
        total[np.frombuffer(slots.as_py(), np.uint32)] += np.frombuffer(counts.as_py(), np.uint32)
    held = np.minimum(total, (1 << 32) - 1).astype(np.uint32).tobytes()
    return pa.table({"block": pa.array([table.column("block")[0].as_py()], pa.int32()), "total": pa.array([held], pa.binary())})


def _poster(rarity):
    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.frombuffer(rarity.value, np.uint32)
        seen: set[int] = set()
        for _, sets in _each_set(batches):
            tokens, names, sizes = [], [], []
            for held in sets:
                name = class_of(held)
                if len(held) and name not in seen:
                    seen.add(name)
                    rare = np.argsort(counts[(held >> np.uint64(64 - RARITY_BITS)).astype(np.int64)], kind="stable")
                    tokens.append(held[rare[: posted(len(held))]])
                    names.append(name)
                    sizes.append(len(tokens[-1]))
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.repeat(np.array(names, np.int64), sizes))],
                    names=["token", "class"],
                )

    return post


class _Met:
    """The classes of one token, in a file from ``SPOOLED`` bytes on, with what names their block."""

    def __init__(self, token: int):
        self.token, self.last, self.total, self.count = token, None, np.zeros(1, np.uint64), 0
        self.names = tempfile.SpooledTemporaryFile(SPOOLED)

    def add(self, names: np.ndarray) -> None:
        if len(names):
            self.total += mixed(names.view(np.uint64), 5).sum(dtype=np.uint64)
            self.count += len(names)
            self.last = names[-1]
            self.names.write(names.tobytes())

    def parts(self) -> Iterator[np.ndarray]:
        self.names.seek(0)
        while held := self.names.read(SPOOLED):
            yield np.frombuffer(held, np.int64)


def _named(totals: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return mixed(totals, 9) ^ mixed(sizes.astype(np.uint64), 3)


def _meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Classes that share a token, as blocks named by their members, from rows sorted by token and class.

    Most equal blocks of a task come once; ``large`` tells blocks of more than ``SMALL`` classes.
    """
    known = np.zeros(1 << KNOWN_BITS, np.uint64)

    def unknown(blocks: np.ndarray) -> np.ndarray:
        slots = (blocks >> np.uint64(64 - KNOWN_BITS)).astype(np.int64)
        new = known[slots] != blocks
        known[slots[new]] = blocks[new]
        return new

    def out(blocks: np.ndarray, names: np.ndarray, large: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(blocks.view(np.int64)), pa.array(names), pa.array(large)], names=["block", "class", "large"]
        )

    def closed(met: _Met) -> Iterator[pa.RecordBatch]:
        block = _named(met.total, np.array([met.count]))
        if met.count > 1 and unknown(block)[0]:
            for names in met.parts():
                yield out(np.repeat(block, len(names)), names, np.full(len(names), met.count > SMALL))
        met.names.close()

    met = None
    for batch in batches:
        if not batch.num_rows:
            continue
        tokens, names = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        new = np.r_[True, (tokens[1:] != tokens[:-1]) | (names[1:] != names[:-1])]
        new[0] = met is None or tokens[0] != met.token or names[0] != met.last
        tokens, names = tokens[new], names[new]
        if met is not None:
            here = int(np.searchsorted(tokens != met.token, True))
            met.add(names[:here])
            tokens, names = tokens[here:], names[here:]
        if not len(tokens):
            continue
        if met is not None:
            yield from closed(met)
        first = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]])
        met = _Met(tokens[-1])  # its rows may go on in the next batch
        met.add(names[first[-1] :])
        sizes, first = np.diff(first), first[:-1]
        several = sizes > 1
        first, sizes = first[several], sizes[several]
        if not len(first):
            continue
        sums = np.r_[np.uint64(0), np.cumsum(mixed(names.view(np.uint64), 5))]
        blocks, at = np.unique(_named(sums[first + sizes] - sums[first], sizes), return_index=True)
        fresh = unknown(blocks)
        blocks, first, sizes = blocks[fresh], first[at[fresh]], sizes[at[fresh]]
        rows = np.repeat(first - np.r_[0, np.cumsum(sizes)[:-1]][: len(first)], sizes) + np.arange(sizes.sum())
        yield out(np.repeat(blocks, sizes), names[rows], np.repeat(sizes > SMALL, sizes))
    if met is not None:
        yield from closed(met)


class RTree:
    """Points of one number of groups, packed into leaves along their widest coordinates; nodes hold upper corners."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.points, self.sizes = points, sizes
        self.leaves: list[np.ndarray] = []
        self.root = self._pack(np.arange(len(points)))

    def _pack(self, rows: np.ndarray):
        upper, least = self.points[rows].max(axis=0), int(self.sizes[rows].min())
        if len(rows) <= LEAF:
            return upper, least, rows, ()
        held = self.points[rows]
        axis = int(np.argmax(held.max(axis=0).astype(np.int64) - held.min(axis=0)))
        rows = rows[np.argsort(held[:, axis], kind="stable")]
        half = len(rows) // 2
        return upper, least, None, (self._pack(rows[:half]), self._pack(rows[half:]))

    def near(self, point: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose sets may share enough shingles with a set of this point and size, and bounds of how many."""
        found, bounds, open_nodes = [], [], [self.root]
        while open_nodes:
            upper, least, rows, parts = open_nodes.pop()
            if 9 * int(np.minimum(upper, point).sum(dtype=np.int64)) < 4 * (size + least):
                continue
            if rows is None:
                open_nodes += parts
                continue
            bound = np.minimum(self.points[rows], point).sum(axis=1, dtype=np.int64)
            enough = 9 * bound >= 4 * (size + self.sizes[rows])
            found.append(rows[enough])
            bounds.append(bound[enough])
        none = np.zeros(0, np.int64)
        return (np.concatenate(found), np.concatenate(bounds)) if found else (none, none)


class Block:
    """Classes that share a posted shingle, with one tree per number of groups."""

    def __init__(self, points: list[bytes], sizes: np.ndarray):
        self.points = [unpacked(x, n) for x, n in zip(points, sizes.tolist())]
        self.sizes = sizes
        self.widths = np.array([len(x) for x in self.points])
        self.trees = {}
        for width in np.unique(self.widths).tolist():
            rows = np.flatnonzero(self.widths == width)
            self.trees[width] = rows, RTree(np.stack([self.points[i] for i in rows]), sizes[rows])
        self.halved: dict[int, tuple[np.ndarray, RTree]] = {}  # by the halved number of groups, built when asked for

    def _finer(self, width: int) -> tuple[np.ndarray, RTree] | None:
        """The rows of twice ``width`` groups, and a tree of their points at ``width`` groups."""
        if width not in self.halved and 2 * width in self.trees:
            rows, tree = self.trees[2 * width]
            self.halved[width] = rows, RTree(tree.points[:, :width] + tree.points[:, width:], tree.sizes)
        return self.halved.get(width)

    def near(self, row: int, finer: bool = False) -> np.ndarray:
        """Other rows, of at most as many groups as this one has, or of more too, that may link with it; the likeliest first."""
        point, width, found, shares = self.points[row], int(self.widths[row]), [], []
        # sizes of linked sets differ by a quarter at most, numbers of groups by a factor of two
        half = point[: width // 2] + point[width // 2 :]
        held = [(self.trees.get(width), point), (self.trees.get(width // 2), half), (self._finer(width) if finer else None, point)]
        for rows_and_tree, at_width in held:
            if rows_and_tree is not None:
                rows, tree = rows_and_tree
                at, bounds = tree.near(at_width, int(self.sizes[row]))
                found.append(rows[at])
                shares.append(bounds / (self.sizes[rows[at]] + self.sizes[row]))
        rows = np.concatenate(found)[np.argsort(-np.concatenate(shares), kind="stable")]
        return rows[rows != row]


def leaders_of(block: Block) -> Iterator[tuple[int, int]]:
    """Rows that may link with any other, each with one leader among these; -1 for the leaders. Large rows lead.

    A row whose only partners are finer and follow others stays too, as a leader of none.
    """
    free = np.ones(len(block.sizes), bool)
    for row in np.lexsort((np.arange(len(free)), -block.sizes)).tolist():
        if free[row]:
            free[row] = False
            near = block.near(row, finer=True)
            if len(near):
                yield row, -1
            for other in near[free[near]].tolist():
                free[other] = False
                yield other, row


def crossing_pairs(block: Block, roots: np.ndarray, most: int | None) -> Iterator[tuple[int, int]]:
    """Rows that may link and are of different components: all, or the ``most`` likeliest of each row."""
    for row in range(len(roots)):
        near = block.near(row)
        near = near[roots[near] != roots[row]]
        if most is None:  # of two rows with as many groups both find the other, otherwise the finer one does
            near = near[(near < row) | (block.widths[near] < block.widths[row])]
        for other in near[:most].tolist():
            yield row, other


def _cells(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """The rows of equal keys, one table after the other; a task's rows come sorted by them."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        cuts = np.flatnonzero(np.r_[True, np.logical_or.reduce([c[1:] != c[:-1] for c in columns]), True])
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            key = [int(c[a]) for c in columns]
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def _block(table: pa.Table) -> Block:
    return Block(table.column("point").to_pylist(), table.column("n").to_numpy())


def _led(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows that may link with another one of their block, with their leaders; of blocks in parts all rows."""
    chosen, held = [], 0
    for table in _cells(batches, "block", "part"):
        names = table.column("class").to_numpy()
        found = dict(leaders_of(_block(table)))
        if table.column("parts")[0].as_py() > 1:
            found = dict.fromkeys(range(len(names)), -1) | found
        if found:
            leaders = pa.array([None if x < 0 else int(names[x]) for x in found.values()], pa.int64())
            chosen.append(table.take(pa.array(list(found))).append_column("leader", leaders))
            held += chosen[-1].nbytes
        if held > BYTES_AT_ONCE:
            yield from pa.concat_tables(chosen).combine_chunks().to_batches()
            chosen, held = [], 0
    if chosen:
        yield from pa.concat_tables(chosen).combine_chunks().to_batches()


def _paired(cells: Iterator[tuple[np.ndarray, Iterator[tuple[int, int]]]]) -> Iterator[pa.RecordBatch]:
    """Pairs of names from pairs of rows, ``PAIRS_AT_ONCE`` at a time."""
    found: set[tuple[int, int]] = set()

    def batch() -> pa.RecordBatch:
        a, b = zip(*sorted(found)) if found else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    for names, pairs in cells:
        for x, y in pairs:
            found.add((int(min(names[x], names[y])), int(max(names[x], names[y]))))
            if len(found) >= PAIRS_AT_ONCE:
                yield batch()
                found.clear()
    yield batch()


def _crossing(most: int | None):
    """Pairs inside the parts of blocks."""

    def cells(batches):
        for table in _cells(batches, "block", "part"):
            roots = table.column("root").to_numpy()
            if (roots != roots[0]).any():
                yield table.column("class").to_numpy(), crossing_pairs(_block(table), roots, most)

    return lambda batches: _paired(cells(batches))


def _meeting_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All pairs of a part of a block's strays (``asks``) and a part of all its rows."""

    def pairs(table: pa.Table, names: np.ndarray) -> Iterator[tuple[int, int]]:
        block = _block(table)
        roots, asks, stray = (table.column(c).to_numpy() for c in ("root", "asks", "stray"))
        for row in np.flatnonzero(asks).tolist():
            near = block.near(row, finer=True)
            # two strays find each other twice
            for other in near[~asks[near] & (roots[near] != roots[row]) & (~stray[near] | (names[near] > names[row]))].tolist():
                yield row, other

    def cells():
        for table in _cells(batches, "block", "part", "other"):
            names = table.column("class").to_numpy()
            yield names, pairs(table, names)

    return _paired(cells())


def _dealt(rows: DataFrame, weights: DataFrame, salt: int) -> DataFrame:
    """``rows`` with the number of ``parts`` of their block by the summed weight of ``weights``, and a ``part``."""
    parts = weights.groupBy("block").agg(F.ceil(F.sum(_weight()) / PART_BYTES).cast("long").alias("parts"))
    return rows.join(parts, "block").withColumn("part", F.pmod(F.xxhash64("class", F.lit(salt)), F.col("parts")))


def _weight():
    """Bytes of a row's point as unpacked, with something for the row itself."""
    return F.pow(F.lit(2.0), F.greatest(F.lit(3), F.length(F.bin("n"))) + 1) + ROW_BYTES


def _parts_that_meet(rooted: DataFrame) -> DataFrame:
    """Of blocks in parts with several roots: every part of rows next to every part of strays.

    Strays are the rows without the commonest root of their block; rows with it are of one component already.
    """
    counts = rooted.groupBy("block", "root").agg(F.count("*").alias("rows"))
    common = counts.groupBy("block").agg(F.max_by("root", F.struct("rows", "root")).alias("common"), F.count("*").alias("roots"))
    held = rooted.join(common.where("roots > 1"), "block").withColumn("stray", F.col("root") != F.col("common"))
    strays = held.where("stray").select("block", "class", "n")
    held = held.drop("part", "parts").join(
        rooted.groupBy("block").agg(F.first("parts").alias("parts")), "block"
    ).join(strays.groupBy("block").agg(F.ceil(F.sum(_weight()) / PART_BYTES).cast("long").alias("others")), "block")
    part = F.pmod(F.xxhash64("class", F.lit(1)), F.col("parts"))
    other = F.pmod(F.xxhash64("class", F.lit(2)), F.col("others"))
    columns = ["block", "class", "n", "point", "root", "stray"]
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    told = held.select(*columns, F.lit(False).alias("asks"), part.alias("part"), every("others").alias("other"))
    asking = held.where("stray").select(*columns, F.lit(True).alias("asks"), every("parts").alias("part"), other.alias("other"))
    return told.unionByName(asking)


def _wanted_sets(words):
    """Sets of the classes whose bit is set, once per task."""

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(words.value, np.uint8)
        seen: set[int] = set()
        for _, sets in _each_set(batches):
            names, held = [], []
            for one in sets:
                name = class_of(one)
                slot = name >> (64 - SLOT_BITS) & ((1 << SLOT_BITS) - 1)
                if len(one) and bits[slot >> 3] >> (slot & 7) & 1 and name not in seen:
                    seen.add(name)
                    names.append(name)
                    held.append(one.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(held, pa.binary())], names=["class", "held"])

    return wanted


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2), batch.column(3)):
            a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            shared = len(a) + len(b) - len(np.union1d(a, b))
            keep.append(9 * shared >= 4 * (len(a) + len(b)))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _bits(names: DataFrame) -> bytes:
    """A bitmap of ``2 ** SLOT_BITS`` bits, 2 MB whatever the number of classes."""
    slot = F.shiftrightunsigned("class", 64 - SLOT_BITS)
    bit = F.call_function("shiftleft", F.lit(1), slot.bitwiseAND(F.lit(7)).cast("int"))
    rows = names.groupBy(F.shiftright(slot, 3).cast("int").alias("at")).agg(F.bit_or(bit).cast("int").alias("bits")).toPandas()
    held = np.zeros(1 << (SLOT_BITS - 3), np.uint8)
    held[rows["at"].to_numpy()] = rows["bits"].to_numpy()
    return held.tobytes()


def _least_neighbours(links: DataFrame) -> DataFrame:
    """``node, root`` of linked nodes: the least of a node and its neighbours. Equal roots are connected."""
    ends = F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))
    both = links.select(F.inline(ends))
    return both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.min("u")).alias("root"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id``."""
    spark = docs.sparkSession
    ship(spark)
    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    surveyed = materialize(given.mapInArrow(_survey, "doc_id long, n long, class long, point binary, block int, slots binary, counts binary"))
    members = surveyed.where("block IS NULL").select("doc_id", "n", "class")
    full = members.where("n > 0")

    # 2^20 counts of four bytes
    totals = surveyed.where("block IS NOT NULL").groupBy("block").applyInArrow(_summed, "block int, total binary").collect()
    rarity = np.zeros((RARITY_BLOCKS, (1 << RARITY_BITS) // RARITY_BLOCKS), np.uint32)
    for row in totals:
        rarity[row["block"]] = np.frombuffer(row["total"], np.uint32)
    posts = given.mapInArrow(_poster(spark.sparkContext.broadcast(rarity.tobytes())), "token long, class long")
    partitions = shuffle_partitions(spark)
    spread = posts.repartition(partitions, "token").sortWithinPartitions("token", "class")
    blocks = materialize(spread.mapInArrow(_meeting, "block long, class long, large boolean").distinct())

    points = surveyed.where("point IS NOT NULL").groupBy("class").agg(F.first("point").alias("point"), F.first("n").alias("n"))
    weighed = blocks.where("large").join(points.select("class", "n"), "class").groupBy("block").agg(F.sum(_weight()).alias("weight"))
    heavy = materialize(weighed.where(F.col("weight") > PART_BYTES).select("block", F.ceil(F.col("weight") / PART_BYTES).cast("long").alias("parts")))
    in_parts = not heavy.isEmpty()

    def by_cells(rows: DataFrame, *keys: str) -> DataFrame:
        return rows.repartition(partitions, *keys).sortWithinPartitions(*keys)

    placed = blocks.join(points, "class").join(heavy, "block", "left").withColumn("parts", F.coalesce("parts", F.lit(1)).cast("long"))
    placed = placed.select("block", F.pmod(F.xxhash64("class", F.lit(0)), F.col("parts")).alias("part"), "parts", "class", "n", "point")
    columns = "block long, part long, parts long, class long, n long, point binary, leader long"
    led = materialize(by_cells(placed, "block", "part").mapInArrow(_led, columns))
    wanted = spark.sparkContext.broadcast(_bits(led.select("class")))
    held = materialize(given.mapInArrow(_wanted_sets(wanted), "class long, held binary").dropDuplicates(["class"]))

    def verified(pairs: DataFrame) -> DataFrame:
        ends = pairs.select("a").unionByName(pairs.select(F.col("b").alias("a")))
        needed = flagged(held, F.col("class"), ends).where("__flag")
        with_b = pairs.join(needed.select(F.col("class").alias("b"), F.col("held").alias("of_b")), "b")
        both = with_b.join(needed.select(F.col("class").alias("a"), F.col("held").alias("of_a")), "a")
        return materialize(both.select("a", "b", "of_a", "of_b").mapInArrow(_verified, "a long, b long"))

    led_pairs = led.where("leader IS NOT NULL").select(F.least("class", "leader").alias("a"), F.greatest("class", "leader").alias("b"))
    tried = materialize(led_pairs.distinct())
    links = verified(tried)
    def rooted_by(roots: DataFrame) -> DataFrame:
        named = roots.withColumnRenamed("node", "class")
        return led.drop("leader").join(named, "class", "left").withColumn("root", F.coalesce("root", "class"))

    def tried_too(crossing: DataFrame) -> None:
        nonlocal tried, links
        new = materialize(crossing.distinct().join(tried, ["a", "b"], "left_anti"))
        tried, links = tried.unionByName(new), links.unionByName(verified(new))

    # first the likeliest partners of each row, so that large groups grow together before the rest is spelled out
    for most in ROUNDS:
        # a cheap start: classes with one least neighbour are connected; before the last round the real components
        rooted = rooted_by(components(links) if most is None else _least_neighbours(links))
        crossing = by_cells(rooted if most else rooted.where("parts = 1"), "block", "part").mapInArrow(_crossing(most), "a long, b long")
        if most is None and in_parts:
            # one row of each component in a block in parts, dealt anew: parts of one group grow together
            for salt in range(HEAD_ROUNDS):
                heads = materialize(rooted.where("parts > 1").groupBy("block", "root").agg(F.min(F.struct("class", "n", "point")).alias("head")))
                heads = heads.select("block", "root", "head.*")
                dealt = by_cells(_dealt(heads, heads, 10 + salt), "block", "part")
                tried_too(dealt.mapInArrow(_crossing(ROUNDS[0]), "a long, b long"))
                rooted = rooted_by(components(links))
            crossing = by_cells(rooted.where("parts = 1"), "block", "part").mapInArrow(_crossing(None), "a long, b long")
            apart = _parts_that_meet(materialize(rooted.where("parts > 1")))
            crossing = crossing.unionByName(by_cells(apart, "block", "part", "other").mapInArrow(_meeting_parts, "a long, b long"))
        tried_too(crossing)
    roots = components(links)

    classes = full.groupBy("class").agg(F.min("doc_id").alias("least"), F.count("*").alias("size"))
    rooted = classes.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    rooted = materialize(rooted)
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("size").alias("docs"))
    several = rooted.join(ids.where("docs > 1"), "root").select("class", "component_id")
    joined = members.join(several.withColumn("n_class", F.lit(True)), "class", "left")
    linked = (F.col("n") > 0) & F.col("n_class").isNotNull()
    return joined.select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(linked, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )


def one_of_each_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns: those with the smallest id of their component, and all without id."""
    others = near_duplicates(docs, doc_id, text).where("doc_id <> component_id").select("doc_id").distinct()
    return without(docs, doc_id, materialize(others))
