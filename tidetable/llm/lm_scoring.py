"""Log-probabilities of documents under a bigram model whose counts lie in a log-frequency Bloom filter.

Words and pairs of neighbouring words are counted exactly over all training texts. A count is quantised to a level of the
steps in `LEVELS` (each about a fifth above the one before), and an n-gram of level q is put into the filter q times,
together with 1, 2, ... q. A worker asks for level after level until one is missing: the filter never loses a level, and
rarely adds one. Levels are read as lower bounds in numerators and as upper bounds in denominators, so the smoothed
probabilities of all continuations sum to one at most:

    p(w | h) = (low(h w) + PRIOR * p(w)) / (high(h) + PRIOR),   p(w) = (c(w) + 0.1) / (N + 0.1 * (V + 1))

The filter has ``FILTER_BITS`` bits whatever the input, and is broadcast with the exact counts of the ``FREQUENT`` commonest
words at most; other words' counts come from the filter too. Where the levels of all n-grams don't fit at ``BITS_PER_LEVEL``,
the least count that goes in rises until they do, chosen from the counts of all n-grams; it stays 1 as long as it can.
An n-gram of a training text that is left out where only counts of 1 are has that count. Other tokens that meet an n-gram
left out are scored apart: their left-out n-grams are joined with their exact counts, which give the levels that the filter
would have held. Pairs are looked up in ``ROUNDS`` shares of their hashes, one after the other, and shuffled files go as soon
as a step is written, so that they don't lie on disk together.

The unigram base score is exact for every word: words outside the broadcast table are joined with their counts, where none
is commoner than a 2^18th of all tokens. Words are told apart by 64-bit hashes of their bytes.

Null texts are empty and have the end as their one token. A null id counts as the empty text, whose checksum holds it out. Repeated
rows count and are scored each. Without training rows every score is 0. An empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidetable.llm.hashing import mixed, prefix_sums, stretch
from tidetable.llm.shared import bytes_of, materialize, ship, shuffles_removed, slices, text_of
from tidetable.session import shared_folder

FILTER_BITS = 1 << 28
BLOCK_BITS = 1 << 19  # all levels of an n-gram lie in one block
PROBES = 5
BITS_PER_LEVEL = 8
FREQUENT = 1 << 18
PRIOR = 20.0
FLOOR = 0.1
FOLDS = 10
SLICE_BYTES = 2 << 20
HASHED_BYTES = 1 << 20  # words are hashed in stretches of about so many bytes
HELD_GRAMS = 1 << 20
ROUNDS = 8  # a power of two
FINE_COUNTS = 4096  # counts above fall into classes of powers of two when they are tallied

START, END = np.uint64(0x5354415254), np.uint64(0x454E44)


def _levels() -> np.ndarray:
    steps = [1]
    while steps[-1] < 1 << 62:
        steps.append(max(steps[-1] + 1, steps[-1] * 6 // 5))
    return np.array(steps, np.int64)


LEVELS = _levels()


def level_of(counts: np.ndarray) -> np.ndarray:
    """The number of steps that a count reaches."""
    return np.searchsorted(LEVELS, counts, side="right")


# --- tokens


def word_keys(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, A-Z in lower case, and how many each text has."""
    data, begins = bytes_of(texts)
    low = data + (np.uint8(32) * ((data - np.uint8(65)) < 26).astype(np.uint8))
    white = (low == 32) | ((low - np.uint8(9)) < 5)
    before, behind = np.ones(len(low), bool), np.ones(len(low), bool)
    before[1:], behind[:-1] = white[:-1], white[1:]
    before[begins[:-1][begins[:-1] < len(low)]] = True
    behind[begins[1:][begins[1:] > 0] - 1] = True
    first, end = np.flatnonzero(~white & before), np.flatnonzero(~white & behind) + 1
    keys, at = np.zeros(len(first), np.uint64), 0
    while at < len(first):
        to = max(at + 1, int(np.searchsorted(end, first[at] + HASHED_BYTES, side="right")))
        sums = prefix_sums(low[first[at] : end[to - 1]])
        keys[at:to] = stretch(sums, first[at:to] - first[at], end[at:to] - first[at])
        at = to
    return mixed(keys + (end - first).astype(np.uint64)), np.diff(np.searchsorted(first, begins))


def token_keys(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens (an end behind the words of each text), the token before each, and the tokens per text."""
    words, counts = word_keys(texts)
    tokens = np.insert(words, np.cumsum(counts), END)
    previous = np.empty_like(tokens)
    previous[1:] = tokens[:-1]
    ends = np.cumsum(counts + 1)
    previous[np.r_[0, ends[:-1]]] = START
    return tokens, previous, counts + 1


def pair_keys(previous: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    return mixed(previous * np.uint64(0x9E3779B97F4A7C15) + tokens, 2)


# --- counts


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts[order], first) if len(first) else np.zeros(0, np.int64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-grams of a task's texts with partial counts; a task holds a bounded number of them."""
    held: dict[int, list] = {1: [], 2: []}

    def given(size: int) -> Iterator[pa.RecordBatch]:
        keys, counts = _summed(held[size])
        held[size] = []
        columns = [pa.array(np.full(len(keys), size, np.int8)), pa.array(keys.view(np.int64)), pa.array(counts)]
        yield pa.RecordBatch.from_arrays(columns, names=["size", "key", "n"])

    for batch in batches:
        texts = batch.column(0)
        for first, end in slices(np.diff(bytes_of(texts)[1]), SLICE_BYTES):
            tokens, previous, _ = token_keys(texts.slice(first, end - first))
            for size, keys in ((1, tokens), (2, pair_keys(previous, tokens))):
                held[size].append(np.unique(keys, return_counts=True))
                if sum(len(p[0]) for p in held[size]) > HELD_GRAMS:
                    held[size] = [_summed(held[size])]
                    if len(held[size][0][0]) > HELD_GRAMS // 2:
                        yield from given(size)
    for size in held:
        if held[size]:
            yield from given(size)


def counted_grams(texts: DataFrame) -> DataFrame:
    """``size, key, n``: all words (size 1) and pairs (size 2) of one text column, without nulls, with their counts."""
    ship(texts.sparkSession)
    partial = texts.mapInArrow(_counted, "size tinyint, key long, n long")
    return partial.groupBy("size", "key").agg(F.sum("n").alias("n"))


def by_size(grams: DataFrame) -> DataFrame:
    """Counts written into the shared folder, words and pairs and the ``ROUNDS`` shares of their keys apart, to be read alone."""
    path = shared_folder(grams.sparkSession)
    with shuffles_removed(grams.sparkSession):
        grams = grams.withColumn("share", F.pmod("key", F.lit(ROUNDS)).cast("int"))
        grams.write.partitionBy("size", "share").parquet(path)
    return grams.sparkSession.read.schema(grams.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """Whether the checksum of the id as text is divisible by ``FOLDS``."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.pmod(F.crc32(F.encode(text, "UTF-8")), F.lit(FOLDS)) == 0


# --- filter


def _places(keys: np.ndarray, level: int) -> Iterator[np.ndarray]:
    """Bits of a block, one array per probe."""
    spread = mixed(keys + np.uint64(level * 0xD1342543DE82EF95 & 0xFFFFFFFFFFFFFFFF))
    at, step = spread & np.uint64(BLOCK_BITS - 1), (spread >> np.uint64(32)) | np.uint64(1)
    for _ in range(PROBES):
        yield at
        at = (at + step) & np.uint64(BLOCK_BITS - 1)


def _block_of(keys: np.ndarray, blocks: int) -> np.ndarray:
    return (keys >> np.uint64(64 - (blocks - 1).bit_length())).astype(np.int64) if blocks > 1 else np.zeros(len(keys), np.int64)


def _filter_block(table: pa.Table) -> pa.Table:
    """The bits of one block: every n-gram once per level that its count reaches."""
    keys = table.column("key").to_numpy().astype(np.int64).view(np.uint64)
    reached = level_of(table.column("n").to_numpy())
    bits = np.zeros(BLOCK_BITS, bool)
    for level in range(1, int(reached.max(initial=0)) + 1):
        keys, reached = keys[reached >= level], reached[reached >= level]
        for place in _places(keys, level):
            bits[place.astype(np.int64)] = True
    block = table.column("block")[0].as_py()
    packed = np.packbits(bits, bitorder="little").tobytes()
    return pa.table({"block": pa.array([block], pa.int32()), "bits": pa.array([packed], pa.binary())})


@dataclass
class Model:
    """What a worker needs to score: broadcast as a whole, of bounded size."""

    bits: np.ndarray  # one row of bytes per block
    words: np.ndarray  # hashes of the commonest words, sorted
    counts: np.ndarray  # and their exact counts
    texts: int  # training texts, the count of ends and starts
    tokens: int
    distinct: int
    least: int  # n-grams rarer than this are not in the filter

    @property
    def mass(self) -> float:
        """The denominator of a word's probability."""
        return self.tokens + FLOOR * (self.distinct + 1)

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """The level of each n-gram in the filter, 0 if absent: probes go on until one misses."""
        found = np.zeros(len(keys), np.int64)
        at, level, flat = np.arange(len(keys)), 1, self.bits.reshape(-1)
        base = _block_of(keys, len(self.bits)) * (BLOCK_BITS // 8)
        while len(at):
            asked, start, present = keys[at], base[at], np.ones(len(at), bool)
            for place in _places(asked, level):
                byte = flat[start + (place >> np.uint64(3)).astype(np.int64)]
                present &= (byte >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
            at = at[present]
            found[at] = level
            level += 1
        return found

    def known(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact counts of those of the words that the table holds, and which these are."""
        counts, hit, ends = np.zeros(len(keys), np.int64), np.zeros(len(keys), bool), keys == END
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, keys), len(self.words) - 1)
            hit = self.words[at] == keys
            counts = np.where(hit, self.counts[at], 0)
        counts[ends] = self.texts
        return counts, hit | ends

    def low(self, levels: np.ndarray) -> np.ndarray:
        """The least count of a level."""
        return np.where(levels > 0, LEVELS[np.maximum(levels, 1) - 1], 0)

    def high(self, levels: np.ndarray) -> np.ndarray:
        """The largest count of a level; of an absent n-gram the largest that is left out."""
        return np.where(levels > 0, LEVELS[levels] - 1, self.least - 1)


def _tally(grams: DataFrame) -> list[tuple[int, int, int]]:
    """``size, count, n-grams with it``: exact counts up to ``FINE_COUNTS``, classes above, so a bounded number of rows."""
    coarse = F.floor(F.pow(F.lit(2.0), F.floor(F.log2("n")))).cast("long")
    n = F.when(F.col("n") <= FINE_COUNTS, F.col("n")).otherwise(coarse)
    rows = grams.groupBy("size", n.alias("n")).agg(F.count("*").alias("grams")).collect()
    return [(r["size"], r["n"], r["grams"]) for r in rows]


def _least_that_fits(tally: list[tuple[int, int]], room: int) -> int:
    """The least count so that all entries (count, weight) from it on fit into ``room``."""
    total, least = 0, None
    for n, weight in sorted(tally, reverse=True):
        total += weight
        if total > room:
            break
        least = n
    return least if least is not None else max((n for n, _ in tally), default=0) * 2 + 1


def _merged(pairs) -> list[tuple[int, int]]:
    out: dict[int, int] = {}
    for n, weight in pairs:
        out[n] = out.get(n, 0) + weight
    return list(out.items())


def fitted(grams: DataFrame, filter_bits: int = FILTER_BITS, frequent: int = FREQUENT) -> Model:
    """The model of the counts ``size, key, n`` (a written table)."""
    ship(grams.sparkSession)
    tally = _tally(grams)
    # a class of counts is weighed by the level of its upper end
    weights = _merged((n, g * int(level_of(np.array([n if n < FINE_COUNTS else 2 * n]))[0])) for _, n, g in tally)
    least = _least_that_fits(weights, filter_bits // BITS_PER_LEVEL)
    blocks = max(1, filter_bits // BLOCK_BITS)
    block = F.shiftrightunsigned("key", 64 - (blocks - 1).bit_length()).cast("int") if blocks > 1 else F.lit(0)
    kept = grams.where(F.col("n") >= least).select(block.alias("block"), "key", "n")
    bits = np.zeros((blocks, BLOCK_BITS // 8), np.uint8)
    with shuffles_removed(grams.sparkSession):
        made = kept.groupBy("block").applyInArrow(_filter_block, "block int, bits binary").toArrow()
    for number, held in zip(made.column("block").to_pylist(), made.column("bits")):
        bits[number] = np.frombuffer(held.as_buffer(), np.uint8)

    words = grams.where("size = 1")
    common = _least_that_fits(_merged((n, g) for size, n, g in tally if size == 1), frequent)
    table = words.where(F.col("n") >= common).select("key", "n").toArrow()
    keys = table.column("key").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(keys)
    counts = table.column("n").to_numpy()
    end = int(END.astype(np.int64))
    total = words.agg(F.sum("n"), F.count("*"), F.sum(F.when(F.col("key") == end, F.col("n")))).first()
    return Model(bits, keys[order], counts[order], int(total[2] or 0), int(total[0] or 0), int(total[1] or 0), max(least, 1))


# --- scores

_SCORED = (
    "doc_id long, held_out boolean, n_tokens long, n_common long, base_common double, score double, "
    "rare_keys array<long>, rare_counts array<long>"
) + "".join(
    f", words_{share} array<struct<word:long, before:long, pair:long, low:long, top:long, high:long>>, pairs_{share} array<struct<pair:long, low:long, top:long, high:long>>"
    for share in range(ROUNDS)
)


def _scored(held, learned: bool):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = held.value
        for batch in batches:
            for first, end in slices(np.diff(bytes_of(batch.column(2))[1]), SLICE_BYTES):
                yield _scored_slice(model, batch.slice(first, end - first), learned)

    return score


def _scored_slice(model: Model, batch: pa.RecordBatch, learned: bool = False) -> pa.RecordBatch:
    tokens, previous, sizes = token_keys(batch.column(2))
    text = np.repeat(np.arange(len(sizes)), sizes)
    summed = lambda values: np.bincount(text, values, len(sizes))

    words, of = np.unique(tokens, return_inverse=True)
    counts, common = model.known(words)
    levels = np.zeros(len(words), np.int64)
    levels[~common] = model.levels(words[~common])
    low = np.where(common, counts, model.low(levels))
    high = np.where(common, counts, model.high(levels))

    pairs, pair_of = np.unique(pair_keys(previous, tokens), return_inverse=True)
    # the word before, as a place among the words of the slice; a start stands in for the end, as there are as many
    start = previous == START
    before = np.r_[0, of[:-1]]
    before[start] = np.searchsorted(words, END)
    met = low[of] > 0  # pairs with an unknown word cannot have been seen
    asked = np.zeros(len(pairs), bool)
    asked[pair_of[met & (low[before] > 0)]] = True
    pair_levels = np.zeros(len(pairs), np.int64)
    pair_levels[asked] = model.levels(pairs[asked])
    seen = np.where(asked, model.low(pair_levels), 0)[pair_of]
    # n-grams rarer than the least count that went in are absent but may have been seen
    out = np.zeros(len(words), bool) if model.least <= 1 else ~common & (levels == 0)
    pair_out = np.zeros(len(tokens), bool) if model.least <= 1 else pair_levels[pair_of] == 0
    word_out, before_out = out[of], out[before]
    # where that can only be once, a text that was learned from holds it that once; other such tokens are scored apart
    once = np.zeros(len(tokens), bool)
    if learned and model.least == 2:
        once = ~batch.column(1).to_numpy(zero_copy_only=False).astype(bool)[text]
    doubt = (word_out | before_out | pair_out) & ~once
    low, top = np.where(word_out & once, 1, low[of]), np.where(word_out & once, 1, high[of])
    high = np.where(before_out & once, 1, high[before])
    seen = np.where(pair_out & once, 1, seen)
    # no more pairs can have been seen than there are of either word
    chance = (np.minimum(seen, np.minimum(top, high)) + PRIOR * ((low + FLOOR) / model.mass)) / (high + PRIOR)
    chance = np.where(doubt, 1.0, chance)
    columns = {
        "word": (tokens.view(np.int64), ~word_out), "before": (words[before].view(np.int64), ~before_out), "pair": (pairs[pair_of].view(np.int64), None),
        "low": (low, word_out), "top": (top, word_out), "high": (high, before_out),
    }

    def chosen(flag: np.ndarray, names: list[str]) -> pa.ListArray:
        at = np.flatnonzero(flag)
        begins = np.searchsorted(text[at], np.arange(len(sizes) + 1))
        arrays = [pa.array(columns[name][0][at], pa.int64(), mask=None if columns[name][1] is None else columns[name][1][at]) for name in names]
        return pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.StructArray.from_arrays(arrays, names))

    # a pair with a word that is left out is left out too; most tokens ask for their pair alone. Each is in the share of its pair
    word_asked = word_out | before_out
    share = (pairs & np.uint64(ROUNDS - 1)).astype(np.int8)[pair_of]
    asked_for = {}
    for turn in range(ROUNDS):
        mine = doubt & (share == turn)
        asked_for[f"words_{turn}"] = chosen(mine & word_asked, list(columns))
        asked_for[f"pairs_{turn}"] = chosen(mine & ~word_asked, ["pair", "low", "top", "high"])

    is_common = common[of]
    base = np.where(is_common, np.log10(counts[of] + FLOOR), 0.0)
    rare = np.flatnonzero(~is_common)
    order = rare[np.lexsort((tokens[rare], text[rare]))]
    new = np.ones(len(order), bool)
    new[1:] = (text[order][1:] != text[order][:-1]) | (tokens[order][1:] != tokens[order][:-1])
    firsts = np.flatnonzero(new)
    times = np.diff(np.r_[firsts, len(order)])
    begins = np.searchsorted(text[order][firsts], np.arange(len(sizes) + 1))
    lists = lambda values: pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(values, pa.int64()))
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0),
            batch.column(1),
            pa.array(sizes, pa.int64()),
            pa.array(summed(is_common & (counts[of] > 0)).astype(np.int64)),
            pa.array(summed(base)),
            pa.array(summed(np.log10(chance))),
            lists(tokens[order][firsts].view(np.int64)),
            lists(times),
            *asked_for.values(),
        ],
        names=["doc_id", "held_out", "n_tokens", "n_common", "base_common", "score", "rare_keys", "rare_counts", *asked_for],
    )


def scored(docs: DataFrame, model: Model, grams: DataFrame, doc_id: str = "doc_id", text: str = "text", learned: bool = False) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row of ``docs``.

    ``learned`` says that the counts hold all rows of ``docs`` that are not held out.
    """
    spark = docs.sparkSession
    ship(spark)
    held = spark.sparkContext.broadcast(model)
    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"), text_of(text).alias("text"))
    rows = materialize(given.mapInArrow(_scored(held, learned), _SCORED).withColumn("mark", F.monotonically_increasing_id()))
    rare = rows.select("mark", F.explode(F.arrays_zip("rare_keys", "rare_counts")).alias("r"))
    rare = rare.select("mark", F.col("r.rare_keys").alias("key"), F.col("r.rare_counts").alias("times"))
    counts = grams.where("size = 1").select(F.col("key").alias("__key"), "n")
    joined = rare.join(counts, F.col("key") == F.col("__key"), "left")
    log = F.log10(F.coalesce("n", F.lit(0)).cast("double") + F.lit(FLOOR))
    known = F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)
    sums = joined.groupBy(F.col("mark").alias("__mark")).agg(F.sum(known).alias("n_rare"), F.sum(F.col("times") * log).alias("base_rare"))
    whole = rows.select("doc_id", "held_out", "n_tokens", "n_common", "base_common", "score", "mark").join(sums, F.col("mark") == F.col("__mark"), "left")
    if model.least > 1:
        whole = whole.join(_scored_apart(rows, grams, model.mass), F.col("mark") == F.col("__apart"), "left")
        whole = whole.withColumn("score", F.col("score") + F.coalesce("apart", F.lit(0.0)))
    base = F.col("base_common") + F.coalesce("base_rare", F.lit(0.0)) - F.col("n_tokens") * F.lit(math.log10(model.mass))
    return whole.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_common") + F.coalesce("n_rare", F.lit(0).cast("long"))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        "score",
    )


def _low(counts: np.ndarray) -> np.ndarray:
    levels = level_of(counts)
    return np.where(levels > 0, LEVELS[np.maximum(levels, 1) - 1], 0)


def _high(counts: np.ndarray) -> np.ndarray:
    levels = level_of(counts)
    return np.where(levels > 0, LEVELS[levels] - 1, 0)


def _apart(mass: float):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, top, high, n = (batch.column(name).to_numpy() for name in ("low", "top", "high", "n"))
            seen = np.minimum(_low(n), np.minimum(top, high))
            chance = (seen + PRIOR * (low + FLOOR) / mass) / (high + PRIOR)
            yield pa.RecordBatch.from_arrays([batch.column("mark"), pa.array(np.log10(chance))], names=["mark", "part"])

    return score


def _with_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        given = {name: batch.column(name).to_numpy() for name in ("low", "top", "high", "n_word", "n_before")}
        # -1 stands for a word whose count was left out
        low = np.where(given["low"] < 0, _low(given["n_word"]), given["low"])
        top = np.where(given["top"] < 0, _high(given["n_word"]), given["top"])
        high = np.where(given["high"] < 0, _high(given["n_before"]), given["high"])
        columns = [batch.column("mark"), batch.column("pair"), pa.array(low), pa.array(top), pa.array(high)]
        yield pa.RecordBatch.from_arrays(columns, names=["mark", "pair", "low", "top", "high"])


_ASKED = "mark long, pair long, low long, top long, high long"


def _scored_apart(rows: DataFrame, grams: DataFrame, mass: float) -> DataFrame:
    """``__apart, apart``: per row the log-probability of its tokens that meet n-grams left out of the filter."""
    parts = []
    with shuffles_removed(rows.sparkSession):
        for turn in range(ROUNDS):
            asked = rows.select("mark", F.explode(f"pairs_{turn}").alias("d")).select("mark", "d.*")
            asked = asked.unionByName(_words_looked_up(rows, f"words_{turn}", grams))
            counts = grams.where((F.col("size") == 2) & (F.col("share") == turn)).select("key", "n")
            exact = asked.join(counts, F.col("pair") == F.col("key"), "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
            scores = exact.select("mark", "low", "top", "high", "n").mapInArrow(_apart(mass), "mark long, part double")
            parts.append(materialize(scores.groupBy("mark").agg(F.sum("part").alias("part"))))
    whole = parts[0]
    for more in parts[1:]:
        whole = whole.unionByName(more)
    return whole.groupBy(F.col("mark").alias("__apart")).agg(F.sum("part").alias("apart"))


def _words_looked_up(rows: DataFrame, column: str, grams: DataFrame) -> DataFrame:
    """``mark, pair, low, top, high`` of the tokens whose word, or the one before, was left out, by the words' exact counts."""
    tokens = rows.select("mark", F.posexplode(column).alias("at", "d")).select("mark", "at", "d.*")
    carried = ["pair", "low", "top", "high"]
    asked = [
        tokens.where(F.col(what).isNotNull()).select("mark", "at", *carried, F.lit(what).alias("what"), F.col(what).alias("asked"))
        for what in ("word", "before")
    ]
    # a token's own values travel with each of its left-out words, so no join back to the tokens is needed
    counts = grams.where("size = 1").select("key", "n")
    found = asked[0].unionByName(asked[1]).join(counts, F.col("asked") == F.col("key"), "left").groupBy("mark", "at").agg(
        *(F.coalesce(F.first(c), F.lit(-1).cast("long")).alias(c) for c in carried),
        *(F.coalesce(F.max(F.when(F.col("what") == what, F.col("n"))), F.lit(0).cast("long")).alias(f"n_{what}") for what in ("word", "before")),
    )
    return found.mapInArrow(_with_words, _ASKED)


def lm_scores(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", filter_bits: int = FILTER_BITS, frequent: int = FREQUENT
) -> DataFrame:
    """Scores of all rows under the model of the rows that are not held out."""
    training = docs.where(~held_out(F.col(doc_id))).select(text_of(text).alias("text"))
    grams = by_size(counted_grams(training))
    return scored(docs, fitted(grams, filter_bits, frequent), grams, doc_id, text, learned=True)
