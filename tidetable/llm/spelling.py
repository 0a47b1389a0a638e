"""Spelling variants of words: exact PartEnum signatures of letter multisets, joined by equality and verified.

A word's letters are a multiset, taken as a binary vector with one dimension per letter and occurrence. One inserted or
deleted letter changes one dimension, a replaced one two, so words that differ by one letter lie within a Hamming distance of two.
Dimensions are dealt to ``PARTS`` parts; vectors within that distance agree on all but two parts, so every choice of ``PARTS - 2`` parts gives
one signature (its number and what the vector holds there), and near words share at least one. Words meet by an
equi-join on signatures. A pair is verified at the first signature that it shares only, by its edit distance in code points.

Signatures that more than ``CROWD`` words share (words of the same few letters) are made finer, without losing a pair: words that
differ by one letter also share their first or their second half, so the halves join the key; keys that are still crowded take
the variants of a word with one letter deleted, of which near words share one, and which bound a group by the length of
the word and the alphabet. No group is cut or dropped.

Null texts have no words. A null id counts as the empty text in the draw of letters. Repeated rows count again. An
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidetable.llm.shared import materialize, ship, text_of

DRAW = 199
LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5
PARTS = 5
CROWD = 64

HELD_WORDS = 500_000  # words a task counts before it hands them on
LONG_TEXT = 1 << 22

_run = re.compile(f"[a-zÀ-ÿ]{{{LEAST_LENGTH},}}")
_KEPT_PARTS = list(itertools.combinations(range(PARTS), PARTS - 2))
_VALUES = [f"part_{i}" for i in range(PARTS)]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of a task's texts with partial counts; a run loses a letter where 199 divides its checksum."""
    held: Counter[str] = Counter()

    def given() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            lowered = text.as_py().encode().lower().decode()  # bytes: A-Z only
            runs = _run.findall(lowered) if len(lowered) < LONG_TEXT else (m[0] for m in _run.finditer(lowered))
            of_id = zlib.crc32(f"{doc_id}:".encode())
            for run, n in Counter(runs).items():
                drawn = zlib.crc32(run.encode(), of_id)
                if drawn % DRAW == 0:
                    place = drawn % len(run)
                    run = run[:place] + run[place + 1 :]
                    if len(run) < LEAST_LENGTH:
                        continue
                held[run] += n
            if len(held) > HELD_WORDS:
                yield given()
                held = Counter()
    if held:
        yield given()


def counted_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n``: words of ``LEAST_LENGTH`` letters and ``LEAST_COUNT`` occurrences at least, over whole texts."""
    ship(docs.sparkSession)
    given = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), text_of(text).alias("text"))
    words = given.mapInArrow(_counted, "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _mixed(value: int) -> int:
    """A well spread number of 64 bits."""
    value = (value ^ (value >> 30)) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF
    value = (value ^ (value >> 27)) * 0x94D049BB133111EB & 0xFFFFFFFFFFFFFFFF
    return value ^ (value >> 31)


def part_values(word: str) -> list[int]:
    """What the word's vector holds in each part, as sums of 32-bit numbers of its dimensions."""
    parts, seen = [0] * PARTS, {}
    for letter in word:
        seen[letter] = seen.get(letter, 0) + 1
        dimension = _mixed(ord(letter) * 0x1F123BB5 + seen[letter])
        part = dimension % PARTS
        parts[part] = (parts[part] + (dimension >> 32)) & 0x7FFFFFFF
    return parts


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every word once per choice of parts, with the choice's number and what all parts hold."""
    for batch in batches:
        held = np.array([part_values(word) for word in batch.column(0).to_pylist()], np.int32).reshape(-1, PARTS)
        taken = np.repeat(np.arange(batch.num_rows), len(_KEPT_PARTS))
        choice = np.tile(np.arange(len(_KEPT_PARTS), dtype=np.int32), batch.num_rows)
        rows = pa.array(taken)
        columns = [batch.column(0).take(rows), batch.column(1).take(rows), pa.array(choice)]
        columns += [pa.array(held[taken, part]) for part in range(PARTS)]
        yield pa.RecordBatch.from_arrays(columns, names=["word", "n", "choice", *_VALUES])


def _first_choices() -> list[int]:
    """For every set of parts, as bits, the first choice that lies in it."""
    inside = [[n for n, kept in enumerate(_KEPT_PARTS) if all(mask >> p & 1 for p in kept)] for mask in range(1 << PARTS)]
    return [found[0] if found else -1 for found in inside]


def _agreed() -> Column:
    """Whether the choice of a pair's rows is the first one on whose parts both words agree."""
    mask = sum(((F.col(v) == F.col(f"o_{v}")).cast("int") * (1 << i) for i, v in enumerate(_VALUES)), F.lit(1))
    return F.element_at(F.array(*[F.lit(n) for n in _first_choices()]), mask) == F.col("choice")


def _pairs(rows: DataFrame, also: Column | None = None) -> DataFrame:
    """Words of one key that differ by exactly one letter, each pair from the first signature that it shares."""
    right = rows.select(*[F.col(c).alias(f"o_{c}") for c in rows.columns])
    meet = (F.col("key") == F.col("o_key")) & (F.col("word") < F.col("o_word"))
    meet = meet & (F.abs(F.length("word") - F.length("o_word")) <= 1)
    met = rows.join(right, meet if also is None else meet & also)
    near = _agreed() & (F.levenshtein("word", "o_word", 1) == 1)
    return met.where(near).select("word", "n", F.col("o_word").alias("other"), F.col("o_n").alias("other_n"))


def _split(rows: DataFrame, crowd: int) -> tuple[DataFrame, DataFrame]:
    """Rows whose key at most ``crowd`` words share, and the others."""
    crowded = rows.groupBy(F.col("key").alias("__crowded")).count().where(F.col("count") > crowd).select("__crowded")
    crowded = materialize(crowded)
    same = F.col("key") == F.col("__crowded")
    return rows.join(crowded, same, "left_anti"), rows.join(crowded, same, "left_semi")


def _with_halves(rows: DataFrame) -> DataFrame:
    """Keys with a half of the word: for partners of its length or longer, and for those one letter shorter."""
    length = F.length("word")
    options = []
    for shortest in (length, length - 1):
        half = F.shiftright(shortest, 1)
        for side, part in ((0, F.col("word").substr(F.lit(1), half)), (1, F.col("word").substr(length - half + 1, half))):
            options.append(F.struct(shortest.alias("shortest"), F.lit(side).alias("side"), part.alias("half")))
    halves = rows.select("*", F.explode(F.array(*options)).alias("__h"))
    key = F.xxhash64("key", "__h.shortest", "__h.side", "__h.half")
    return halves.select("word", "n", "choice", *_VALUES, key.alias("key"), F.col("__h.shortest").alias("shortest"))


def _with_deletions(rows: DataFrame) -> DataFrame:
    """Keys with the word itself and with each of its variants that lack one letter."""
    word, length = F.col("word"), F.length("word")
    cut = F.transform(
        F.sequence(F.lit(1), length), lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, length))
    )
    variants = F.array_distinct(F.concat(F.array(word), cut))
    spelled = rows.select("*", F.explode(variants).alias("__v"))
    return spelled.withColumn("key", F.xxhash64("key", "__v")).drop("__v")


def near_pairs(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """``word, n, other, other_n``, once per pair of words (``word, n``, distinct) that differ by exactly one letter."""
    ship(words.sparkSession)
    schema = ", ".join(["word string, n long, choice int", *[f"{v} int" for v in _VALUES]])
    signed = words.select("word", "n").mapInArrow(_signed, schema)
    key = F.xxhash64("choice", *[F.when(_takes("choice", part), F.col(v)) for part, v in enumerate(_VALUES)])
    few, many = _split(materialize(signed.withColumn("key", key)), crowd)
    few_halves, many_halves = _split(materialize(_with_halves(many)), crowd)
    shortest = F.col("shortest") == F.least(F.length("word"), F.length("o_word"))
    shortest = shortest & (F.col("o_shortest") == F.col("shortest"))
    found = _pairs(few).unionByName(_pairs(few_halves, shortest)).unionByName(_pairs(_with_deletions(many_halves), shortest))
    return found.distinct()


def _takes(choice: str, part: int) -> Column:
    return F.col(choice).isin([number for number, kept in enumerate(_KEPT_PARTS) if part in kept])


def variants(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """``word, n, n_near, form, form_n``: a word's form is its commonest near word, if that is ``RATIO`` times as frequent."""
    pairs = materialize(near_pairs(words, crowd))
    turned = pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    best = F.min(F.struct((-F.col("other_n")).alias("down"), F.col("other").alias("other")))
    near = pairs.unionByName(turned).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    near = near.withColumnRenamed("word", "__word")
    joined = words.join(near, F.col("word") == F.col("__word"), "left")
    wins = -F.col("best.down") >= RATIO * F.col("n")
    return joined.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(wins, F.col("best.other")).alias("form"),
        F.when(wins, -F.col("best.down")).alias("form_n"),
    )


def with_roots(formed: DataFrame) -> DataFrame:
    """Add ``root``: where the forms of a word lead to, the word itself if it has none.

    Every step multiplies the count by ``RATIO`` at least, so chains are at most a logarithm of the largest count long;
    each round doubles the steps behind a pointer.
    """
    links = materialize(formed.where(F.col("form").isNotNull()).select("word", F.col("form").alias("to")))
    most = formed.agg(F.max("n")).first()[0] or 1
    steps = max(1, math.ceil(math.log(most, RATIO)))
    for _ in range(math.ceil(math.log2(steps + 1))):
        ahead = links.select(F.col("word").alias("__from"), F.col("to").alias("__to"))
        further = links.join(ahead, F.col("to") == F.col("__from"), "left")
        links = materialize(further.select("word", F.coalesce("__to", "to").alias("to")))
    ends = links.select(F.col("word").alias("__from"), F.col("to").alias("__to"))
    rooted = formed.join(ends, F.col("word") == F.col("__from"), "left")
    return rooted.select(*formed.columns, F.coalesce("__to", "word").alias("root"))


def spelling_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", crowd: int = CROWD) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every counted word of ``docs``."""
    words = materialize(counted_words(docs, doc_id, text))
    formed = materialize(variants(words, crowd))
    return with_roots(formed).select("word", "form", "root", "n", "n_near", "form_n")
