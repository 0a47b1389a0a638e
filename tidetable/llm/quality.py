"""Text quality from weak labels: heuristic labellers, their accuracies by expectation-maximisation, a hashed scorer.

One pass measures every text (shares of symbols, capitals, repeats and the like). Labellers vote good, bad or nothing
on the measures. Votes fall into patterns, at most ``3 ** labellers`` whatever the number of documents, and only
pattern counts reach the driver: expectation-maximisation estimates from all of them how often each labeller votes
what on good and on bad texts, and so the posterior of each pattern. A linear scorer over hashed byte trigrams and
hashed measures is fitted to posteriors of a bounded sample (``SAMPLE`` confident texts of each kind, those with the
least hashes); a last pass scores every whole text with it.

Null texts are empty; a text without words scores 0 and is rejected. If no text is confidently bad or none good, no
other text is rejected. Equal texts score equally. Other columns are ignored by `scores` and kept by `accepted`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidetable.llm.hashing import prefix_sums, stretch
from tidetable.llm.shared import bytes_of, materialize, ship, slices, text_of, without

SAMPLE = 1500
CONFIDENT = 0.95
KEEP_FROM = 0.3  # below one half: a clean text lost costs more than a poor one kept
BUCKETS = 1 << 15
SHRINK = 200  # bytes of no evidence that every text is diluted with, so that short ones aren't judged by a few trigrams
BYTES_AT_ONCE = 1_000_000
MEASURES = ("words", "symbols", "capitals", "pipes", "bangs", "repeats", "distinct", "word_bytes", "digits", "ends")

_KINDS = np.zeros((256, 6), np.int64)
for _kind, _bytes in enumerate((b"#$%&*^~<>{}=@\\", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"|", b"!", b"0123456789")):
    _KINDS[list(_bytes), _kind] = 1


def measures(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """One row of ``MEASURES`` per text of the joined bytes."""
    sizes = np.diff(begins)
    rows = len(sizes)
    joined = np.full(len(data) + rows, 32, np.uint8)  # a space behind every text
    joined[np.arange(len(data)) + np.repeat(np.arange(rows), sizes)] = data
    starts = begins[:-1] + np.arange(rows)
    space = (joined == 32) | ((joined >= 9) & (joined <= 13))
    edges = np.flatnonzero(np.diff(np.r_[True, space].view(np.int8)))
    first, last = edges[::2], edges[1::2]
    cuts = np.searchsorted(first, np.r_[starts, len(joined)])
    words = np.diff(cuts)
    text = np.repeat(np.arange(rows), words)
    names = stretch(prefix_sums(joined), first, last)
    inner = text[1:] == text[:-1]
    repeats = np.bincount(text[1:][inner & (names[1:] == names[:-1])], minlength=rows)
    order = np.lexsort((names, text))
    fresh = np.r_[True, (names[order][1:] != names[order][:-1]) | (text[order][1:] != text[order][:-1])][: len(order)]
    distinct = np.bincount(text[order][fresh], minlength=rows)
    kinds = np.stack([np.add.reduceat(_KINDS[joined, k], starts) for k in range(6)]) if rows else np.zeros((6, 0))
    closing = np.isin(joined[last - 1], np.frombuffer(b".?!", np.uint8))
    ends = np.bincount(text[closing], minlength=rows)
    per_byte, per_word = np.maximum(sizes, 1), np.maximum(words, 1)
    letters = np.maximum(kinds[1] + kinds[2], 1)
    return np.stack([
        words, kinds[0] / per_byte, kinds[1] / letters, kinds[3] / per_word, kinds[4] / per_word, repeats / per_word,
        distinct / per_word, sizes / per_word, kinds[5] / per_byte, ends / per_word,
    ], axis=1)


def labellers() -> dict[str, Column]:
    """Votes by name: 1 good, 0 bad, -1 no opinion."""

    def vote(bad: Column, good: Column) -> Column:
        return F.when(bad, 0).when(good, 1).otherwise(-1)

    words, enough = F.col("words"), F.col("words") >= 8
    never = F.lit(False)
    return {
        "symbols": vote(F.col("symbols") > 0.06, enough & (F.col("symbols") < 0.02)),
        "capitals": vote(enough & (F.col("capitals") > 0.5), enough & (F.col("capitals") < 0.25)),
        "table": vote(enough & (F.col("pipes") > 0.25), never),
        "shouting": vote(enough & (F.col("bangs") > 0.3), never),
        "repeats": vote(enough & (F.col("repeats") > 0.2), enough & (F.col("repeats") < 0.08)),
        "distinct": vote((words >= 40) & (F.col("distinct") < 0.25), (words >= 40) & (words < 400) & (F.col("distinct") > 0.5)),
        "word_length": vote(enough & ((F.col("word_bytes") < 3) | (F.col("word_bytes") > 15)), enough & F.col("word_bytes").between(4, 12)),
        "marks": vote(enough & (F.col("symbols") + F.col("pipes") + F.col("bangs") > 0.2), never),
        "sentences": vote((words >= 40) & (F.col("ends") < 0.02), (words >= 1) & F.col("ends").between(0.03, 0.6) | (words < 8) & (F.col("ends") > 0)),
        "digits": vote(F.col("digits") > 0.3, never),
    }


def estimate(votes: np.ndarray, counts: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Posterior of "good" for each pattern of votes, by expectation-maximisation from any vote for bad on."""
    good, bad = (votes == 1).sum(axis=1), (votes == 0).sum(axis=1)
    # each labeller knows one kind of bad text and finds the others good, so one vote for bad outweighs good ones at first
    posterior = np.where(bad > 0, 0.02, np.where(good > 0, 0.98, 0.9))
    for _ in range(rounds):
        chance = []
        for weight in (counts * posterior, counts * (1 - posterior)):
            total = weight.sum()
            table = np.stack([((votes == v) * weight[:, None]).sum(axis=0) for v in (-1, 0, 1)])
            chance.append((np.log((total + 1) / (counts.sum() + 2)), np.log((table + 0.5) / (total + 1.5))))
        log_odds = chance[0][0] - chance[1][0]
        for k in range(votes.shape[1]):
            log_odds = log_odds + chance[0][1][votes[:, k] + 1, k] - chance[1][1][votes[:, k] + 1, k]
        posterior = 1 / (1 + np.exp(-np.clip(log_odds, -40, 40)))
    return posterior


def _trigrams(data: np.ndarray) -> np.ndarray:
    """Bucket of the three bytes from each place on; two fewer than there are bytes."""
    wide = data.astype(np.uint32)
    return ((wide[:-2] * np.uint32(0x9E3779B1)) ^ (wide[1:-1] * np.uint32(0x85EBCA77)) ^ (wide[2:] * np.uint32(0xC2B2AE3D))) >> np.uint32(17)


def _levels(rows: np.ndarray) -> np.ndarray:
    """Buckets of the measures, each cut into levels; behind those of the trigrams."""
    scale = np.array([0.02, 50, 10, 10, 10, 20, 10, 0.5, 20, 20])
    level = np.minimum((rows * scale).astype(np.int64), 15)
    return BUCKETS + np.arange(len(MEASURES)) * 16 + level


SIZE = BUCKETS + 16 * len(MEASURES)


def _each(batches: Iterator[pa.RecordBatch], text_at: int):
    for batch in batches:
        data, begins = bytes_of(batch.column(text_at))
        for a, b in slices(np.diff(begins), BYTES_AT_ONCE):
            part = data[begins[a] : begins[b]]
            yield batch.slice(a, b - a), part, begins[a : b + 1] - begins[a]


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, begins in _each(batches, 1):
        columns = measures(data, begins).T
        yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns)], names=["key", *MEASURES])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sparse features of sampled texts: buckets and values."""
    for batch, data, begins in _each(batches, 1):
        levels = _levels(measures(data, begins))
        buckets, values = [], []
        for row, (a, b) in enumerate(zip(begins[:-1].tolist(), begins[1:].tolist())):
            found, counts = np.unique(_trigrams(data[a:b]), return_counts=True) if b - a > 2 else (np.zeros(0), np.zeros(0))
            buckets.append(np.r_[found, levels[row]].astype(np.int32).tobytes())
            values.append(np.r_[10 * counts / (b - a + SHRINK), np.ones(len(MEASURES))].astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(buckets, pa.binary()), pa.array(values, pa.binary())], names=["key", "buckets", "values"])


def fit(buckets: list[np.ndarray], values: list[np.ndarray], target: np.ndarray, rounds: int = 150) -> np.ndarray:
    """Weights of a logistic scorer for soft targets, by gradient steps scaled per weight; the last one is the bias."""
    row = np.repeat(np.arange(len(buckets)), [len(x) for x in buckets])
    column, value = np.concatenate(buckets), np.concatenate(values).astype(float)
    weights, squares = np.zeros(SIZE + 1), np.full(SIZE + 1, 1e-8)
    for _ in range(rounds):
        margin = np.bincount(row, weights[column] * value, minlength=len(buckets)) + weights[-1]
        error = 1 / (1 + np.exp(-margin)) - target
        slope = np.r_[np.bincount(column, error[row] * value, minlength=SIZE), error.sum()] / len(buckets)
        slope[:-1] += 1e-5 * weights[:-1]
        squares += slope**2
        weights -= 0.2 * slope / np.sqrt(squares)
    return weights


def _scorer(model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.frombuffer(model.value)
        for batch, data, begins in _each(batches, 1):
            rows = measures(data, begins)
            sizes = np.diff(begins)
            sums = np.zeros(len(data) + 1)
            if len(data) > 2:
                np.cumsum(weights[_trigrams(data)], out=sums[1 : len(data) - 1])
                sums[len(data) - 1 :] = sums[len(data) - 2]
            until = np.maximum(begins[1:] - 2, begins[:-1])  # trigrams inside the text
            margin = 10 * (sums[until] - sums[begins[:-1]]) / (sizes + SHRINK) + weights[_levels(rows)].sum(axis=1) + weights[-1]
            scores = np.where(rows[:, 0] > 0, 1 / (1 + np.exp(-np.clip(margin, -40, 40))), 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["doc_id", "score"])

    return score


def train(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> np.ndarray | None:
    """The scorer's weights, from all texts' votes and a bounded sample's features; None without both kinds of texts."""
    ship(docs.sparkSession)
    body = text_of(text)
    keyed = docs.select(F.xxhash64(body, F.lit(1)).alias("key"), body.alias("text"))
    names = list(labellers())
    measured = keyed.mapInArrow(_measured, "key long, " + ", ".join(f"{m} double" for m in MEASURES))
    votes = materialize(measured.where("words > 0").select("key", *[v.cast("int").alias(f"v_{n}") for n, v in labellers().items()]))
    columns = [f"v_{n}" for n in names]
    # at most 3 ** 10 rows
    patterns = votes.groupBy(*columns).count().orderBy(*columns).toPandas()
    if not len(patterns):
        return None
    patterns["posterior"] = estimate(patterns[columns].to_numpy(), patterns["count"].to_numpy())
    known = docs.sparkSession.createDataFrame(patterns[[*columns, "posterior"]])
    labelled = votes.join(F.broadcast(known), columns).select("key", "posterior")
    chosen = None
    for confident in (F.col("posterior") > CONFIDENT, F.col("posterior") < 1 - CONFIDENT):
        part = labelled.where(confident).dropDuplicates(["key"]).orderBy("key").limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)
    chosen = materialize(chosen)  # at most twice the sample
    target = {row["key"]: row["posterior"] for row in chosen.collect()}
    if not any(p > 0.5 for p in target.values()) or not any(p < 0.5 for p in target.values()):
        return None
    texts = keyed.join(F.broadcast(chosen.select("key")), "key")
    rows = texts.mapInArrow(_features, "key long, buckets binary, values binary").dropDuplicates(["key"]).orderBy("key").collect()
    buckets = [np.frombuffer(r["buckets"], np.int32) for r in rows]
    values = [np.frombuffer(r["values"], np.float32) for r in rows]
    return fit(buckets, values, np.array([target[r["key"]] for r in rows]))


def scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", weights: np.ndarray | None = None) -> DataFrame:
    """``doc_id, score, kept`` per row; trained on the same texts unless weights are given."""
    weights = train(docs, text) if weights is None else weights
    if weights is None:
        weights = np.zeros(SIZE + 1)
        weights[-1] = 40.0
    model = docs.sparkSession.sparkContext.broadcast(weights.tobytes())  # 2^15 numbers and a few
    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    return given.mapInArrow(_scorer(model), "doc_id long, score double").select("doc_id", "score", (F.col("score") >= KEEP_FROM).alias("kept"))


def accepted(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose texts are kept, with all their columns."""
    keyed = docs.withColumn("__key", F.xxhash64(text_of(text)))
    rejected = materialize(scores(keyed, "__key", text).where("NOT kept").select("doc_id").distinct())
    return without(keyed, "__key", rejected).drop("__key")
