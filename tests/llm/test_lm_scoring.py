"""Language-model scores against a plain model with the same steps of counts."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.conftest import SF_DIR
from tests.llm.helpers import awkward_docs, docs
from tidetable.llm import lm_scoring, queries
from tidetable.llm.lm_scoring import FLOOR, LEVELS, PRIOR

END = object()


def words_of(text: str | None) -> list:
    lower = {c: c + 32 for c in range(65, 91)}
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(lower)) + [END]


def is_held_out(doc_id) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


def steps(n: int) -> tuple[int, int]:
    """Least and largest count of the level of ``n``."""
    at = int(np.searchsorted(LEVELS, n, side="right"))
    return (int(LEVELS[at - 1]), int(LEVELS[at]) - 1) if at else (0, 0)


def plain_scores(rows, exact_words: bool = True) -> dict:
    """Rows by place: id, held out, tokens, known, training tokens, base score, score, as no filter would change them."""
    words, pairs, texts = Counter(), Counter(), 0
    for doc_id, text in rows:
        if not is_held_out(doc_id):
            tokens = words_of(text)
            words.update(tokens)
            pairs.update(zip([None, *tokens], tokens))
            texts += 1
    total, mass = sum(words.values()), sum(words.values()) + FLOOR * (len(words) + 1)
    out = []
    for doc_id, text in rows:
        tokens, base, score = words_of(text), 0.0, 0.0
        for before, word in zip([None, *tokens], tokens):
            base += math.log10((words[word] + FLOOR) / mass)
            of = texts if before is None else words[before]
            exact = exact_words or word is END
            low, top = (words[word], words[word]) if exact else steps(words[word])
            high = of if exact_words or before is None else steps(of)[1]
            seen = min(steps(pairs[before, word])[0], top, high)
            score += math.log10((seen + PRIOR * (low + FLOOR) / mass) / (high + PRIOR))
        known = sum(words[w] > 0 for w in tokens)
        out.append((doc_id, is_held_out(doc_id), len(tokens), known, total, base, score))
    return out


def rounded(rows) -> Counter:
    return Counter((*r[:5], round(r[5], 6), round(r[6], 6)) for r in rows)


COLUMNS = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


@pytest.mark.parametrize("frequent", [1 << 18, 3, 0])
def test_scores_equal_a_plain_model(spark, frequent):
    rows = awkward_docs() + [(100 + k, f"the Fog lifted {k % 7} times over the old harbour é{k % 3} " * (k % 5)) for k in range(60)]
    got = lm_scoring.lm_scores(docs(spark, rows), frequent=frequent)
    assert got.columns == COLUMNS
    found = got.collect()
    if frequent != 3:
        assert rounded(found) == rounded(plain_scores(rows, exact_words=frequent > 3))
    else:  # the three commonest words are exact, the others not: the base score is exact all the same
        want = plain_scores(rows)
        assert Counter((*r[:5], round(r[5], 6)) for r in found) == Counter((*r[:5], round(r[5], 6)) for r in want)


def test_ngrams_left_out_of_a_small_filter_are_counted_exactly(spark):
    """Where the levels don't fit, rare n-grams stay out of the filter; their exact counts give the same scores."""
    rows = awkward_docs() + [(100 + k, f"the Fog lifted {k % 7} times over the old harbour é{k % 3} " * (k % 5)) for k in range(60)]
    from pyspark.sql import functions as F

    training = docs(spark, rows).where(~lm_scoring.held_out(F.col("doc_id"))).select(lm_scoring.text_of("text").alias("text"))
    grams = lm_scoring.by_size(lm_scoring.counted_grams(training))
    assert lm_scoring.fitted(grams, filter_bits=64).least > 1
    got = lm_scoring.lm_scores(docs(spark, rows), filter_bits=64).collect()
    assert rounded(got) == rounded(plain_scores(rows))


def rare_docs():
    """Most words and pairs occur once."""
    return [(i, " ".join(["the", "old"] * (i % 3) + [f"w{(i * 131 + k * k * 17) % 2503}" for k in range(25)])) for i in range(90)]


@pytest.mark.parametrize("filter_bits, least", [(1 << 13, 2), (1 << 10, 3)])
def test_only_what_the_filter_leaves_open_is_looked_up(spark, filter_bits, least):
    """A left-out n-gram of a training text that can only be there once needs no lookup; others are looked up in rounds."""
    from pyspark.sql import functions as F

    rows = rare_docs()
    training = docs(spark, rows).where(~lm_scoring.held_out(F.col("doc_id"))).select(lm_scoring.text_of("text").alias("text"))
    model = lm_scoring.fitted(lm_scoring.by_size(lm_scoring.counted_grams(training)), filter_bits, 8)
    assert model.least == least if least == 2 else model.least >= least
    given = pa.record_batch({"doc_id": [i for i, _ in rows], "held_out": [is_held_out(i) for i, _ in rows], "text": [t for _, t in rows]})
    scored = lm_scoring._scored_slice(model, given, learned=True)
    columns = [f"{what}_{share}" for what in ("words", "pairs") for share in range(lm_scoring.ROUNDS)]
    for held, *asked in zip(given.column("held_out").to_pylist(), *(scored.column(c).to_pylist() for c in columns)):
        assert any(asked) == (held or least > 2)
        assert all(d["word"] is not None or d["before"] is not None for words in asked[: lm_scoring.ROUNDS] for d in words)
        assert all(d["pair"] % lm_scoring.ROUNDS == share % lm_scoring.ROUNDS for share, tokens in enumerate(asked) for d in tokens)
    assert rounded(lm_scoring.lm_scores(docs(spark, rows), filter_bits=filter_bits, frequent=8).collect()) == rounded(plain_scores(rows))


def test_no_training_rows_and_no_rows(spark):
    out = [i for i in range(200) if is_held_out(i)][:4]
    rows = [(out[0], "some words"), (out[1], None), (out[2], ""), (None, "x " * 50)]
    assert rounded(lm_scoring.lm_scores(docs(spark, rows)).collect()) == Counter(
        {(i, True, n, 0, 0, 0.0, 0.0): 1 for i, n in ((out[0], 3), (out[1], 1), (out[2], 1), (None, 51))}
    )
    assert lm_scoring.lm_scores(docs(spark, rows).where("doc_id < 0")).count() == 0


def test_a_text_of_millions_of_words(spark):
    rows = [(1, "lorem ipsum dolor " * 1_500_000), (2, "lorem ipsum"), (3, "x" * 5_000_000)]
    got = lm_scoring.lm_scores(docs(spark, rows)).collect()
    want = plain_scores(rows)
    assert Counter((*r[:5], round(r[5]), round(r[6])) for r in got) == Counter((*r[:5], round(r[5]), round(r[6])) for r in want)


def test_the_given_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: r for r in queries.QUERIES["op13_lm_scoring"](spark, SF_DIR).collect()}
    assert len(got) == len(rows)
    gains = []
    for doc_id, held_out, n_tokens, n_known, total, base, score in plain_scores(rows):
        row = got[doc_id]
        assert tuple(row[:5]) == (doc_id, held_out, n_tokens, n_known, total)
        assert row["base_score"] == pytest.approx(base, rel=1e-9)
        assert row["score"] == pytest.approx(score, rel=1e-3)
        gains.append((held_out, row["score"] - row["base_score"]))
    assert sum(g for h, g in gains if h) > 0 and sum(g for h, g in gains if not h) > 0


def model_of(rows, filter_bits=lm_scoring.BLOCK_BITS * 4, least=1):
    """A model without Spark, and its exact counts."""
    texts = pa.array([t for _, t in rows])
    tokens, previous, _ = lm_scoring.token_keys(texts)
    keys, counts = np.unique(np.concatenate([tokens, lm_scoring.pair_keys(previous, tokens)]), return_counts=True)
    blocks = filter_bits // lm_scoring.BLOCK_BITS
    bits = np.zeros((blocks, lm_scoring.BLOCK_BITS // 8), np.uint8)
    kept = counts >= least
    of = lm_scoring._block_of(keys, blocks)
    for b in range(blocks):
        inside = kept & (of == b)
        if inside.any():
            table = pa.table({"block": pa.array([b] * int(inside.sum()), pa.int32()), "key": keys[inside].view(np.int64), "n": counts[inside]})
            bits[b] = np.frombuffer(lm_scoring._filter_block(table).column("bits")[0].as_py(), np.uint8)
    words, n = np.unique(tokens, return_counts=True)
    return lm_scoring.Model(bits, words, n, len(rows), len(tokens), len(words), least), keys, counts


def test_the_filter_never_loses_a_level_and_rarely_adds_one():
    rows = [(k, " ".join(f"w{(k * 31 + j * j) % 97}" for j in range(200))) for k in range(50)]
    model, keys, counts = model_of(rows)
    found, true = model.levels(keys), lm_scoring.level_of(counts)
    assert (found >= true).all() and (found > true).mean() < 0.05
    absent = np.random.default_rng(1).integers(0, 1 << 63, 20_000, dtype=np.uint64)
    assert (model.levels(absent) > 0).mean() < 0.05


def test_probabilities_of_all_continuations_sum_to_one_at_most():
    rows = [(k, " ".join(f"w{(k * 31 + j * j) % 97}" for j in range(60))) for k in range(40)]
    model, _, _ = model_of(rows)
    for history in ("w1 ", "w36 ", ""):
        texts = [history + f"w{i}" for i in range(97)] + [history + "never"]
        batch = pa.record_batch({"doc_id": list(range(98)), "held_out": [False] * 98, "text": texts})
        # the probability of the word alone: without that of the end behind it and of the history
        whole = lm_scoring._scored_slice(model, batch).column("score").to_numpy()
        tokens, previous, _ = lm_scoring.token_keys(pa.array(texts))
        assert len(whole) == 98 and (whole < 0).all()
        shares = []
        for i, text in enumerate(texts):
            with_end = whole[i]
            ends = lm_scoring._scored_slice(model, pa.record_batch({"doc_id": [0], "held_out": [False], "text": [text]}))
            assert ends.column("score")[0].as_py() == pytest.approx(with_end)
            shares.append(10 ** (with_end - end_given(model, text.split()[-1]) - (0 if not history else first_word(model, history.strip()))))
        stop = 10 ** (end_given(model, history.strip()) if history else start_to_end(model))
        assert 0.5 < sum(shares) + stop <= 1 + 1e-9


def _one(model, text: str) -> float:
    return lm_scoring._scored_slice(model, pa.record_batch({"doc_id": [0], "held_out": [False], "text": [text]})).column("score")[0].as_py()


def start_to_end(model) -> float:
    return _one(model, "")


def first_word(model, word: str) -> float:
    return _one(model, word) - end_given(model, word)


def end_given(model, word: str) -> float:
    """The end behind a word: two texts that differ by one repetition of the pair in front of it."""
    twice, once = _one(model, f"{word} {word} {word}"), _one(model, f"{word} {word}")
    again = twice - once  # the word behind itself
    words = lm_scoring.word_keys(pa.array([word]))[0]
    counts, _ = model.known(words)
    start = np.array([lm_scoring.START])
    pair = model.levels(lm_scoring.pair_keys(start, words)) if counts[0] else np.zeros(1, np.int64)
    seen = min(int(model.low(pair)[0]), int(counts[0]), model.texts)
    alone = (int(counts[0]) + FLOOR) / model.mass
    first = math.log10((seen + PRIOR * alone) / (model.texts + PRIOR))
    return once - again - first
