"""Hard negatives and spelling variants against plain versions."""

from __future__ import annotations

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_DIR
from tests.llm.helpers import CLASHING, docs, table
from tidetable.llm import hard_negatives, queries, spelling

# --- hard negatives


def plain_negatives(rows, is_anchor, k_pos=5, k_neg=5) -> Counter:
    usable = [
        (i, label, [math.floor(256 * x) for x in v])
        for i, label, v in rows
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = Counter()
    for a, (a_id, a_label, a_vector) in enumerate(usable):
        if not is_anchor(a_id):
            continue
        scored = [
            (-sum(x * y for x, y in zip(a_vector, v)), i, label)
            for r, (i, label, v) in enumerate(usable)
            if r != a and len(v) == len(a_vector)
        ]
        scored.sort()
        for down, p_id, _ in [s for s in scored if s[2] == a_label][:k_pos]:
            inside = [s for s in scored if s[2] != a_label and 80 * -down <= 100 * -s[0] <= 100 * -down]
            for rank, (n_down, n_id, _) in enumerate(inside[:k_neg], 1):
                out[a_id, p_id, rank, n_id, -down, -n_down] += 1
    return out


def vector_rows(seed: int = 3, n: int = 160, width: int = 70):
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(width)] for _ in range(3)]
    rows = []
    for i in range(n):
        near = [c + rng.uniform(-0.4, 0.4) for c in rng.choice(centres)]
        rows.append((i, rng.randrange(4) if i % 3 else 1, near))
    rows += [(5, 1, rows[5][2]), (20, 1, rows[20][2]), (20, 1, rows[20][2])]  # repeated rows, an anchor too
    rows += [(None, 1, near), (200, None, near), (210, 1, None), (220, 2, near[:-1] + [None]), (230, 2, near[:-1] + [float("nan")])]
    rows += [(240, 2, near[:-1] + [float("inf")]), (250, 2, near[:7]), (260, 2, near[:7]), (270, 1, near[:7]), (280, 1, []), (290, 2, [])]
    return rows


def vectors(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(3)
    for name in [*CLASHING, "mark", "vector", "id", "low", "cell"]:
        frame = frame.withColumn(name, F.lit(1))
    return frame


@pytest.mark.parametrize("block", [(2048, 512), (7, 3)])
def test_hard_negatives_equal_a_plain_version(spark, block):
    rows = vector_rows()
    got = hard_negatives.hard_negatives(
        vectors(spark, rows), F.col("vec_id") % 10 == 0, F.col("label"), shard_rows=block[0], anchor_block=block[1]
    )
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = plain_negatives(rows, lambda i: i % 10 == 0)
    assert table(got) == want and len(want) > 100


def test_copies_of_anchor_blocks_are_not_broadcast(spark):
    """Copies for every cell are far larger than the planner takes them for; a broadcast would hold them in the driver."""
    rows = vector_rows()
    got = hard_negatives.hard_negatives(vectors(spark, rows), F.col("vec_id") % 10 == 0, F.col("label"), shard_rows=7, anchor_block=3)
    assert table(got) == plain_negatives(rows, lambda i: i % 10 == 0)
    assert "BroadcastHashJoin [cell" not in got._jdf.queryExecution().executedPlan().toString()


def test_hard_negatives_with_large_components_and_without_rows(spark):
    rng = random.Random(1)
    rows = [(i, i % 2, [float(rng.randrange(-(2**20), 2**20)) * 2**s for s in (0, 1, 3)]) for i in range(40)]
    got = hard_negatives.hard_negatives(vectors(spark, rows), F.col("vec_id") % 5 == 0, F.col("label"))
    assert table(got) == plain_negatives(rows, lambda i: i % 5 == 0)
    empty = vectors(spark, rows).where("vec_id < 0")
    assert hard_negatives.hard_negatives(empty, F.col("vec_id") % 5 == 0, F.col("label")).count() == 0


def test_residue_products_are_exact():
    rng = np.random.default_rng(5)
    for size, width in ((3, 1), (300, 64), (2**20, 130), (2**40, 5)):
        a, b = (rng.integers(-size, size, (9, width)).astype(np.float64) for _ in range(2))
        want = a.astype(np.int64).astype(object) @ b.astype(np.int64).astype(object).T
        got = hard_negatives.exact_scores(a, b)
        assert (got == want).all() and (got.dtype == object) == (size == 2**40)


# --- spelling variants


def plain_words(rows) -> dict[str, int]:
    counts: Counter = Counter()
    lower = {c: c + 32 for c in range(65, 91)}
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def one_apart(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_variants(words: dict[str, int]) -> Counter:
    near: dict[str, set] = {w: set() for w in words}
    by_cut: dict[str, set] = {}
    for w in words:
        for v in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            by_cut.setdefault(v, set()).add(w)
    for group in by_cut.values():
        for a, b in itertools.combinations(group, 2):
            if one_apart(a, b):
                near[a].add(b)
                near[b].add(a)
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda o: (-words[o], [ord(c) for c in o]))
            if words[best] >= 5 * words[w]:
                form[w] = best
    out = Counter()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out[w, form.get(w), root, n, len(near[w]), words.get(form.get(w))] += 1
    return out


def spelled_docs(seed: int = 11) -> list[tuple]:
    """Chains of ever rarer variants, anagrams of few letters, letters beyond ASCII, awkward rows."""
    rng = random.Random(seed)
    rows = [(1, None), (2, ""), (3, " \n"), (None, "Überall " * 40), (None, None), (4, "x×y÷z×y÷ " * 9), (4, "ÀÉÎÕÜÿ " * 6)]
    rows += [(5, ("banana " * 200 + "bananas " * 40 + "bananass " * 8) * 1), (6, "xbananass " * 5 + "abcdef abcdeg " * 5)]
    syllables = ["ab", "ba", "aa", "bb"]
    few = ["".join(rng.choice(syllables) for _ in range(4)) for _ in range(300)]
    rows += [(10 + k, " ".join(rng.choice(few) for _ in range(400))) for k in range(12)]
    rows += [(10, rows[-1][1]), (10, rows[-1][1])]
    rows += [(40, " ".join(f"{w}{rng.choice('qrstuv')}" for w in few * 6)), (41, "longer" * 500 + " ") , (42, "tab\tseparated,commaed " * 6)]
    return rows


@pytest.mark.parametrize("crowd", [spelling.CROWD, 3, 0])
def test_spelling_groups_equal_a_plain_version(spark, crowd):
    rows = spelled_docs()
    got = spelling.spelling_groups(docs(spark, rows), crowd=crowd)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = plain_variants(plain_words(rows))
    assert table(got) == want
    assert any(key[1] for key in want) and any(key[1] and key[1] != key[2] for key in want) and max(k[4] for k in want) > 5


def test_spelling_of_the_given_documents_and_of_none(spark):
    given = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [tuple(r) for r in given.select("doc_id", "text").collect()]
    assert table(queries.QUERIES["op12_spelling"](spark, SF_DIR)) == plain_variants(plain_words(rows))
    assert spelling.spelling_groups(docs(spark, rows[:3]).where("doc_id < 0")).count() == 0


def test_every_near_pair_shares_a_signature():
    rng = random.Random(2)
    letters = "abcdeé"
    for _ in range(500):
        word = "".join(rng.choice(letters) for _ in range(rng.randrange(6, 14)))
        at = rng.randrange(len(word))
        for other in (word[:at] + word[at + 1 :], word[:at] + rng.choice(letters) + word[at:], word[:at] + rng.choice(letters) + word[at + 1 :]):
            a, b = spelling.part_values(word), spelling.part_values(other)
            assert sum(x != y for x, y in zip(a, b)) <= 2
