"""Small tables with the awkward cases every operator has to stand, and plain versions of what operators compute."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

DOCS = "doc_id long, text string"
#: Columns that operators use as names of their own.
CLASHING = ["kept", "group", "block", "class", "n", "score", "key", "__x", "word"]


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def awkward_docs() -> list[tuple]:
    """Nulls, empty and blank texts, ties, repeated rows, a long text, odd characters."""
    words = "the fog lifted slowly over the old harbour and nobody on the quay had expected the ferry back so soon".split()
    prose = " ".join(words)
    return [
        (1, prose), (2, prose), (2, prose), (3, None), (4, ""), (5, " \n\t "), (6, "é😀 日本 x"), (None, prose), (None, None),
        (7, prose + " again"), (8, " ".join(words * 300)), (9, "a"), (10, "A"), (11, "tab\tand  two   spaces \n\n end "),
    ]


def docs(spark, rows=None, partitions: int = 3):
    """A documents table with extra columns whose names clash with those inside operators."""
    rows = awkward_docs() if rows is None else rows
    frame = spark.createDataFrame(rows, DOCS).repartition(partitions)
    for name in CLASHING:
        frame = frame.withColumn(name, frame["doc_id"] % 2)
    return frame


def table(frame) -> Counter:
    return Counter(tuple(row) for row in frame.collect())


def exact_groups(rows) -> Counter:
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = Counter()
    for doc_id, text in rows:
        ids = groups[text or ""]
        keep = max((i for i in ids if i is not None), default=None)
        out[doc_id, keep, len(ids), doc_id == keep, sha(text or "")] += 1
    return out


def near_components(rows) -> Counter:
    words = re.compile(rb"[^\x20\x09-\x0D]+")
    sets = []
    for _, text in rows:
        w = words.findall((text or "").encode().lower())
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        r = find(i)
        if doc_id is not None:
            least[r] = min(least.get(r, doc_id), doc_id)
    return Counter((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows))


def removed_repeats(rows, length: int = 400) -> Counter:
    data = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(b[i : i + length] for _, b in data for i in range(len(b) - length + 1))
    out = Counter()
    for doc_id, b in data:
        spans = []
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + length
                else:
                    spans.append([i, i + length])
        left, at = b"", 0
        for first, end in spans:
            left, at = left + b[at:first], end
        left += b[at:]
        out[doc_id, len(b), len(b) - len(left), len(spans), sha(left)] += 1
    return out


_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A
)


def base_spans(text: str | None) -> list[tuple]:
    text = text or ""
    found = [(m.start(), 0, m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def edited_copies(seed: int = 7) -> list[tuple]:
    """Groups of texts that drift apart by small edits, so that links form chains."""
    rng = random.Random(seed)
    rows = []
    for g in range(14):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([3, 5, 6, 9, 30, 120]))]
        for k in range(10):
            rows.append((1000 + g * 100 + k, " ".join(words)))
            if rng.random() < 0.7:
                words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
            if rng.random() < 0.3:
                words.append("end")
    return rows


def cut_and_pasted(seed: int = 5) -> list[tuple]:
    """Texts that share stretches around the length that counts, periodic ones, and near copies."""
    rng = random.Random(seed)
    some = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    base = [some(n) for n in (399, 400, 401, 500, 900, 2500)]
    rows = []
    for k in range(25):
        text = some(rng.randrange(40))
        for _ in range(rng.randrange(4)):
            part = rng.choice(base)
            at = rng.randrange(len(part))
            text += part[max(0, at - rng.randrange(600)) : at + rng.randrange(800)] + some(rng.choice([0, 1, 90]))
        rows.append((2000 + k, text))
    near = list(some(1300))
    for k in range(12):
        copy = list(near)
        for _ in range(rng.randrange(3)):
            copy[rng.randrange(len(copy))] = "X"
        rows.append((3000 + k, "".join(copy)))
    return rows + [(4000, "a" * 399), (4001, "b" * 400), (4002, "c" * 401), (4003, "ab" * 500), (4004, "xyz " * 250)]
