"""Texts far longer than usual, and values at the edges of types."""

from __future__ import annotations

import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tests.llm import helpers as H
from tidetable.llm import chat, page_text, queries, secret_scan, suffix_dedup, topk_search


def plain_linked(text: str) -> list[tuple]:
    """Weak spans with what completes them, by nested loops."""
    base = H.base_spans(text)
    account = re.compile(r"""(?:access_?key_?id|client_?id|account|user_?name|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,}""", re.I | re.A)
    address = re.compile(r"""(?:(?:https?|ftp|s3|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)):[/]{2}[^\s"'<>]+""", re.I | re.A)
    mixed = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
    weak = [(m.start(), 3, m.end(), "account") for m in account.finditer(text)]
    weak += [(m.start(), 4, m.end(), "mixed") for m in mixed.finditer(text) if re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0])]
    weak += [(m.start(), 5, m.end(), "address") for m in address.finditer(text)]
    every = base + weak
    near = lambda a, kinds: any(b[3] in kinds and abs(a[0] // 256 - b[0] // 256) <= 1 for b in every)
    ids, secrets = ("account", "access"), ("assign", "hex", "mixed")
    needs = {"account": (secrets,), "mixed": (ids,), "address": (ids, secrets)}
    return sorted(base + [s for s in weak if all(near(s, kinds) for kinds in needs[s[3]])])


def secret_text(rng: random.Random, n: int) -> str:
    parts = [
        "account: someone ", "login=bob_1 ", "https://host/path?x=1 ", "password = hunter2hunter2 ", "AKIA" + "Z9" * 8 + " ", "0a" * 20 + " ",
        "q" * 70 + "7" + " ", "tok" * 8 + " ", "x1" * 15 + " ", "words and words é😀 ", "lorem " * 60, "s3://bucket/key ", "client_id: abc "
    ]
    return "".join(rng.choice(parts) for _ in range(n))


def test_linked_spans_equal_nested_loops(spark):
    rng = random.Random(9)
    rows = [(i, secret_text(rng, rng.choice([0, 1, 3, 8, 40, 400]))) for i in range(120)]
    rows += [(500, "login: meg " + "q" * 70 + "7"), (501, "q" * 25 + " login: meg"), (502, "1" * 90 + " login: meg " + "1" * 90 + "a")]
    got = {r["doc_id"]: r["spans"] for r in secret_scan.secret_spans(H.docs(spark, rows)).collect()}
    for doc_id, text in rows:
        assert got[doc_id] == ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in plain_linked(text))
    assert "mixed" in got[500] and "mixed" not in got[501] and "mixed" in got[502]


def plain_redacted(text: str) -> str:
    out, at = "", 0
    for start, _, end, _ in plain_linked(text):
        if start >= at:
            out += text[at:start] + secret_scan.REDACTED
        at = max(at, end)
    return out + text[at:]


def test_redaction_equals_a_plain_one_across_stretches(spark):
    rng = random.Random(3)
    rows = [(i, secret_text(rng, rng.choice([0, 2, 30, 600]))) for i in range(40)]
    rows += [(90, "é" * 8190 + "password=abcdefghijk😀 tail"), (91, "0a" * 9000 + " x"), (92, None)]
    got = {r["doc_id"]: r["text"] for r in secret_scan.redacted(H.docs(spark, rows)).collect()}
    for doc_id, text in rows:
        assert got[doc_id] == (None if text is None else plain_redacted(text))


def test_a_hundred_thousand_matches_in_one_text(spark):
    N = 50_000  # two matches each
    text = "".join(f"{i:032x} login: user{i} " for i in range(N))
    rows = H.docs(spark, [(1, text), (2, "none")])
    secret_scan.secret_spans(rows.where("doc_id = 2")).collect()
    started = time.monotonic()
    found = {r["doc_id"]: r for r in secret_scan.secret_spans(rows).collect()}
    assert time.monotonic() - started < 60
    assert found[1]["n_hex"] == N and found[1]["spans"].count("account") == N
    assert found[1]["base_sha256"] == H.sha(",".join(f"{k}:{s}:{e}" for s, _, e, k in H.base_spans(text)))


def test_conversations_beyond_the_limits_of_json(spark):
    long = "a<b[\\ é" * 3_600_000  # 25 million characters
    rows = [(1, 0, "user", long), (1, 1, "assistant", "x" + long), (2, 0, "user", "q"), (2, 1, "assistant", "r"), (3, 0, None, long), (3, 1, "odd", None)]
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    made = chat.canonical(chat.records_of(frame), paths="paths", rows="rows")
    got = {r["conv_id"]: r for r in chat.digests(chat.formatted(made)).collect()}
    for conv in (1, 2, 3):
        turns = [(role or "", text or "") for c, _, role, text in rows if c == conv]
        said = "".join(f"{role}\n{text}\n" for role, text in turns)
        loss = "".join(text for role, text in turns if role == "assistant")
        assert got[conv]["n_turns"] == len(turns) and got[conv]["turns_sha256"] == H.sha(said)
        assert got[conv]["loss_chars"] == len(loss) and got[conv]["loss_sha256"] == H.sha(loss)


def test_large_components_are_exact_or_refused(spark):
    def nearest(rows):
        frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        return sorted(tuple(r) for r in topk_search.nearest(frame, F.col("vec_id") == 0).collect())

    big = float(2**52)
    assert nearest([(0, [1.0 / 1024, 0.0]), (1, [big / 1024, 1.0]), (2, [-big / 1024, 1.0])]) == [(0, 1, 1, 2**52), (0, 2, 2, -(2**52))]
    for rows in ([(0, [1.0]), (1, [1e300])], [(0, [1e12]), (1, [1e12])]):
        with pytest.raises(Exception, match="64 bits"):
            nearest(rows)


def test_formulas_stay_in_their_block():
    page = "<main><article><h1>On energy</h1><p>Energy is <math><mi>E</mi><mo>=</mo><mi>m</mi></math> here, and the rest of the sentence goes on.</p></article></main>"
    blocks = [n.text for n in page_text.parse(page) if not n.tag]
    assert "Energy is E=m here, and the rest of the sentence goes on." in blocks


def test_what_is_left_is_given_as_text_too(spark):
    rows = H.cut_and_pasted()
    got = {r["doc_id"]: r for r in suffix_dedup.digests(suffix_dedup.without_repeats(H.docs(spark, rows))).collect()}
    for doc_id, text in rows:
        row = got[doc_id]
        assert row["n_kept"] == row["n_bytes"] - row["n_removed"] and row["n_bytes"] == len(text.encode())
        if not row["n_removed"]:
            assert row["text"] == text
        if "�" not in row["text"]:
            assert hashlib.sha256(row["text"].encode()).hexdigest() == row["kept_sha256"]


def test_queries_are_registered_in_order():
    assert [int(name[2:].split("_")[0]) for name in queries.QUERIES] == list(range(1, 14))
