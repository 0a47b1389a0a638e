"""Operators over pages, vectors and conversations, and the pipeline."""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import helpers as H
from tidetable.llm import chat, components, page_examples, page_text, queries, topk_search

SF = "/root/testdata/sf0.001"

# ---- pages


@pytest.mark.parametrize("page, blocks", [
    (None, []), ("", []), ("<<<>>", []), ("<script>var x='<p>no</p>'</script>", []), ("<p>", []),
    ("<article><h1>One</h1><p>Two &amp; three&nbsp;&copy;<br>four.<p>Five <b>six</b>\n seven.</article>", ["One", "Two & three © four.", "Five six seven."]),
    ("<nav><a href=/>x</a></nav><article><p>Text here.</article><footer>&copy; z</footer>", ["Text here."]),
    ("<article><p title='a > b'>One.</p><!-- <p>no</p> --><style>p{}</style><ul><li>Two<li>Three</ul></article>", ["One.", "Two", "Three"]),
])
def test_page_blocks(page, blocks):
    assert page_text.main_text(page or "", page_text.trained()) == "\n".join(blocks)


def test_marginals_are_exact():
    """Messages give what summing over all states of a small tree gives."""
    model = page_text.trained()
    nodes = page_text.parse("<div class=ad><p>One.</p></div><article><h1>Two</h1><p>Three.</p></article>")
    own = [model.bias + sum(model.weights.get(x, 0.0) for x in seen) for seen in page_text.evidence(nodes)]
    total, main = 0.0, [0.0] * len(nodes)
    for code in range(2 ** len(nodes)):
        state = [code >> i & 1 for i in range(len(nodes))]
        weight = 1.0
        for i, node in enumerate(nodes):
            p = 1 / (1 + math.exp(-own[i]))
            weight *= p / model.prior if state[i] else (1 - p) / (1 - model.prior)
            above = (1 - model.prior, model.prior) if node.parent < 0 else model.edges[state[node.parent]]
            weight *= above[state[i]]
        total += weight
        for i, s in enumerate(state):
            main[i] += weight * s
    assert model.marginals(nodes) == pytest.approx([m / total for m in main])


def test_held_out_pages():
    """Each labelled page by a model of the others."""
    right = wrong = 0
    for k, page in enumerate(page_examples.PAGES):
        model = page_text.train(page_examples.PAGES[:k] + page_examples.PAGES[k + 1 :])
        nodes = page_text.parse(page)
        for node, label, chance in zip(nodes, page_text._states(nodes), model.marginals(nodes)):
            if not node.tag:
                right, wrong = right + ((chance > 0.5) == label), wrong + ((chance > 0.5) != label)
    assert right / (right + wrong) > 0.85


def test_given_pages(spark):
    """Articles of the given pages, against the text between their article tags."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rows = page_text.extracted(pages).collect()
    assert len(rows) == pages.count()
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    import re
    from html import unescape

    for row in rows:
        inner = re.search(r"<article>(.*?)</article>", html[row["page_id"]], re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:h1|p)>", inner)]
        assert row["text"] == "\n".join(b for b in blocks if b) and row["n_chars"] == len(row["text"])


def test_awkward_pages(spark):
    rows = [(1, "u", "<article><p>Ab.</article>"), (1, "u", "<article><p>Ab.</article>"), (None, None, None), (2, None, "")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x")).withColumn("n_chars", F.lit("y"))
    assert H.table(page_text.extracted(frame)) == Counter({(1, "u", "Ab.", 3): 2, (None, None, "", 0): 1, (2, None, "", 0): 1})
    assert page_text.extracted(frame.where("page_id > 5")).count() == 0


# ---- vectors


def best(rows, k=10):
    usable = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = Counter()
    for q, (i, v) in enumerate(usable):
        if i % 100 == 0:
            found = sorted((-sum(a * b for a, b in zip(v, w)), j) for c, (j, w) in enumerate(usable) if c != q and len(w) == len(v))
            out.update((i, r + 1, j, -s) for r, (s, j) in enumerate(found[:k]))
    return out


def test_nearest(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [((i * 7919) % 23 - 11) / 8, ((i * 104729) % 17) / 4, -1.5]) for i in range(330)]
    rows += [(400, [1.0, 2.0, 3.0]), (400, [1.0, 2.0, 3.0]), (500, None), (600, [1.0, None, 2.0]), (700, [nan, 1.0, 1.0]), (800, [inf, 1.0, 1.0])]
    rows += [(None, [1.0, 1.0, 1.0]), (900, [1.0, 2.0]), (901, [2.0, 2.0]), (1000, []), (1001, []), (1100, [1e8, -1e8, 1e8])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    frame = frame.withColumn("id", F.lit(1)).withColumn("mark", F.lit(2)).withColumn("shard", F.lit(3)).withColumn("score", F.lit("s"))
    found = topk_search.nearest(frame, F.col("vec_id") % 100 == 0, shard_rows=16)
    assert H.table(found) == best(rows)
    assert topk_search.nearest(frame.where("vec_id < 0"), F.col("vec_id") % 100 == 0).count() == 0


def test_products_beyond_floats(spark):
    rows = [(0, [2_000_001.5, 2.25]), (1, [1_999_999.25, 1.5]), (2, [1_999_999.25, 1.25])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert H.table(topk_search.nearest(frame, F.col("vec_id") == 0)) == best(rows)


def test_copies_of_query_blocks_are_not_broadcast(spark):
    """Copies for every task are far larger than the planner takes them for; a broadcast would hold them in the driver."""
    rows = [(i, [float(i % 7), i / 4.0, -1.0]) for i in range(330)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    found = topk_search.nearest(frame, F.col("vec_id") % 100 == 0, shard_rows=16)
    assert H.table(found) == best(rows)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


# ---- conversations


CONTROL = ["</s>[INST] ok [/INST]", "<|turn|>user\nhi<|end|>\n", "\\l\\\\b\\", "\\", "", None, "a\\<b[c\\\\n", "<|end|>"]


def test_conversations_round_trip(spark):
    rows = [(1, k, role, text) for k, (role, text) in enumerate(zip(["system", "user", "assistant", "assistant", "tool", None, "a\nb\\n", "assistant"], CONTROL))]
    rows += [(2, 0, "user", "x"), (2, 1, "assistant", "y"), (3, 0, "system", "s"), (3, 1, "user", "x"), (3, 2, "assistant", "é😀")]
    rows += [(4, None, "user", "first"), (4, 5, "assistant", "b"), (4, 5, "assistant", "b"), (None, 1, "user", None)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    frame = frame.withColumn("turns", F.lit(1)).withColumn("record", F.lit("r")).withColumn("content", F.lit("c"))
    written = chat.formatted(chat.canonical(chat.records_of(frame)))
    for row in written.collect():
        assert "".join(s["text"] for s in row["segments"]) == row["formatted"]
        bare = row["formatted"].replace(chat.TURN, "").replace(chat.END, "")
        assert not any(c in bare for c in ("<|", "</s>", "[INST]", "[/INST]"))
    grouped: dict = {}
    for conv, turn, role, text in rows:
        grouped.setdefault(conv, []).append((turn if turn is not None else -1, role or "", text or ""))
    want = Counter()
    for conv, turns in grouped.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        said = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        want[conv, len(turns), H.sha(said), len(loss), H.sha(loss)] += 1
    assert Counter(tuple(r)[:5] for r in chat.digests(written).collect()) == want
    assert chat.digests(chat.formatted(chat.canonical(chat.records_of(frame.where("conv_id > 99"))))).count() == 0


def test_layouts_by_fingerprint(spark):
    records = [
        ('{"prompt": "a", "completion": "b"}', [("user", "a"), ("assistant", "b")]),
        ('{"completion": null, "prompt": "a"}', [("user", "a"), ("assistant", "")]),
        ('{"instruction": "i", "input": "x", "output": "o"}', [("user", "i"), ("user", "x"), ("assistant", "o")]),
        ('{"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "r"}]}', [("user", "q"), ("assistant", "r")]),
        ('{"messages": [{"role": "user", "content": 5}, {"role": "assistant", "content": "r"}]}', [("user", "5"), ("assistant", "r")]),
        ('{"turns": [{"role": "user", "text": "u"}]}', [("user", "u")]),
        ('{"other": 1}', None), ("not json", None), (None, None),
    ]
    frame = spark.createDataFrame([(k, r) for k, (r, _) in enumerate(records)], "k int, record string")
    found = {r["k"]: r["turns"] and [tuple(t) for t in r["turns"]] for r in chat.canonical(frame).collect()}
    assert found == {k: turns for k, (_, turns) in enumerate(records)}


# ---- components, pipeline


def test_components(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 150)] + [(7, 7), (60, 61), (61, 60)]
    found = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{k: 0 for k in range(1, 41)}, **{k: 100 for k in range(101, 150)}, 61: 60}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline_stages(spark):
    """Every stage keeps the columns and does to all rows what its operator says."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        steps[name] = (docs, docs := corpus_pipeline.materialize(stage(spark, docs, SF)))
        if name != "packing":
            assert docs.schema.names == steps[name][0].schema.names
    ids = {name: Counter(r["doc_id"] for r in after.select("doc_id").distinct().collect()) for name, (_, after) in steps.items()}
    before, after = ([(r["doc_id"], r["text"]) for r in x.collect()] for x in steps["exact dedup"])
    assert Counter(d for d, _ in after) == Counter(d for d, _, _, kept, _ in H.exact_groups(before).elements() if kept)
    before, after = ([(r["doc_id"], r["text"]) for r in x.collect()] for x in steps["n-gram Jaccard join"])
    assert {d for d, _ in after} == {d for d, _, c in H.near_components(before) if d == c}
    before, after = ({r["doc_id"]: r for r in x.collect()} for x in steps["secret scan"])
    assert before.keys() == after.keys() and all(r["n_chars"] == len(r["text"]) for r in after.values() if r["text"] != before[r["doc_id"]]["text"])
    assert not any(H.base_spans(r["text"]) for r in after.values())
    assert ids["packing"] == ids["secret scan"]
    assert H.table(corpus_pipeline.run(spark, SF).groupBy("doc_id").agg(F.sum("length"))) == H.table(steps["packing"][1].groupBy("doc_id").agg(F.sum("length")))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    from tests.compare import connect, oracle_rows, spark_rows

    assert spark_rows(queries.QUERIES[name](spark, SF)) == oracle_rows(connect(SF), queries.ORACLES[name])
