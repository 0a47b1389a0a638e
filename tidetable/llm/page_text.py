"""Main text of web pages by a tree-structured graphical model over the DOM.

Every element and every block of text is a node with a hidden state, main text or not. A node's own evidence comes
from its tag, its class and id words, its links and its text; a potential on each edge says how states of parent and
child go together. Messages from the leaves to the root and back give exact marginals in two passes, and the blocks
with a marginal above one half are the main text. Both kinds of potentials are learned from labelled pages: those of
`page_examples`, or others given to `train`.

Tags are read tolerantly: optional end tags may be missing, unknown end tags are ignored, an element that is still
open ends with the page. Scripts and what stands in for them, styles, comments and the head have no text; formulas are part of their block, and
what an object or a canvas holds is judged like other text. White space inside a block becomes one
space; blocks are joined in page order by line ends. Null and empty pages, and pages without text, give empty texts;
text outside any tag is a page's text as any other. Repeated rows give repeated results.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidetable.llm import page_examples
from tidetable.llm.shared import ship, text_of

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template iframe svg title head".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr "
    "math mfrac mi mn mo mover mrow ms mspace msqrt mstyle msub msubsup msup mtext munder semantics".split()
)
#: An opening tag of the first kind ends an open element of the second.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
}
ENDS |= dict.fromkeys(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split(),
    {"p"},
)
SCOPES = frozenset("table ul ol dl article section div main body html td th".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|(?P<text>[^<]+|<)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z][\w:-]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_WORD = re.compile(r"[a-z]+")
MARKS = (".", "!", "?", ":", "\"")


@dataclass
class Node:
    """An element, or a block of text (``tag`` empty)."""

    tag: str
    parent: int
    words: tuple[str, ...] = ()
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    label: int | None = None

    @cached_property
    def text(self) -> str:
        """The block's text; asked for once the page is read."""
        return " ".join("".join(self.parts).split())


def parse(page: str) -> list[Node]:
    """Nodes of a page, parents before children and blocks in page order."""
    nodes = [Node("page", -1)]
    stack, inline, block, at = [0], [], None, 0
    while at < len(page):
        token = _TOKEN.match(page, at)
        if token is None:  # a tag with an unclosed quote
            end = page.find(">", at)
            at = len(page) if end < 0 else end + 1
            continue
        at = token.end()
        if token["text"] is not None:
            if block is None:
                if token["text"].isspace():
                    continue
                nodes.append(Node("", stack[-1]))
                block = len(nodes) - 1
            text = html.unescape(token["text"])
            nodes[block].parts.append(text)
            if "a" in inline:
                nodes[block].linked += len(text)
            continue
        tag = (token["tag"] or "").lower()
        if not tag:
            continue
        if tag in INLINE:
            if tag == "br":
                if block is not None:
                    nodes[block].parts.append(" ")
            elif token["close"]:
                if tag in inline:
                    inline.remove(tag)
            elif tag not in VOID:
                inline.append(tag)
            continue
        block = None
        if token["close"]:
            for depth in range(len(stack) - 1, 0, -1):
                if nodes[stack[depth]].tag == tag:
                    del stack[depth:]
                    inline.clear()
                    break
            continue
        if tag in SILENT:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            if end is not None:
                at = end.end()
            elif tag not in ("head", "title"):
                at = len(page)
            continue
        if tag in ("html", "body"):
            continue
        ends = ENDS.get(tag, ())
        for depth in range(len(stack) - 1, 0, -1):
            open_tag = nodes[stack[depth]].tag
            if open_tag in ends:
                del stack[depth:]
                inline.clear()
                break
            if open_tag in SCOPES and open_tag not in ends:
                break
        values = {m[0].lower(): m[1] or m[2] or m[3] for m in _ATTRIBUTE.findall(token["rest"])}
        named = " ".join(values.get(k, "") for k in ("class", "id", "role")).lower()
        node = Node(tag, stack[-1], tuple(_WORD.findall(named)))
        if "data-main" in values:
            node.label = int(values["data-main"])
        nodes.append(node)
        if tag not in VOID:
            stack.append(len(nodes) - 1)
    return nodes


def evidence(nodes: list[Node]) -> list[list[str]]:
    """What is seen at each node, as names of features."""
    size = [0 if n.tag else len(n.text) for n in nodes]
    linked, blocks = [n.linked for n in nodes], [0 if n.tag else 1 for n in nodes]
    for i in range(len(nodes) - 1, 0, -1):
        above = nodes[i].parent
        size[above] += size[i]
        linked[above] += linked[i]
        blocks[above] += blocks[i]
    found = []
    for i, node in enumerate(nodes):
        share = int(linked[i] * 4 / size[i]) if size[i] else 0
        if node.tag:
            seen = [f"tag={node.tag}", f"links={share}", f"blocks={min(int(blocks[i] + 1).bit_length(), 5)}"]
            seen += [f"word={w}" for w in node.words]
        else:
            text = node.text
            seen = [f"text links={share}", f"size={min(len(text).bit_length() // 2, 4)}", f"mark={text[-1:] in MARKS}", f"rights={'©' in text}"]
        found.append(seen)
    return found


@dataclass
class Model:
    """Log odds of evidence for "main text", and the joint weight of parent's and child's states."""

    weights: dict[str, float]
    bias: float
    edges: list[list[float]]  # by the parent's state, then the child's
    prior: float

    def marginals(self, nodes: list[Node]) -> list[float]:
        """Chance of "main text" of every node, by sum-product messages up and down the tree."""
        get, (stay, begin), (leave, hold) = self.weights.get, *self.edges
        keep = math.log(self.prior / (1 - self.prior))
        # all messages as odds of "main text"; the prior is in the edges already, so own evidence leaves it out
        own = [min(max(self.bias + sum([get(x, 0.0) for x in seen]) - keep, -12.0), 12.0) for seen in evidence(nodes)]
        inward, up = own[:], [0.0] * len(nodes)
        for i in range(len(nodes) - 1, 0, -1):
            odds = math.exp(inward[i])
            up[i] = math.log((leave + hold * odds) / (stay + begin * odds))
            above = nodes[i].parent
            inward[above] = min(max(inward[above] + up[i], -300.0), 300.0)
        full = inward[:]
        full[0] += keep
        for i in range(1, len(nodes)):
            rest = math.exp(min(max(full[nodes[i].parent] - up[i], -300.0), 300.0))
            full[i] = inward[i] + math.log((begin + hold * rest) / (stay + leave * rest))
        return [1 / (1 + math.exp(-min(max(x, -300.0), 300.0))) for x in full]


def _states(nodes: list[Node]) -> list[int]:
    """Labels of all nodes: a mark holds down to the next; an element is main text if all the text in it is."""
    marks: list[int | None] = []
    for node in nodes:
        above = marks[node.parent] if node.parent >= 0 else None
        marks.append(node.label if node.label is not None else above)
    weight = np.zeros((len(nodes), 2))
    for i in range(len(nodes) - 1, -1, -1):
        if not nodes[i].tag:
            weight[i, marks[i] or 0] += len(nodes[i].text)
        if i:
            weight[nodes[i].parent] += weight[i]
    return [int(w[1] > 0 and w[0] == 0) if w.any() else m or 0 for m, w in zip(marks, weight)]


def train(pages: Iterable[str], rounds: int = 400) -> Model:
    """Potentials from labelled pages: a logistic model of single nodes, and counts of states along edges."""
    rows, states, edges = [], [], np.ones((2, 2))
    for page in pages:
        nodes = parse(page)
        labels = _states(nodes)
        rows += evidence(nodes)
        states += labels
        for node, label in zip(nodes, labels):
            if node.parent >= 0:
                edges[labels[node.parent], label] += 1
    counts = Counter(x for seen in rows for x in seen)
    names = sorted(counts)
    index = {name: k for k, name in enumerate(names)}
    row = np.repeat(np.arange(len(rows)), [len(x) for x in rows])
    column = np.array([index[x] for seen in rows for x in seen])
    target = np.array(states, float)
    weights, bias = np.zeros(len(names)), 0.0
    for _ in range(rounds):
        margin = np.bincount(row, weights[column], minlength=len(rows)) + bias
        error = 1 / (1 + np.exp(-margin)) - target
        weights -= 0.05 * (np.bincount(column, error[row], minlength=len(names)) / np.sqrt(np.array([counts[n] for n in names])) + 0.1 * weights)
        bias -= 0.5 * error.mean()
    return Model(dict(zip(names, weights.tolist())), float(bias), (edges / edges.sum(axis=1, keepdims=True)).tolist(), float(target.mean()))


@lru_cache(maxsize=1)
def trained() -> Model:
    return train(page_examples.PAGES)


def main_text(page: str, model: Model) -> str:
    """Blocks of the main text, joined by line ends."""
    nodes = parse(page)
    chances = model.marginals(nodes)
    return "\n".join(text for node, chance in zip(nodes, chances) if not node.tag and chance > 0.5 and (text := node.text))


def _extractor(model: Model | None):
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used = model or trained()
        for batch in batches:
            texts = [main_text(page.as_py(), used) for page in batch.column(2)]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    return extract


def extracted(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html", model: Model | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` per row."""
    ship(pages.sparkSession)
    given = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), text_of(page).alias("html"))
    return given.mapInArrow(_extractor(model), "page_id long, url string, text string, n_chars long")
