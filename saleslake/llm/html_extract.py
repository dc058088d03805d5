"""Main text of pages by sum-product on the page's tree (9).

Every block element and every run of text is a node that is content or not. Its features
(element, words of its class, id and role, lengths, share of linked words) give a potential;
a potential on each pair of parent and child lets a container's nature reach what it holds
and the other way round. Messages pass from the leaves to the root and back, once each,
which gives the exact marginal of every node; runs of text that are content with more than
even odds are the text. Potentials are trained on labelled pages: the nodes' by logistic
regression, the pairs' from counts. The page's root elements hold everything and say
nothing about it, so their pairs have no potential.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslake.llm.common import map_batches
from saleslake.llm.html_pages import labelled_pages
from saleslake.llm.html_tree import Node, parse

TRAINING_PAGES = 900
PENALTY = 0.01

# Elements that are told apart, and words that names are searched for.
_TAGS = {
    tag: group for group, tags in {
        "nav": "nav menu", "header": "header hgroup", "footer": "footer", "aside": "aside",
        "form": "form fieldset dialog", "field": "button label option legend", "main": "article main",
        "box": "div section center details", "p": "p", "head": "h1 h2 h3 h4 h5 h6",
        "list": "ul ol dl dir", "item": "li dt dd", "table": "table tbody thead tfoot tr td th",
        "quote": "blockquote pre figure figcaption caption", "title": "head",
    }.items() for tag in tags.split()
}
_WORDS = {
    "ads": "ad ads adbox adsbox adslot advert advertisement advertising sponsor sponsored promo"
           " promotion banner",
    "nav": "nav navbar navigation menu breadcrumb pagination pager topnav subnav",
    "footer": "footer copyright bottom",
    "header": "header masthead topbar",
    "side": "side sidebar widget related rail share sharing social tags recommended trending",
    "comment": "comment disqus reply replies response responses discussion",
    "notice": "cookie notice consent gdpr modal popup newsletter subscribe subscription alert"
              " paywall disclaimer",
    "form": "search login signin signup form",
    "content": "content article post entry story main body text",
}
_ROOTS = frozenset(("#page", "html", "body"))
_NAME = re.compile(r"[^\W_]+")
_KINDS = {word: kind for kind, words in enumerate(_WORDS.values()) for word in words.split()}
_GROUPS = sorted(set(_TAGS.values()))
_PLACE = {tag: _GROUPS.index(group) for tag, group in _TAGS.items()}
_FIRST_WORD = len(_GROUPS) + 1
_FIRST_STAT = _FIRST_WORD + len(_WORDS)
N_FEATURES = _FIRST_STAT + 18


@lru_cache(maxsize=8192)
def _named(names: str) -> tuple[int, ...]:
    """Features of the whole words of class, id and role; a plural counts as its singular."""
    found = {_KINDS.get(word, _KINDS.get(word.removesuffix("s"))) for word in _NAME.findall(names)}
    return tuple(_FIRST_WORD + kind for kind in found if kind is not None)


@dataclass(frozen=True)
class Model:
    """Weights of the node potentials, and the log potentials of (parent, child)."""

    weights: tuple[float, ...]
    pairs: tuple[tuple[float, float], tuple[float, float]]


def features(nodes: list[Node]) -> list[list[tuple[int, float]]]:
    """Sparse features of every node. Containers know the totals of what they hold.

    A page without `h1`, `article` and `main` is unmarked; there the share of the page's text
    outside links counts, of a block or of the block around a run of text.
    """
    words = [n.words for n in nodes]
    linked = [n.linked for n in nodes]
    stops = [n.stops for n in nodes]
    titled = [n.tag == "h1" for n in nodes]
    inside = [False] * len(nodes)
    for at in range(1, len(nodes)):
        up = nodes[at].parent
        inside[at] = inside[up] or nodes[up].tag in ("article", "main")
    for at in range(len(nodes) - 1, 0, -1):
        up = nodes[at].parent
        words[up] += words[at]
        linked[up] += linked[at]
        stops[up] += stops[at]
        titled[up] = titled[up] or titled[at]
    whole = max(words[0], 1)
    plain = max(words[0] - linked[0], 1)
    unmarked = not any(node.tag in ("h1", "article", "main") for node in nodes)
    out = []
    for at, node in enumerate(nodes):
        row: list[tuple[int, float]] = [(_FIRST_STAT, 1.0)]
        tag = node.tag
        if tag in _PLACE:
            row.append((_PLACE[tag], 1.0))
        if node.names:
            row.extend((k, 1.0) for k in _named(node.names))
        if tag == "header" and inside[at]:
            row.append((_FIRST_STAT + 1, 1.0))
        count = words[at]
        if tag == "#text":
            row.append((_FIRST_STAT + 2, 1.0))
            row.append((_FIRST_STAT + 3, min(math.log1p(count), 5.0) / 5))
            if node.text[0] in "©":
                row.append((_FIRST_STAT + 8, 1.0))
        if count:
            row.append((_FIRST_STAT + 4, linked[at] / count))
            row.append((_FIRST_STAT + 5, min(stops[at] / count, 0.3)))
            if linked[at] >= 0.8 * count:
                row.append((_FIRST_STAT + 6, 1.0))
        if inside[at]:
            row.append((_FIRST_STAT + 7, 1.0))
        if tag == "h1":
            row.append((_FIRST_STAT + 9, 1.0))
        elif titled[at]:
            row.append((_FIRST_STAT + 10, 1.0))
        elif tag != "#text":
            row.append((_FIRST_STAT + 11, count / whole))
        elif nodes[node.parent].tag in _ROOTS:
            row.append((_FIRST_STAT + 12, 1.0))
        if tag in ("p", "#text") and titled[node.parent]:
            row.append((_FIRST_STAT + 13, 1.0))
        if unmarked:
            row.append((_FIRST_STAT + 14, 1.0))
            if tag not in _ROOTS:
                share = (count - linked[at]) / plain
                row.append((_FIRST_STAT + 15, share))
                if share > 0.5:
                    row.append((_FIRST_STAT + 16, 1.0))
            if tag in ("p", "#text") and nodes[node.parent].tag in _ROOTS:
                row.append((_FIRST_STAT + 17, 1.0))
        out.append(row)
    return out


def marginals(nodes: list[Node], model: Model) -> list[float]:
    """Log odds of every node being content: messages up the tree, then down."""
    weights = model.weights
    (p00, p01), (p10, p11) = model.pairs
    exp, log = math.exp, math.log
    own = [sum(weights[k] * v for k, v in row) for row in features(nodes)]
    upward = own[:]
    message = [0.0] * len(nodes)

    def through(a: float, x00: float, x01: float, x10: float, x11: float) -> float:
        # the log odds that reach the other end of a pair, from this end's log odds
        a = 500.0 if a > 500.0 else -500.0 if a < -500.0 else a
        e = exp(a)
        return log((exp(x10) + exp(x11) * e) / (exp(x00) + exp(x01) * e))

    for at in range(len(nodes) - 1, 0, -1):
        up = nodes[at].parent
        if nodes[up].tag not in _ROOTS:
            message[at] = through(upward[at], p00, p01, p10, p11)
            upward[up] += message[at]
    belief = upward[:]
    for at in range(1, len(nodes)):
        up = nodes[at].parent
        if nodes[up].tag not in _ROOTS:
            belief[at] += through(belief[up] - message[at], p00, p10, p01, p11)
    return belief


def train(pages: list[str], rounds: int = 12) -> Model:
    """Potentials from pages whose blocks carry `data-content`; other nodes are left out."""
    rows, targets = [], []
    pairs = np.ones((2, 2))
    for page in pages:
        nodes = parse(page)
        for node, row in zip(nodes, features(nodes), strict=True):
            if node.label is None or node.tag in _ROOTS:
                continue
            rows.append(row)
            targets.append(node.label)
            if nodes[node.parent].tag not in _ROOTS:
                pairs[nodes[node.parent].label or 0, node.label] += 1
    matrix = np.zeros((len(rows), N_FEATURES))
    for at, row in enumerate(rows):
        for k, value in row:
            matrix[at, k] = value
    truth = np.array(targets, dtype=float)
    weights = np.zeros(N_FEATURES)
    for _ in range(rounds):  # Newton's steps on the penalised likelihood
        guess = 1 / (1 + np.exp(-np.clip(matrix @ weights, -30, 30)))
        slope = matrix.T @ (truth - guess) - PENALTY * weights
        curve = (matrix * (guess * (1 - guess))[:, None]).T @ matrix
        weights = weights + np.linalg.solve(curve + PENALTY * np.eye(N_FEATURES), slope)
    table = np.log(pairs / pairs.sum(axis=1, keepdims=True))
    return Model(tuple(weights.tolist()), tuple(tuple(r) for r in table.tolist()))


@lru_cache(maxsize=1)
def trained(count: int = TRAINING_PAGES) -> Model:
    return train(labelled_pages(count))


def main_text(page: str, model: Model) -> str:
    """Runs of text that are content, one to a line, in page order."""
    nodes = parse(page)
    if len(nodes) == 1:
        return ""
    odds = marginals(nodes, model)
    return "\n".join(
        node.text for node, odd in zip(nodes, odds, strict=True) if node.text and odd > 0
    )


def _extract_batch(batch: pa.RecordBatch, model: Model) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, 1024):
        some = batch.slice(at, 1024)
        texts = [main_text(page or "", model) for page in some.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [some.column(0), some.column(1), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def extract(
    pages: DataFrame, model: Model | None = None, *, id_column: str = "page_id",
    url_column: str = "url", html_column: str = "html",
) -> DataFrame:
    """(page_id, url, text, n_chars) of every row, from the whole page.

    A null or empty page has an empty text, and so has a page without content. Rows stay
    apart whatever their ids. The model is trained on the driver from a bounded number of
    labelled pages unless one is given.
    """
    rows = pages.select(
        F.col(f"`{id_column}`").cast("long").alias("page_id"),
        F.col(f"`{url_column}`").cast("string").alias("url"),
        F.col(f"`{html_column}`").alias("html"),
    )
    return map_batches(
        rows, partial(_extract_batch, model=model or trained()),
        "page_id long, url string, text string, n_chars long",
    )
