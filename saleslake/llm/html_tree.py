"""Block-level trees of HTML pages: what the page model looks at.

A lenient reader, made for broken markup: end tags that are left out are implied, unknown
ones pass, raw elements such as scripts end at their own end tag or at the end of the page.
Inline elements make no nodes; their text belongs to the block around them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)>""",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(
    r"""\b(class|id|role|data-content)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE
)

# Elements by how they are read.
RAW = frozenset("script style noscript template iframe svg textarea title select object".split())
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
BLOCK = frozenset(
    "html head body address article aside blockquote button center dd details dialog dir div dl"
    " dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup legend li main"
    " menu nav ol option p pre section summary table tbody td tfoot th thead tr ul caption"
    " label".split()
)
_CLOSED_BY_OWN = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
    "body": ("head",),
}
_SCOPE = frozenset("html body table ul ol dl article section div main td th form".split())
_NOT_IN_P = BLOCK - {"button", "label", "option", "legend", "summary"}


@dataclass(slots=True)
class Node:
    """A block element, or a run of text in one (tag `#text`)."""

    tag: str
    parent: int
    names: str = ""
    label: int | None = None
    text: str = ""
    words: int = 0
    linked: int = 0
    stops: int = 0
    children: int = field(default=0)


def parse(page: str) -> list[Node]:
    """Nodes in page order, parents before children; the first is the page itself."""
    nodes = [Node("#page", -1)]
    stack = [0]
    parts: list[str] = []
    links = linked = 0
    at, size = 0, len(page)
    raw_end: dict[str, re.Pattern] = {}

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                words = text.count(" ") + 1
                nodes.append(
                    Node("#text", stack[-1], label=nodes[stack[-1]].label, text=text, words=words,
                         linked=min(linked, words), stops=sum(map(text.count, ".!?")))
                )
            parts.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        parts.append(text)
        if links:
            linked += len(text.split())

    def close(upto: int) -> None:
        flush()
        del stack[upto:]

    while at < size:
        found = _TOKEN.search(page, at)
        if not found:
            add(page[at:])
            break
        if found.start() > at:
            add(page[at : found.start()])
        at = found.end()
        tag = found[2] or found[5]
        if not tag:
            continue
        tag = tag.lower()
        ends = bool(found[1] or found[4])
        if tag in RAW:
            if not ends and not (found[3] or found[6] or "").endswith("/"):
                pattern = raw_end.setdefault(tag, re.compile(f"</{tag}[^>]*+>", re.IGNORECASE))
                end = pattern.search(page, at)
                at = end.end() if end else size
            continue
        if tag not in BLOCK:
            if tag == "a":
                links = max(0, links + (-1 if ends else 1))
            elif tag in ("br", "hr", "img", "input"):
                parts.append(" ")
            continue
        if ends:
            for depth in range(len(stack) - 1, 0, -1):
                if nodes[stack[depth]].tag == tag:
                    close(depth)
                    break
            else:
                flush()
            links = 0
            continue
        flush()
        links = 0
        if tag in _NOT_IN_P and nodes[stack[-1]].tag == "p":
            close(len(stack) - 1)
        if tag in _CLOSED_BY_OWN:
            for depth in range(len(stack) - 1, 0, -1):
                name = nodes[stack[depth]].tag
                if name in _CLOSED_BY_OWN[tag]:
                    close(depth)
                    if tag != "tr":
                        break
                elif name in _SCOPE:
                    break
        names, label = "", nodes[stack[-1]].label
        attributes = found[3] or found[6]
        if attributes:
            for name, *values in _ATTRIBUTE.findall(attributes):
                value = next((v for v in values if v), "")
                if name.lower() == "data-content":
                    label = int(value)
                else:
                    names += " " + value.lower()
        nodes.append(Node(tag, stack[-1], names=names, label=label))
        stack.append(len(nodes) - 1)
    flush()
    return nodes
