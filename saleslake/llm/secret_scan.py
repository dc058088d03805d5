"""Secrets in texts: fixed patterns, and literals assigned to sensitive names (1).

The method reads a text as source or configuration syntax. Wherever a name is followed by
an assignment sign, the right side is lexed into literals and names: quoted strings with
escapes and prefixes, put together by operators or by standing side by side, in brackets, lists
and arguments of calls, bare words, and references to names. Elements, attributes, options
of commands and indented blocks give names and literals as well. Constants are propagated through
references, before or after their use, so `k = "abc..."; password = k` marks the literal of `k`. A literal is scored by how sensitive
the names are that it reaches and by how much it looks like a generated value; prose after
a colon, placeholders and template variables stay below the threshold.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslake.llm.common import map_batches, packed, unpacked

# The base patterns, and the least lengths of what they must match.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LENGTH = 6

KINDS = ("assign", "access", "hex", "literal")
_RANK = {kind: at for at, kind in enumerate(KINDS)}

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns, leftmost and without overlap within a kind.

    The longest run is taken first and then measured, so a short one is dropped and not
    searched again. For the two run patterns the least length is part of the pattern, which
    is the same: no later start within a short run can be longer.
    """
    found: list[Span] = []
    if ":" in text or "=" in text:
        found += [
            ("assign", m.start(), m.end())
            for m in ASSIGN.finditer(text) if m.end() - m.start(2) >= ASSIGN_LENGTH
        ]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return found


# A target: an identifier, a dotted path, a quoted key or the last key of an index, and
# the sign after it. `==`, `!=`, `<=`, `>=` and `://` assign nothing. A name is tried once, from
# its start, so long names and wide gaps cost no more than their length.
_START = r"(?<![A-Za-z0-9_.\-])-*+(?P<name>[A-Za-z_][A-Za-z0-9_.\-]*+)"
_TARGET = re.compile(
    _START + r"""["'\]\)]*+[ \t]*+(?::=|=>|=(?![=~])|:(?![:/]{1,2}))[ \t]*+"""
)
_STRING = re.compile(
    r'''[A-Za-z]{0,2}(?:"""(?P<d3>(?:[^"\\]|\\.|"(?!""))*+)"""|"(?P<d>(?:[^"\\\n]|\\.)*+)"|'(?P<s>(?:[^'\\\n]|\\.)*+)'|`(?P<b>[^`\n]*+)`)'''
)
_BARE = re.compile(r"[^\s\"'`,;(){}\[\]<>#]+")
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_.]*+")
_NUMBER = re.compile(r"[0-9][A-Za-z0-9_.]*+")
_GAP = re.compile(r"[ \t]*+")
_WIDE_GAP = re.compile(r"\s*+")
_OPERATOR = re.compile(r"\|\||\?\?|[+.&%]")
# Pairs that other syntax writes without a sign: elements, attributes, options, indented blocks.
_ELEMENT = re.compile(
    r"<(?P<name>[A-Za-z_][A-Za-z0-9_.\-]*+)(?:\s[^<>]*+)?>\s*+(?P<value>[^<>]*?)\s*</(?P=name)>"
)
_ATTRIBUTES = re.compile(
    r"""\b(?:key|name|id)\s*+=\s*+["'](?P<name>[^"'<>\n]++)["']\s++value\s*+=\s*+["'](?P<value>[^"'<>\n]*+)["']"""
)
_OPTION = re.compile(
    r"""(?<![A-Za-z0-9_\-])--(?P<name>[A-Za-z][A-Za-z0-9_\-]*+)[ \t]++["']?(?P<value>[^\s"'\-][^\s"']*+)"""
)
_BLOCK = re.compile(
    r"(?m)^(?P<indent>[ \t]*+)(?P<name>[A-Za-z_][A-Za-z0-9_.\-]*+)[ \t]*+:[ \t]*+[|>][+\-]?[ \t]*+\n"
    r"(?P<value>(?:(?P=indent)[ \t]++[^\n]++\n?)++)"
)
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")

# How much a word of a name says that its value is secret. Words in `_WEAK`
# count only beside another word of the name, as in `api_key` or `auth_code`.
_STRONG = {
    "password": 3.0, "passwd": 3.0, "pwd": 3.0, "passphrase": 3.0, "secret": 3.0, "token": 2.5,
    "apikey": 3.0, "credential": 2.5, "credentials": 2.5, "privatekey": 3.0, "accesskey": 3.0,
    "secretkey": 3.0, "bearer": 2.5, "jwt": 2.5, "pass": 2.0, "auth": 1.5, "authorization": 2.0,
    "signature": 1.0, "salt": 1.5, "cookie": 1.0, "dsn": 1.0,
}
_WEAK = {"key": 1.5, "private": 1.0, "access": 1.0, "api": 1.0, "encryption": 1.5,
         "signing": 1.5, "client": 0.5, "session": 1.0, "code": 0.5}
_HARMLESS = {"public", "name", "file", "path", "url", "uri", "id", "type", "length", "size",
             "count", "hash", "policy", "field", "label", "hint", "expiry", "ttl", "column"}
_PLACEHOLDER = re.compile(
    r"(?i)(change_?me|example|placeholder|your[-_ ]|dummy|sample|redacted|xxxx|\*{3}|\.{3}"
    r"|^(?:true|false|null|none|undefined|nil|test|todo|default|password|secret|token)$"
    r"|^[$%@]|\$\{|\{\{|^<|^env\b|getenv|^os\.|^process\.)"
)
THRESHOLD = 4.0


@lru_cache(maxsize=4096)
def name_score(name: str) -> float:
    """How sensitive a target's name is; 0 if nothing says so."""
    words = [w.lower() for w in _PARTS.findall(name)]
    joined = "".join(words[-2:])
    score = max(
        [_STRONG.get(w, 0.0) for w in words] + [_STRONG.get(joined, 0.0)], default=0.0
    )
    weak = sum(_WEAK.get(w, 0.0) for w in set(words))
    if weak and (score or len(words) > 1):
        score += weak
    return score / 3 if words and words[-1] in _HARMLESS else score


def literal_score(value: str) -> float:
    """How much a value looks generated: its length, mixture of characters and entropy."""
    size = len(value)
    if size < 6 or any(c.isspace() for c in value) or _PLACEHOLDER.search(value):
        return -10.0
    entropy = -sum(n / size * math.log2(n / size) for n in Counter(value).values())
    classes = (
        any("a" <= c <= "z" for c in value) + any("A" <= c <= "Z" for c in value)
        + any("0" <= c <= "9" for c in value)
        + any(not c.isalnum() and c.isascii() for c in value)
    )
    return min(size, 40) / 20 + (classes - 1) * 0.75 + (entropy - 2.5) * 0.6


@dataclass
class _Value:
    """One value on a right side: its literals and the names it refers to, in order.

    `word` is the whole of an unquoted value, which is meant if it names nothing.
    """

    parts: list[tuple[int, int] | str]
    quoted: bool = False
    called: bool = False
    word: tuple[int, int] | None = None


def _right_side(text: str, at: int) -> tuple[list[_Value], int]:
    """The values at a position, and where they end.

    An expression is strings, with prefixes, names and numbers, joined by operators or by
    standing side by side, in brackets or as arguments of calls; values in brackets are parted
    by commas. Without a string or a name the value is a bare word.
    """
    values, depth, operand, end = [_Value([])], 0, False, at
    while True:
        at = (_WIDE_GAP if depth else _GAP).match(text, at).end()
        sign = text[at : at + 1]
        if found := _STRING.match(text, at):
            values[-1].parts.append(found.span(found.lastgroup))
            values[-1].quoted = operand = True
            at = end = found.end()
        elif sign in ("(", "[", "{") and sign:
            if operand and sign != "(":
                break
            depth, operand, at = depth + 1, False, at + 1
        elif sign in (")", "]", "}") and sign and depth:
            depth, operand, at = depth - 1, True, at + 1
            end = at
        elif sign == "," and depth:
            values.append(_Value([], called=values[-1].called))
            operand, at = False, at + 1
        elif operand and (found := _OPERATOR.match(text, at)):
            operand, at = False, found.end()
        elif not operand and (found := _NAME.match(text, at)):
            at = found.end()
            if text[at : at + 1] == "(":
                values[-1].called = True
            else:
                values[-1].parts.append(found.group().rstrip("."))
                operand = True
        elif not operand and (found := _NUMBER.match(text, at)):
            operand, at = True, found.end()
        else:
            break
    return values, end


def _assignments(text: str) -> Iterator[tuple[str, _Value]]:
    """Names and what they are given, in order."""
    at = 0
    while target := _TARGET.search(text, at):
        values, end = _right_side(text, target.end())
        at = max(target.end(), end)
        name = target.group("name").rstrip(".-")
        quoted = any(value.quoted for value in values)
        if not quoted:
            at = target.end()
            bare = _BARE.match(text, at)
            if bare:
                word = bare.group().rstrip(".:")
                parts = [word] if _NAME.fullmatch(word) else []
                yield name, _Value(parts or [bare.span()], word=bare.span())
                continue
        for value in values:
            if value.parts:
                yield name, value


def _pairs(text: str) -> Iterator[tuple[str, _Value]]:
    """Names and values of syntax without a sign of assignment."""
    for given, pattern, quoted in (
        ("</", _ELEMENT, True), ("value", _ATTRIBUTES, True), ("--", _OPTION, False),
    ):
        if given in text:
            for found in pattern.finditer(text):
                yield found.group("name"), _Value([found.span("value")], quoted)
    if "|\n" in text or ">\n" in text or "|" in text:
        for found in _BLOCK.finditer(text):
            start = found.start("value")
            lines = [
                (start + line.start(), start + line.end())
                for line in re.finditer(r"\S+", found.group("value"))
            ]
            yield found.group("name"), _Value(lines, True)


def _literals(
    value: _Value, at: int, places: dict[str, list[int]], given: list[tuple[str, _Value]]
) -> list[tuple[int, int]]:
    """The literals of a value, through the names it refers to, each once.

    A name means what it was given last before, else what it is given first after.
    """
    spans: dict[tuple[int, int], None] = {}
    seen, waiting = {at}, [(at, part) for part in reversed(value.parts)]
    while waiting:
        here, part = waiting.pop()
        if not isinstance(part, str):
            spans[part] = None
            continue
        word = given[here][1].word
        found = places.get(part) or places.get(part.rpartition(".")[2]) or []
        if found:
            before = bisect_left(found, here)
            there = found[before - 1] if before else found[0]
            if there not in seen:
                seen.add(there)
                waiting += [(there, x) for x in reversed(given[there][1].parts)]
        elif word:
            spans[word] = None
    return list(spans)


def literal_spans(text: str) -> list[Span]:
    """Literals that sensitive names hold, directly or through other names.

    Names are given values by signs of assignment, by elements and attributes, by options of
    commands and by indented blocks. An unquoted value, and one that is an argument of a call,
    must carry a digit, or an ordinary word after `secret:` would count.
    """
    if ":" not in text and "=" not in text and "--" not in text and "</" not in text:
        return []
    given = [*_assignments(text), *_pairs(text)]
    places: dict[str, list[int]] = {}
    for at, (name, _) in enumerate(given):
        places.setdefault(name, []).append(at)
        if "." in name:
            places.setdefault(name.rpartition(".")[2], []).append(at)
    marked: set[tuple[int, int]] = set()
    for at, (name, value) in enumerate(given):
        sensitive = name_score(name)
        if not sensitive:
            continue
        spans = _literals(value, at, places, given)
        whole = "".join(text[start:end] for start, end in spans)
        bare = not value.quoted and spans in ([], [value.word])
        if (value.called or bare) and not any("0" <= c <= "9" for c in whole):
            continue
        if sensitive + literal_score(whole) >= THRESHOLD:
            marked.update(span for span in spans if span[1] > span[0])
    return [("literal", start, end) for start, end in sorted(marked)]


def _digest(spans: list[Span]) -> str:
    ordered = sorted(spans, key=lambda s: (s[1], _RANK[s[0]], s[2]))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in ordered)


def _scan_batch(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    counts: dict[str, list[int]] = {kind: [] for kind in KINDS}
    digests, spans = [], []
    for text in batch.column(0).to_pylist():
        text = text or ""
        base, more = base_spans(text), literal_spans(text)
        found = Counter(span[0] for span in base + more)
        for kind in KINDS:
            counts[kind].append(found[kind])
        digests.append(hashlib.sha256(_digest(base).encode()).hexdigest())
        spans.append(_digest(base + more))
    yield pa.RecordBatch.from_arrays(
        [*batch.columns[1:], *(pa.array(counts[k], pa.int64()) for k in KINDS),
         pa.array(digests, pa.string()), pa.array(spans, pa.string())],
        [*batch.schema.names[1:], *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
    )


def scan(documents: DataFrame, *, id_column: str = "doc_id", text_column: str = "text"):
    """(id, n_assign, n_access, n_hex, n_literal, base_sha256, spans) of every row.

    Spans are `kind:start:end` in code points, the end exclusive, by start and then kind.
    A null text is empty and has none. Rows stay apart whatever their ids: repeated and null
    ids are kept. Nothing is shuffled; a text is scanned whole by the task that holds it.
    """
    rows = documents.select(
        F.col(f"`{text_column}`").alias("text"), F.col(f"`{id_column}`").cast("long").alias("id")
    )
    return map_batches(
        rows, _scan_batch,
        "id long, n_assign long, n_access long, n_hex long, n_literal long,"
        " base_sha256 string, spans string",
    )


def redacted(text: str, mark: str = "[SECRET]") -> str:
    """The text with the secret part of every span replaced; overlapping spans are one."""
    inside = []
    for kind, start, end in base_spans(text) + literal_spans(text):
        if kind == "assign":
            start = ASSIGN.match(text, start).start(2)
        inside.append((start, end))
    if not inside:
        return text
    out, at = [], 0
    for start, end in sorted(inside):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _redact_batch(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    texts = [None if t is None else redacted(t) for t in batch.column(0).to_pylist()]
    yield pa.RecordBatch.from_arrays(
        [pa.array(texts, pa.string()), *batch.columns[1:]], batch.schema.names
    )


def redact(documents: DataFrame, *, text_column: str = "text", length_column: str | None = None):
    """The same rows and columns with secrets replaced by `[SECRET]`; null texts stay null.

    `length_column` names a column of the text's code points, which is brought in line for
    the texts that change.
    """
    rows = documents.select(F.col(f"`{text_column}`").alias("text"), packed(documents))
    done = map_batches(rows, _redact_batch, rows.schema)
    replaced = {text_column: F.col("text")}
    if length_column:
        kind = documents.schema[length_column].dataType
        kept = F.col(f"row.`{length_column}`")
        replaced[length_column] = F.when(
            F.col("text") != F.col(f"row.`{text_column}`"), F.length("text").cast(kind)
        ).otherwise(kept)
    return unpacked(done, documents.columns, replaced)
