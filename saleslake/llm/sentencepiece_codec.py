"""SentencePiece encoding by one pass of an Aho-Corasick automaton, and decoding (4).

The automaton holds all pieces. Running it over a text reports, at every position, the
pieces that end there by following the output links; each relaxes the best score of that
position from the best score where it begins. A character that no piece ends on is unknown
and costs ten more than the worst piece; it is written as bytes where the model has byte
pieces. Walking back from the end gives the ids.

If no piece goes on over a word mark, the best path of a text is that of its words one
after another, so each distinct word is solved once per task while it stays in a bounded
cache.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslake.llm.common import map_batches

MARK = "▁"
_CACHE = 300_000
# Kinds of pieces in a model file.
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and raw values of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(kind) or number()
        yield tag >> 3, data[at : at + size]
        at += size


class Codec:
    """Pieces of a model file, with encoding and decoding."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            model = list(_fields(file.read()))
        self.pieces: list[str] = []
        scores, kinds = [], []
        for field, value in model:
            if field == 1:
                part = dict(_fields(value))
                self.pieces.append(part[1].decode())
                scores.append(struct.unpack("<f", part[2])[0] if 2 in part else 0.0)
                kinds.append(part.get(3, _NORMAL))
        rules = dict(_fields(next((v for f, v in model if f == 3), b"")))
        if rules.get(2):
            raise ValueError("models with a character map are not supported")
        self.dummy_prefix = bool(rules.get(3, 1))
        self.squeeze = bool(rules.get(4, 1))
        normal = [s for s, k in zip(scores, kinds, strict=True) if k == _NORMAL]
        self.unknown_score = min(normal, default=0.0) - 10
        self.unknown = next((i for i, k in enumerate(kinds) if k == _UNKNOWN), 0)
        self.bytes = {
            int(p[3:5], 16): i
            for i, (p, k) in enumerate(zip(self.pieces, kinds, strict=True)) if k == _BYTE
        }
        self._from_byte = {i: bytes([b]) for b, i in self.bytes.items()}
        self._hidden = {i for i, k in enumerate(kinds) if k in (_CONTROL, _UNKNOWN)}
        self._text = [p.encode() for p in self.pieces]
        self._automaton = ahocorasick.Automaton()
        self.known: dict[int, tuple[str, float]] = {}
        by_word = True
        for i, (piece, kind) in enumerate(zip(self.pieces, kinds, strict=True)):
            if kind in (_NORMAL, _USER) and piece:
                self.known[i] = (piece, scores[i])
                self._automaton.add_word(piece, (len(piece), scores[i], i))
                by_word &= MARK not in piece.lstrip(MARK)
        self._automaton.make_automaton()
        self._singles = frozenset(
            p for p, k in zip(self.pieces, kinds, strict=True)
            if k in (_NORMAL, _USER) and len(p) == 1
        )
        self._words = regex.compile(f"{MARK}*[^{MARK}]+|{MARK}+") if by_word else None
        self._cache: dict[str, tuple[int, ...]] = {}

    def normalized(self, text: str) -> str:
        """The text with blanks as word marks, as the model's rules say."""
        if self.squeeze:
            text = " ".join(word for word in text.split(" ") if word)
        if not text:
            return ""
        return (MARK if self.dummy_prefix else "") + text.replace(" ", MARK)

    def best_path(self, text: str) -> list[int]:
        """Ids of the path of the highest total score over a normalised text.

        Of equal paths to a position, the one whose last piece is longest stays.
        """
        size = len(text)
        best = [0.0] + [-1e300] * size
        come: list[tuple[int, int]] = [(0, -1)] * (size + 1)
        if self._singles.issuperset(text):  # no character is unknown
            for end, (length, score, piece) in self._automaton.iter(text):
                total = best[end + 1 - length] + score
                if total > best[end + 1]:
                    best[end + 1] = total
                    come[end + 1] = (end + 1 - length, piece)
            path = []
            at = size
            while at:
                at, piece = come[at]
                path.append(piece)
            path.reverse()
            return path
        done = 0
        unknown = self.unknown_score

        def close(upto: int) -> None:
            # a position is settled once all pieces that end there were seen
            nonlocal done
            while done < upto:
                done += 1
                if text[done - 1] in self._singles:
                    continue
                if come[done][1] < 0 or best[done - 1] + unknown > best[done]:
                    best[done] = best[done - 1] + unknown
                    come[done] = (done - 1, self.unknown)

        for end, (length, score, piece) in self._automaton.iter(text):
            end += 1
            close(end - 1)
            start = end - length
            total = best[start] + score
            if come[end][1] < 0 or total > best[end]:
                best[end] = total
                come[end] = (start, piece)
            # pieces come longest first, so a character without a piece of its own, which may
            # be unknown inside a longer one, is known as such when the next position begins
        close(size)
        path: list[int] = []
        at = size
        while at:
            start, piece = come[at]
            if piece == self.unknown and self.bytes:
                path.extend(self.bytes[b] for b in reversed(text[start:at].encode()))
            elif not (piece == self.unknown and path and path[-1] == self.unknown):
                path.append(piece)
            at = start
        path.reverse()
        return path

    def encode(self, text: str) -> list[int]:
        text = self.normalized(text)
        if self._words is None:
            return self.best_path(text)
        out: list[int] = []
        cache = self._cache
        for word in self._words.findall(text):
            ids = cache.get(word)
            if ids is None:
                ids = tuple(self.best_path(word))
                if len(word) <= 64:
                    if len(cache) >= _CACHE:
                        cache.clear()
                    cache[word] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ids; control and unknown pieces have none, broken bytes are replaced."""
        known, hidden, texts = self._from_byte, self._hidden, self._text
        data = b"".join(known.get(i) or texts[i] for i in ids if i not in hidden)
        text = data.decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def _encode_batch(batch: pa.RecordBatch, path: str) -> Iterator[pa.RecordBatch]:
    model = codec(path)
    for at in range(0, batch.num_rows, 512):
        some = batch.slice(at, 512)
        ids = [model.encode(text or "") for text in some.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [some.column(0), pa.array(ids, pa.list_(pa.int32()))], ["id", "ids"]
        )


def encode(
    documents: DataFrame, path: str, *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(id, ids) of every row; a null or empty text has no ids. Rows stay apart whatever
    their ids. `path` is a model file that the executors can read."""
    rows = documents.select(
        F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text_column}`").alias("text")
    )
    return map_batches(rows, partial(_encode_batch, path=path), "id long, ids array<int>")


def _decode_batch(batch: pa.RecordBatch, path: str) -> Iterator[pa.RecordBatch]:
    model = codec(path)
    texts = [None if x is None else model.decode(x) for x in batch.column(1).to_pylist()]
    yield pa.RecordBatch.from_arrays(
        [batch.column(0), pa.array(texts, pa.string())], ["id", "text"]
    )


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(id, text) of every row of (id, ids); null ids give a null text."""
    return map_batches(
        encoded.select("id", "ids"), partial(_decode_batch, path=path), "id long, text string"
    )


def _digest_batch(batch: pa.RecordBatch, path: str) -> Iterator[pa.RecordBatch]:
    model = codec(path)
    rows = []
    for id_, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
        text = text or ""
        ids = model.encode(text)
        rows.append((id_, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()),
                     model.decode(ids) == text))
    columns = zip(*rows, strict=True)
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_())
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
        ["id", "n_ids", "ids_crc32", "round_trip"],
    )


def digests(
    documents: DataFrame, path: str, *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(id, n_ids, ids_crc32, round_trip): a row's ids in short, and whether decoding them
    gives its text again. A null text counts as empty."""
    rows = documents.select(
        F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text_column}`").alias("text")
    )
    return map_batches(
        rows, partial(_digest_batch, path=path),
        "id long, n_ids long, ids_crc32 long, round_trip boolean",
    )
