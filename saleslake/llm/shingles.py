"""Hashed word shingles of many texts at once.

Words are maximal runs of anything but ASCII white space, with A-Z lower-cased. All
hashing is vectorised over the bytes of a block of texts: a word's hash is a polynomial
over its bytes modulo 2**64 from a prefix sum, a shingle's hash mixes its words' hashes.
The 64-bit values stand for the shingles; two different ones of a pair of texts with
10,000 shingles each collide with a probability of about 1e-11.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

_BLOCK = 1 << 20
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 3
_INVERSE = pow(_BASE, -1, 1 << 64)

_random = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _random.integers(1 << 63, size=256, dtype=np.uint64) * _U(2) + _U(1)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BYTE[_BLANK] = 0
_WEIGHTS = _random.integers(1 << 63, size=64, dtype=np.uint64) * _U(2) + _U(1)


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, _U(base))
    out[0] = _U(1)
    return np.multiply.accumulate(out)


_UP: np.ndarray = _powers(_BASE, 1)
_DOWN: np.ndarray = _powers(_INVERSE, 1)


def _tables(count: int) -> tuple[np.ndarray, np.ndarray]:
    global _UP, _DOWN
    if len(_UP) < count:
        _UP, _DOWN = _powers(_BASE, count), _powers(_INVERSE, count)
    return _UP, _DOWN


def mix(values: np.ndarray, seed: int) -> np.ndarray:
    """A bijective scrambling of 64-bit values; each seed gives another order."""
    x = values + _U((0x9E3779B97F4A7C15 * (seed + 1)) % (1 << 64))
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _block_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a block of bytes, and where they start."""
    blank = _BLANK[data]
    edge = np.flatnonzero(np.diff(blank, prepend=True, append=True))
    starts, ends = edge[::2], edge[1::2]
    up, down = _tables(max(len(data), _BLOCK))
    total = np.empty(len(data) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum(_BYTE[data] * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts], 0), starts


def _pieces(text: bytes) -> Iterator[bytes]:
    """A long text cut before white space, about a block each."""
    at = 0
    while len(text) - at > _BLOCK:
        found = [x for x in (text.find(bytes([b]), at + _BLOCK) for b in (32, 10, 9, 11, 12, 13))
                 if x >= 0]
        if not found:
            break
        yield text[at : min(found)]
        at = min(found)
    yield text[at:]


def _blocks(texts: Iterable[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word hashes of some texts in a row, and each one's number of words."""
    waiting: list[bytes] = []
    size = 0

    def block() -> tuple[np.ndarray, np.ndarray]:
        hashes, starts = _block_words(np.frombuffer(b" ".join(waiting), dtype=np.uint8))
        ends = np.cumsum([len(text) + 1 for text in waiting])
        return hashes, np.diff(np.searchsorted(starts, ends), prepend=0)

    for text in texts:
        text = text or b""
        if waiting and size + len(text) > _BLOCK:
            yield block()
            waiting, size = [], 0
        if len(text) > _BLOCK:
            parts = [_block_words(np.frombuffer(p, dtype=np.uint8))[0] for p in _pieces(text)]
            hashes = np.concatenate(parts)
            yield hashes, np.array([len(hashes)])
        else:
            waiting.append(text)
            size += len(text) + 1
    if waiting:
        yield block()


def word_hashes(texts: Iterable[bytes | None]) -> list[np.ndarray]:
    """Word hashes of each text, in order; empty for None."""
    out: list[np.ndarray] = []
    for hashes, counts in _blocks(texts):
        out.extend(np.split(hashes, np.cumsum(counts)[:-1]))
    return out


def _rolled(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every `width` words in a row."""
    count = len(hashes) - width + 1
    total = hashes[:count] * _WEIGHTS[0]
    for k in range(1, width):
        total += hashes[k : k + count] * _WEIGHTS[k]
    return mix(total, width)


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    keep = np.empty(len(values), dtype=bool)
    keep[:1] = True
    np.not_equal(values[1:], values[:-1], out=keep[1:])
    return values[keep]


def shingle_sets(texts: Iterable[bytes | None], words: int = 5) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text.

    A text with fewer words is one shingle, of its whole sequence; one without words has none.
    """
    for hashes, counts in _blocks(texts):
        rolled = _rolled(hashes, words) if len(hashes) >= words else hashes[:0]
        at = 0
        for count in counts.tolist():
            if count >= words:
                yield _distinct(rolled[at : at + count - words + 1])
            else:
                yield _rolled(hashes[at : at + count], count) if count else hashes[:0]
            at += count


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    return int(np.count_nonzero(both[1:] == both[:-1]))
