"""Alignment of two tokenizers' tokens by divide and conquer at shared cuts (11).

Both tokenizers' tokens tile the same bytes. A byte offset where a token of each ends is a cut
for both. An interval between cuts is divided at the common end nearest to the middle of its A
tokens, which bisecting B's ends finds; both halves go the same way, and an interval without an
inner common end is a leaf: a group of tokens of each that belong together. All intervals of one
depth are divided at the same time, over all documents of a batch.

Every two tokens of a group whose bytes overlap are a link. How often the corpus links two ids
is a sum over all documents, which each document then reads for its own links. For this, tasks
cut their documents into blocks of bounded tokens, number a block's id pairs, and keep
documents' links as these numbers. Only a block's dictionary of pairs is joined to the counts,
so a frequent pair costs a row for each block, not for each link.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslake.llm.packing import byte_letters, encoders
from saleslake.plans.staging import stored
from saleslake.session import ship_package

#: Tokens of A after which a block is closed; a longer document is a block of its own.
BLOCK_TOKENS = 1 << 20
#: Documents aligned at a time, and bytes after which fewer are.
_AT_ONCE = 256
_BYTES = 1 << 21
_SPACE = "▁".encode()


class Pieces(NamedTuple):
    """A vocabulary: each id's bytes and their number, and its number as text, first as one that
    others of its side follow in a group and then, one vocabulary further, as the last."""

    raw: list[bytes]
    sizes: np.ndarray
    names: np.ndarray


def _pieces(raw: list[bytes], last: str) -> Pieces:
    names = [f"{at}{sign}" for sign in (",", last) for at in range(len(raw))]
    return Pieces(raw, np.array([len(x) for x in raw], dtype=np.int64), np.array(names, dtype=object))


@lru_cache(maxsize=2)
def _first(path: str):
    """A byte-level tokenizer file: a function from a text to ids, one from ids to bytes, and
    the vocabulary.

    Special tokens' strings are encoded like any other.
    """
    slow, fast = encoders(path)
    letters = byte_letters()
    raw = [b""] * slow.get_vocab_size()
    for piece, at in slow.get_vocab(with_added_tokens=False).items():
        raw[at] = bytes(letters[c] for c in piece if c in letters)
    pieces = _pieces(raw, "|")
    if fast is not None:
        # it knows no special token, so none is allowed or refused
        return partial(fast.encode_to_numpy, disallowed_special=()), fast.decode_bytes, pieces
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    return (
        lambda text: np.array(plain.encode(text, add_special_tokens=False).ids, dtype=np.int64),
        lambda ids: b"".join(map(raw.__getitem__, ids)),
        pieces,
    )


@lru_cache(maxsize=2)
def _second(path: str):
    """The piece tokenizer of a file and its vocabulary."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    raw = [
        bytes([int(piece[3:5], 16)]) if model.is_byte(at)
        else b"" if model.is_control(at) or model.is_unknown(at)
        else piece.encode().replace(_SPACE, b" ")
        for at, piece in enumerate(model.id_to_piece(list(range(model.get_piece_size()))))
    ]
    return model, _pieces(raw, ";")


def shared_cuts(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places in `a` of the ends that `b` has too; both rise and have the same last end.

    An interval [low, high) of A's tokens has its inner ends at low ... high - 2. Ends at a
    doubling distance from the middle are bisected for until one is common or none is left.
    """
    found = [np.array([len(a) - 1])]
    low, high = np.array([0]), np.array([len(a)])

    def common(at: np.ndarray) -> np.ndarray:
        # the last end of both is the largest, so every place is one of `b`
        return b[np.searchsorted(b, a[at])] == a[at]

    while len(low):
        inner = high - low > 1
        low, high = low[inner], high[inner]
        middle = (low + high - 2) // 2
        cut = np.where(common(middle), middle, -1)
        open_ = np.flatnonzero((cut < 0) & (high - low > 2))
        near, far = 1, 3
        while len(open_):
            # ends at a distance of near ... far - 1 on either side of the middle
            center = middle[open_]
            left = np.maximum(center - far + 1, low[open_])
            right = np.minimum(center + far, high[open_] - 1)
            count = right - left
            row = np.repeat(np.arange(len(open_)), count)
            at = np.arange(len(row)) - np.repeat(np.cumsum(count) - count - left, count)
            away = np.abs(at - center[row])
            new = np.flatnonzero(away >= near)
            new = new[common(at[new])]
            row, at, away = row[new], at[new], away[new]
            order = np.lexsort((away, row))
            first = order[np.flatnonzero(np.diff(row[order], prepend=-1))]
            cut[open_[row[first]]] = at[first]
            near, far = far, 4 * far
            done = (cut[open_] >= 0) | ((left <= low[open_]) & (right >= high[open_] - 1))
            open_ = open_[~done]
        split = cut >= 0
        low, high, cut = low[split], high[split], cut[split]
        found.append(cut)
        low, high = np.concatenate([low, cut + 1]), np.concatenate([cut + 1, high])
    return np.sort(np.concatenate(found))


class Aligned(NamedTuple):
    """Tokens of some documents in a row, their groups and links.

    `group_a` and `group_b` hold each token's group, `link_a` and `link_b` the places of the two
    tokens of each link, in order.
    """

    group_a: np.ndarray
    group_b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> Aligned:
    """Groups and links of tokens that end at these byte offsets and tile the same bytes."""
    cut_a = np.zeros(len(ends_a), dtype=bool)
    cut_a[shared_cuts(ends_a, ends_b)] = True
    ends = np.zeros(int(ends_a[-1]) + 1, dtype=np.uint8)
    ends[ends_a] = 1
    ends[ends_b] |= 2
    ends[ends_a[cut_a]] |= 4
    cut_b = ends[ends_b] >= 4
    # a part between neighbouring ends lies in one token of each: a link
    parts = ends[np.flatnonzero(ends)]

    def before(flags: np.ndarray) -> np.ndarray:
        return np.cumsum(flags) - flags

    return Aligned(before(cut_a), before(cut_b), before(parts & 1), before(parts >> 1 & 1))


def _spelled(
    a: np.ndarray, b: np.ndarray, aligned: Aligned, names_a: np.ndarray, names_b: np.ndarray
) -> np.ndarray:
    """The tokens' numbers with the sign that follows each, group by group, A's before B's."""
    group_a, group_b = aligned.group_a, aligned.group_b
    size = int(group_a[-1]) + 1
    held_a, held_b = np.bincount(group_a, minlength=size), np.bincount(group_b, minlength=size)
    out = np.empty(len(a) + len(b), dtype=object)
    place_a = np.arange(len(a)) + (np.cumsum(held_b) - held_b)[group_a]
    place_b = np.arange(len(b)) + np.cumsum(held_a)[group_b]
    last_a = np.diff(group_a, append=size) != 0
    last_b = np.diff(group_b, append=size) != 0
    out[place_a] = names_a[a + last_a * (len(names_a) // 2)]
    out[place_b] = names_b[b + last_b * (len(names_b) // 2)]
    return out


def _tokens(texts: list[str | None], first: str, second: str):
    """Ids of both tokenizers for the texts whose tokens' bytes are the text after a blank."""
    encode, decode, _ = _first(first)
    model, pieces_b = _second(second)
    given = [text or "" for text in texts]
    some = [at for at, text in enumerate(given) if text]
    ids_b = model.encode([given[at] for at in some], num_threads=1)
    for at, b in zip(some, ids_b, strict=True):
        text = " " + given[at]
        raw = text.encode()
        a = encode(text)
        if decode(a) == raw and b"".join(map(pieces_b.raw.__getitem__, b)) == raw:
            yield at, a.astype(np.int64), np.array(b, dtype=np.int64)


_FIELDS = (
    "kind int, block long, doc_id long, n_a long, n_b long, n_groups long, n_links long,"
    " groups_sha256 string, pairs array<long>, counts array<int>"
)


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in values])])
    flat = np.concatenate([np.zeros(0, np.int64), *values])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat).cast(kind))


def _align_some(
    ids: list, texts: list[str | None], first: str, second: str
) -> Iterator[tuple]:
    """(id, n_a, n_b, n_groups, n_links, digest, link pairs) of each text."""
    pieces_a, pieces_b = _first(first)[-1], _second(second)[-1]
    known = list(_tokens(texts, first, second))
    empty = set(range(len(texts))) - {at for at, _, _ in known}
    for at in sorted(empty):
        yield ids[at], 0, 0, 0, 0, "", np.zeros(0, np.int64)
    if not known:
        return
    a = np.concatenate([x for _, x, _ in known])
    b = np.concatenate([x for _, _, x in known])
    # one row of bytes for all documents, whose ends are cuts themselves
    ends_a, ends_b = np.cumsum(pieces_a.sizes[a]), np.cumsum(pieces_b.sizes[b])
    aligned = align(ends_a, ends_b)
    words = _spelled(a, b, aligned, pieces_a.names, pieces_b.names)
    pairs = (a[aligned.link_a] << 32) | b[aligned.link_b]
    stop_a = np.cumsum([len(x) for _, x, _ in known])
    stop_group = aligned.group_a[stop_a - 1] + 1
    stop_word = stop_a + np.cumsum([len(y) for _, _, y in known])
    stop_link = np.searchsorted(aligned.link_a, stop_a)
    group, word, link = 0, 0, 0
    for (at, x, y), g, w, n in zip(known, stop_group, stop_word, stop_link, strict=True):
        spelled = "".join(words[word:w].tolist())[:-1]
        yield (
            ids[at], len(x), len(y), int(g - group), int(n - link),
            hashlib.sha256(spelled.encode()).hexdigest(), pairs[link:n],
        )
        group, word, link = g, w, n


class _Block:
    """Documents of a task until their tokens are enough."""

    def __init__(self, name: int):
        self.name, self.rows, self.tokens = name, [], 0

    def add(self, row: tuple) -> None:
        self.rows.append(row)
        self.tokens += row[1]

    def batches(self) -> Iterator[pa.RecordBatch]:
        """A row with the pairs and their counts, and one for each document with its links as
        places in that dictionary, each place once with its number."""
        every = [row[6] for row in self.rows]
        dictionary, place = np.unique(np.concatenate(every), return_inverse=True)
        counts = np.bincount(place, minlength=len(dictionary))
        own, times = [], []
        at = 0
        for pairs in every:
            some, number = np.unique(place[at : at + len(pairs)], return_counts=True)
            own.append(some)
            times.append(number)
            at += len(pairs)
        yield self._batch(1, [(None, 0, 0, 0, 0, "")], [dictionary], [counts])
        for start in range(0, len(self.rows), 1000):
            part = slice(start, start + 1000)
            yield self._batch(0, [row[:6] for row in self.rows[part]], own[part], times[part])

    def _batch(self, kind: int, rows: list, pairs: list, counts: list) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array([kind] * len(rows), pa.int32()), pa.array([self.name] * len(rows), pa.int64()),
             *(pa.array(c, pa.int64()) for c in columns[:5]), pa.array(columns[5], pa.string()),
             _lists(pairs, pa.int64()), _lists(counts, pa.int32())],
            ["kind", "block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256",
             "pairs", "counts"],
        )


def _slices(sizes: np.ndarray) -> Iterator[slice]:
    """Rows to align at a time: not too many, and not too many bytes unless it is one row."""
    start, total = 0, 0
    for at, size in enumerate(sizes.tolist()):
        if at > start and (at - start >= _AT_ONCE or total + size > _BYTES):
            yield slice(start, at)
            start, total = at, 0
        total += size
    if len(sizes) > start:
        yield slice(start, len(sizes))


def _align_task(
    batches: Iterator[pa.RecordBatch], first: str, second: str, block_tokens: int
) -> Iterator[pa.RecordBatch]:
    """Documents and dictionaries, block by block."""
    part = TaskContext.get().partitionId()
    block = _Block(part << 32)
    for batch in batches:
        texts = batch.column(1).to_pylist()
        sizes = np.array([len(text or "") for text in texts], dtype=np.int64)
        for some in _slices(sizes):
            ids = batch.column(0).slice(some.start, some.stop - some.start).to_pylist()
            for row in _align_some(ids, texts[some], first, second):
                block.add(row)
                if block.tokens >= block_tokens:
                    yield from block.batches()
                    block = _Block(block.name + 1)
    if block.rows:
        yield from block.batches()


def _sum_links(key: tuple, docs: pa.Table, known: pa.Table) -> pa.Table:
    """Counts of each document's links, from the block's own dictionary."""
    order = np.argsort(known.column("place").to_numpy())
    counts = known.column("count").to_numpy()[order]
    best = known.column("best").to_numpy()[order]
    docs = docs.combine_chunks()
    pairs = docs.column("pairs").combine_chunks()
    times = docs.column("counts").combine_chunks()
    if isinstance(pairs, pa.ChunkedArray):
        pairs, times = pairs.chunk(0), times.chunk(0)
    sizes = np.diff(pairs.offsets.to_numpy())
    place, number = (x.flatten().to_numpy(zero_copy_only=False) for x in (pairs, times))
    number = number.astype(np.int64)
    ends = np.cumsum(sizes)
    sums = [
        np.concatenate([[0], np.cumsum(x)])[[*(ends - sizes), *ends]].reshape(2, -1)
        for x in (number * best[place], number * counts[place])
    ]
    return pa.table({
        **{c: docs.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")},
        "n_best": sums[0][1] - sums[0][0],
        "count_sum": sums[1][1] - sums[1][0],
        "groups_sha256": docs.column("groups_sha256"),
    })


def align_tokens(
    documents: DataFrame, first: str, second: str, *, id_column: str = "doc_id",
    text_column: str = "text", block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """Groups and links of each document's tokens under two tokenizers.

    `first` names a byte-level tokenizer file, which encodes a blank and the text, `second` a
    piece model, which adds the blank itself; special tokens' strings are plain text. A text
    that is null or empty, or whose tokens' bytes under either are not the blank and the text, has
    no tokens: its numbers are 0 and its digest is ''. Texts of any length are taken whole. Rows
    that share an id, or have none, are documents of their own. Columns: doc_id, n_a, n_b,
    n_groups, n_links, n_best, count_sum, groups_sha256, as the module says.
    """
    ship_package(documents.sparkSession)
    texts = documents.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        F.col(f"`{text_column}`").alias("text"),
    )
    found = stored(
        texts.mapInArrow(
            partial(_align_task, first=first, second=second, block_tokens=block_tokens), _FIELDS
        ),
        "align-blocks",
    )
    entries = found.filter("kind = 1").select(
        "block", F.posexplode(F.arrays_zip("pairs", "counts")).alias("place", "entry")
    ).select("block", "place", F.col("entry.pairs").alias("pair"), F.col("entry.counts").alias("n"))
    totals = stored(entries.groupBy("pair").agg(F.sum("n").alias("count")), "align-counts")
    second_id = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    highest = totals.groupBy(second_id.alias("b")).agg(F.max("count").alias("highest"))
    counted = totals.withColumn("b", second_id).join(highest, "b").select(
        "pair", "count", (F.col("count") == F.col("highest")).alias("best")
    )
    known = entries.select("block", "place", "pair").join(counted, "pair").select(
        F.col("block").alias("of"), "place", "count", "best"
    )
    docs = found.filter("kind = 0").drop("kind")
    return docs.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(
        _sum_links,
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long,"
        " count_sum long, groups_sha256 string",
    )
