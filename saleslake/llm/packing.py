"""Packing token sequences into windows by non-negative least squares (5).

Each document's full windows stand alone; what remains is shorter than a window. The
histogram of these remainders, one count for each length, is all the planning needs, and
its size is bounded by the window. Combinations of two or three lengths that fill a window
exactly are its columns; least squares with non-negative repeat counts fits them to the
histogram, the counts are rounded down, and the remainders that no combination takes are
packed greedily one after another, cut where a window ends. Only the last window of the
whole corpus is padded.

A document finds its place by arithmetic: its rank among the remainders of its length tells
which repetition of which combination it fills. Ranks come from counts by task and length,
so no length's documents ever meet in one task.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saleslake.llm.common import map_batches
from saleslake.plans.staging import stored
from saleslake.session import ship_package

WINDOW = 2048
END = 1
_SPECIAL = "<|endoftext|>"


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for.

    Printable bytes are themselves; the others follow from code point 256 on, in order.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@lru_cache(maxsize=2)
def encoders(path: str):
    """The tokenizer of a file, and a faster encoder of the same vocabulary if it is one.

    A byte-level vocabulary whose ids follow its merges is a ranking by id, which `tiktoken`
    encodes with the same result several times faster; a text with the special token's
    string is left to the file's own tokenizer, which reads it as that token.
    """
    import tiktoken
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    letters = byte_letters()
    ranks = {
        bytes(letters[c] for c in piece): at
        for piece, at in model["vocab"].items() if piece != _SPECIAL
    }
    merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    in_order = all(model["vocab"][piece] == 256 + at for at, piece in enumerate(merges))
    if not in_order:
        return slow, None
    import public_tokenizers

    fast = tiktoken.Encoding(
        "file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    return slow, fast


def encode(text: str, path: str) -> np.ndarray:
    """Ids of a text, and the end id."""
    slow, fast = encoders(path)
    if fast is None or _SPECIAL in text:
        ids = slow.encode(text, add_special_tokens=False).ids
    else:
        ids = fast.encode_ordinary(text)
    return np.array([*ids, END], dtype="<u4")


def _tokenize(batches: Iterator[pa.RecordBatch], path: str, window: int):
    """Ids of each document, and its place among those of its task: by remainder, and by
    full windows."""
    part = TaskContext.get().partitionId()
    seen = np.zeros(window, dtype=np.int64)
    full = 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            some = batch.slice(at, 256)
            ids = [encode(t or "", path) for t in some.column(1).to_pylist()]
            ranks, starts, rests = [], [], []
            for one in ids:
                rest = len(one) % window
                rests.append(rest)
                ranks.append(seen[rest])
                starts.append(full)
                seen[rest] += 1
                full += len(one) // window
            yield pa.RecordBatch.from_arrays(
                [some.column(0), pa.array([part] * len(ids), pa.int32()),
                 pa.array(rests, pa.int32()), pa.array(ranks, pa.int64()),
                 pa.array(starts, pa.int64()),
                 pa.array([len(x) for x in ids], pa.int64()),
                 pa.array([x.astype("<u2").tobytes() if x.max() < 65536 else x.tobytes()
                           for x in ids], pa.binary())],
                ["doc_id", "part", "rest", "rank", "full_rank", "size", "ids"],
            )


@dataclass(frozen=True)
class Plan:
    """Where remainders go, by length and rank.

    For length `l`, the ranges `starts[l]` (ascending ranks) begin slots: a document of rank
    r in the range that starts at s takes repetition r - s of a combination, whose windows
    begin at `first` and where it lies at `offset`. Ranks from `rest[l]` on follow each other
    in a stream that begins at position `stream[l]` and is cut every window.
    """

    starts: list[np.ndarray]
    first: list[np.ndarray]
    offset: list[np.ndarray]
    rest: np.ndarray
    stream: np.ndarray
    windows: int


def combinations(histogram: np.ndarray, window: int) -> list[tuple[int, ...]]:
    """Pairs of present lengths that fill a window, and triples with one length twice or with
    the most frequent lengths."""
    present = np.flatnonzero(histogram)
    has = histogram > 0
    found = {(int(a), int(window - a)) for a in present if a <= window - a and has[window - a]}
    common = present[np.argsort(-histogram[present], kind="stable")][:16]
    for a in present:
        for b in {int(a), *map(int, common)}:
            c = window - int(a) - b
            if 0 < c < window and has[c]:
                found.add(tuple(sorted((int(a), b, c))))
    return sorted(found)


def repeat_counts(
    histogram: np.ndarray, columns: list[tuple[int, ...]], rounds: int = 400
) -> np.ndarray:
    """Whole repeat counts near the non-negative least squares solution, within the histogram.

    Minimises |A x - h|^2 for x >= 0 by projected gradient steps with Nesterov's momentum; A
    has a few entries a column, so a step costs as much as there are entries. The counts are
    rounded down and then held to what is there, largest first.
    """
    if not columns:
        return np.zeros(0, dtype=np.int64)
    rows = np.concatenate([np.array(c) for c in columns])
    cols = np.repeat(np.arange(len(columns)), [len(c) for c in columns])
    load = np.bincount(rows, minlength=len(histogram))
    step = 1.0 / max(1.0, 3.0 * load.max())  # |A|^2 is at most row sum times column sum
    x = np.zeros(len(columns))
    y, t = x.copy(), 1.0
    target = histogram.astype(float)
    for _ in range(rounds):
        gap = np.bincount(rows, weights=y[cols], minlength=len(histogram)) - target
        slope = np.bincount(cols, weights=gap[rows], minlength=len(columns))
        new = np.maximum(y - step * slope, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    left = histogram.copy()
    counts = np.zeros(len(columns), dtype=np.int64)
    for at in np.argsort(-x, kind="stable"):
        lengths, times = np.unique(columns[at], return_counts=True)
        counts[at] = max(0, min(int(x[at]), int((left[lengths] // times).min())))
        left[lengths] -= times * counts[at]
    return counts


def make_plan(histogram: np.ndarray, window: int = WINDOW) -> Plan:
    """The plan for a histogram of remainders (index: length; index 0 is not packed)."""
    histogram = histogram.copy()
    histogram[0] = 0
    columns = combinations(histogram, window)
    counts = repeat_counts(histogram, columns)
    starts: list[list[int]] = [[] for _ in range(window)]
    first: list[list[int]] = [[] for _ in range(window)]
    offset: list[list[int]] = [[] for _ in range(window)]
    used = np.zeros(window, dtype=np.int64)
    windows = 0
    for lengths, count in zip(columns, counts.tolist(), strict=True):
        if not count:
            continue
        at = 0
        for length in lengths:
            starts[length].append(int(used[length]))
            first[length].append(windows)
            offset[length].append(at)
            used[length] += count
            at += length
        windows += count
    stream = np.zeros(window, dtype=np.int64)
    position = windows * window
    for length in range(window - 1, 0, -1):
        stream[length] = position
        position += length * int(histogram[length] - used[length])
    last = -(-position // window)
    as_arrays = [[np.array(x, dtype=np.int64) for x in y] for y in (starts, first, offset)]
    return Plan(*as_arrays, used, stream, last)


def place(plan: Plan, rest: int, rank: int, window: int) -> Iterator[tuple[int, int, int]]:
    """(length, sequence, offset) of the pieces of a remainder."""
    if rank < plan.rest[rest]:
        at = int(np.searchsorted(plan.starts[rest], rank, side="right")) - 1
        first = int(plan.first[rest][at]) + rank - int(plan.starts[rest][at])
        yield rest, first, int(plan.offset[rest][at])
        return
    position = int(plan.stream[rest]) + (rank - int(plan.rest[rest])) * rest
    while rest:
        length = min(rest, window - position % window)
        yield length, position // window, position % window
        position += length
        rest -= length


def _pieces(batch: pa.RecordBatch, plan: Plan, window: int) -> Iterator[pa.RecordBatch]:
    rows = []
    for doc, rest, rank, full, size, raw in zip(
        *(batch.column(c).to_pylist() for c in ("doc_id", "rest", "rank", "full", "size", "ids")),
        strict=True,
    ):
        ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * size else "<u4").astype("<u4")
        start = 0
        wholes = ((window, plan.windows + full + k, 0) for k in range(size // window))
        tail = place(plan, rest, rank, window) if rest else ()
        for length, sequence, offset in (*wholes, *tail):
            crc = zlib.crc32(ids[start : start + length].tobytes())
            rows.append((doc, start, length, crc, size, sequence, offset))
            start += length
    columns = zip(*rows, strict=True)
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in columns],
        ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    )


def pack(
    documents: DataFrame, tokenizer: str, *, window: int = WINDOW,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """One row for each piece of every document's tokens.

    (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset): the piece's place in
    the document and in its sequence, and the checksum of its ids as little-endian unsigned
    32-bit numbers. A null or empty text is its end id alone. Repeated and null ids are
    documents of their own. Sequences are gapless and full but for the very last one.
    `tokenizer` is a file that the executors can read.
    """
    rows = documents.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        F.col(f"`{text_column}`").alias("text"),
    )
    ship_package(documents.sparkSession)
    tokens = stored(
        rows.mapInArrow(
            partial(_tokenize, path=tokenizer, window=window),
            "doc_id long, part int, rest int, rank long, full_rank long, size long, ids binary",
        ),
        "packing-tokens",
    )
    # The key -1 counts full windows, so that both kinds of ranks get their task's offset.
    by_task = tokens.groupBy("part", "rest").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.floor(F.col("size") / window)).alias("windows")
    )
    counts = by_task.select("part", "rest", "n").unionByName(
        by_task.groupBy("part").agg(F.sum("windows").alias("n"))
        .select("part", F.lit(-1).alias("rest"), "n")
    )
    counts = stored(counts, "packing-counts")
    histogram = np.zeros(window, dtype=np.int64)
    for rest, n in counts.filter("rest >= 0").groupBy("rest").agg(F.sum("n")).collect():
        histogram[rest] = n
    before = Window.partitionBy("rest").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = counts.select(
        "part", "rest", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    by_part = stored(
        offsets.groupBy("part").agg(
            F.map_from_entries(F.collect_list(F.struct("rest", "before"))).alias("before")
        ),
        "packing-offsets",
    )
    placed = tokens.join(by_part, "part").select(
        "doc_id", "rest", "size", "ids",
        (F.col("rank") + F.col("before")[F.col("rest")]).alias("rank"),
        (F.col("full_rank") + F.col("before")[F.lit(-1)]).alias("full"),
    )
    return map_batches(
        placed, partial(_pieces, plan=make_plan(histogram, window), window=window),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long,"
        " sequence_id long, offset long",
    )
