"""Exact top-k by inner product with a three-phase threshold (7).

Rows lie in blocks, each a list of local scores. A score is split into a head, over the
first half of the components, and a tail whose size the vectors' lengths bound.

1. Gather local lists: for each query every block sends its k best rows by head, with
   their whole scores. The k-th best of all is a safe cutoff: at least k rows reach it.
2. The cutoffs go to all blocks. A block keeps the rows whose head plus the bound of the
   tail reaches the cutoff of the query; the true result and all its ties are among them.
3. The tails of those rows are computed where they lie. Those whose whole score reaches
   the cutoff are sent, and the k best of all blocks are taken, ties to the smaller id.

Blocks of rows meet blocks of queries by an equal part number; the query blocks are copied
to every part. Neither side is collected: Spark takes the copies for as small as one of them,
so the join is told to shuffle, or all copies would be broadcast through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleslake.llm.common import map_batches
from saleslake.plans.staging import stored

ROWS_PER_BLOCK = 2048
_EXACT = 2.0**53
_LONG = 2**63


def quantized(column: Column) -> Column:
    """floor(256 * x) of every component, as whole doubles; null if a component is not finite."""
    wide = F.transform(column, lambda x: x.cast("double"))
    finite = F.forall(
        wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    # arithmetic on doubles, as Spark's own floor gives a long, which large values overflow
    return F.when(finite, F.transform(wide, lambda x: x * 256.0))


def _pack(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Blocks of vectors of one length: ids, cutoffs and the matrix of whole numbers."""
    lists = batch.column("vector")
    lengths = np.asarray(lists.value_lengths())
    values = np.floor(np.asarray(lists.flatten(), dtype=np.float64))
    ends = np.cumsum(lengths)
    ids = batch.column("id").to_numpy(zero_copy_only=False)
    cuts = batch.column("cutoff").to_numpy(zero_copy_only=False)
    for width in np.unique(lengths):
        rows = np.flatnonzero(lengths == width)
        for at in range(0, len(rows), ROWS_PER_BLOCK):
            some = rows[at : at + ROWS_PER_BLOCK]
            matrix = values[(ends[some] - width)[:, None] + np.arange(width)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(width)], pa.int32()),
                 pa.array([int(ids[some[0]])], pa.int64()),
                 pa.array([ids[some].astype(np.int64).tobytes()], pa.binary()),
                 pa.array([cuts[some].astype(np.float64).tobytes()], pa.binary()),
                 pa.array([matrix.tobytes()], pa.binary())],
                ["width", "block", "ids", "cuts", "matrix"],
            )


_BLOCK = "width int, block long, ids binary, cuts binary, matrix binary"


def _whole_scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of two matrices' rows, pair by pair; beyond a long, its limit."""
    if not left.size:
        return np.zeros(len(left), dtype=np.int64)
    if left.shape[1] * np.abs(left).max() * np.abs(right).max() < _EXACT:
        return np.einsum("ij,ij->i", left, right).astype(np.int64)
    out = [
        sum(int(x) * int(y) for x, y in zip(a, b, strict=True))
        for a, b in zip(left.tolist(), right.tolist(), strict=True)
    ]
    return np.array([min(max(x, -_LONG), _LONG - 1) for x in out], dtype=np.int64)


def _meet(batch: pa.RecordBatch, k: int, first: bool) -> Iterator[pa.RecordBatch]:
    """Entries (query, id, score) of pairs of blocks: local lists, or what reaches the cutoffs."""
    for place in range(batch.num_rows):
        # a batch holds many pairs of blocks, which are not all wanted as Python's own at once
        row = batch.slice(place, 1).to_pylist()[0]
        width = row["width"]
        half = width // 2
        ids, asked = (np.frombuffer(row[c], np.int64) for c in ("ids", "asked"))
        rows = np.frombuffer(row["matrix"]).reshape(len(ids), width)
        queries = np.frombuffer(row["query_matrix"]).reshape(len(asked), width)
        with np.errstate(over="ignore", invalid="ignore"):
            head = queries[:, :half] @ rows[:, :half].T
        own = asked[:, None] == ids
        if first:
            head = np.where(own, -np.inf, np.nan_to_num(head))
            take = min(k, len(ids))
            best = np.argpartition(-head, take - 1, axis=1)[:, :take]
            at = np.repeat(np.arange(len(asked)), take)
            to = best.ravel()
            keep = ~own[at, to]
        else:
            tails = [np.linalg.norm(m[:, half:], axis=1) for m in (queries, rows)]
            # the slack covers the rounding of heads and lengths
            sizes = [np.linalg.norm(m, axis=1) for m in (queries, rows)]
            bound = head + np.outer(*tails) + 1e-9 * np.outer(*sizes) + 1
            # a cutoff may have been rounded up to a double
            cuts = np.nextafter(np.frombuffer(row["asked_cuts"]), -np.inf)
            at, to = np.nonzero((~own) & ~(bound < cuts[:, None]))
            keep = slice(None)
        at, to = at[keep], to[keep]
        for some in range(0, len(at), 65536):
            a, b = at[some : some + 65536], to[some : some + 65536]
            scores = _whole_scores(queries[a], rows[b])
            if not first:
                enough = ~(scores < cuts[a])
                a, b, scores = a[enough], b[enough], scores[enough]
            yield pa.RecordBatch.from_arrays(
                [pa.array(asked[a]), pa.array(ids[b]), pa.array(scores)],
                ["query_id", "vec_id", "score"],
            )


_ENTRY = "query_id long, vec_id long, score long"


def _entries(rows: DataFrame, queries: DataFrame, parts: int, k: int, first: bool) -> DataFrame:
    asked = queries.select(
        "width", F.col("ids").alias("asked"), F.col("cuts").alias("asked_cuts"),
        F.col("matrix").alias("query_matrix"),
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
    )
    placed = rows.select("width", "ids", "matrix", F.pmod(F.xxhash64("block"), F.lit(parts))
                         .cast("int").alias("part"))
    met = placed.join(asked.hint("merge"), ["part", "width"])
    return map_batches(met, partial(_meet, k=k, first=first), _ENTRY)


def _best(entries: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return entries.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(
    vectors: DataFrame, k: int = 5, *, every: int = 50,
    id_column: str = "vec_id", vector_column: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of every query.

    Queries are the rows whose id is divisible by `every`, candidates all rows with another
    id and a vector of the same length. Rows with a null id, a null vector or a component
    that is null or not finite take no part. A row that is repeated with the same id and
    vector counts once; rows that share an id but not a vector are candidates of their own.
    Scores beyond the range of a long take its limit.
    """
    spark = vectors.sparkSession
    whole = vectors.select(
        F.col(f"`{id_column}`").cast("long").alias("id"),
        quantized(F.col(f"`{vector_column}`")).alias("vector"),
        F.lit(float("-inf")).alias("cutoff"),
    ).filter("id IS NOT NULL AND vector IS NOT NULL").dropDuplicates(["id", "vector"])
    rows = stored(map_batches(whole, _pack, _BLOCK), "topk-rows")
    asked = stored(whole.filter(F.col("id") % every == 0), "topk-queries")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    local = _entries(rows, map_batches(asked, _pack, _BLOCK), parts, k, True)
    cutoffs = (
        _best(local.distinct(), k).groupBy("query_id")
        .agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("found"))
        .filter(F.col("found") == k)
        .select(F.col("query_id").alias("id"), "least")
    )
    bounded = asked.join(stored(cutoffs, "topk-cutoffs"), "id", "left").select(
        "id", "vector", F.coalesce(F.col("least").cast("double"), "cutoff").alias("cutoff")
    )
    sufficient = _entries(rows, map_batches(bounded, _pack, _BLOCK), parts, k, False)
    return _best(sufficient.distinct(), k).select("query_id", "rank", "vec_id", "score")
