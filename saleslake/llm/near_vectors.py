"""Near duplicates among vectors by a subspace pigeonhole join (13).

Two unit vectors with a cosine of at least t are no further apart than sqrt(2 - 2 t), also
after a rotation. Cut the rotated coordinates into blocks: if every block's squared distance
were over its share of the budget, in proportion to its coordinates, the whole would be over
the budget. So each block is range-joined on a grid under its own share, and the union of the
blocks' candidates is verified with the whole vectors.

Many copies of one vector must not become all their pairs as rows, so what is joined are units:

1. Equal vectors of a label form a class, and take part once, with their number as weight.
2. Classes are gathered into units about hubs: the smallest class among those whose largest
   coordinates in some blocks are the same, where the cosine to it reaches the threshold. How
   units come out bears on the speed only.
3. A unit joins by the box that its members fill in each block, which for a single vector is a
   point. Boxes within the block's radius of each other make candidates, so no pair of members
   is missed.
4. Candidate units, and each unit with itself, are compared in chunks of bounded size by matrix
   products inside a task. A task returns the number of links of each class and one edge for
   each class to the smallest id that it reaches there, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslake.llm.common import lowest_reached, map_batches
from saleslake.llm.ngram_join import components
from saleslake.plans.staging import stored

BLOCK = 8
CHUNK = 512
_TABLES = 4
_SLACK = 1e-5


@lru_cache(maxsize=8)
def rotation(dim: int) -> np.ndarray:
    """An orthogonal matrix that spreads any direction over all coordinates."""
    normal = np.random.Generator(np.random.PCG64(dim)).standard_normal((dim, dim))
    q, r = np.linalg.qr(normal)
    return q * np.sign(np.diag(r))


def _blocks(dim: int) -> list[slice]:
    return [slice(at, min(at + BLOCK, dim)) for at in range(0, dim, BLOCK)]


def _unit_length(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; scaling by the largest part first avoids overflow."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, unit vectors) of a column of vectors, for each dimension in it."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.values.slice(column.offsets[0].as_py(), int(sizes.sum()))
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    for dim in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == dim)
        yield at, _unit_length(values[starts[at][:, None] + np.arange(dim)])


def _signatures(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """For each class, where the largest coordinates of its blocks lie, block by block, with
    another block or two left out in each table."""
    for at, unit in _matrix(batch.column("vec")):
        turned = unit @ rotation(unit.shape[1])
        blocks = _blocks(unit.shape[1])
        tops = np.stack([
            np.abs(turned[:, b]).argmax(axis=1) * 2
            + (turned[np.arange(len(at)), b.start + np.abs(turned[:, b]).argmax(axis=1)] > 0)
            for b in blocks
        ])
        for table in range(_TABLES if len(blocks) > 2 else 1):
            chosen = [k for k in range(len(blocks)) if len(blocks) < 3 or k % _TABLES != table]
            mixed = np.full(len(at), unit.shape[1], dtype=np.uint64)
            for k in chosen:
                mixed = (mixed ^ tops[k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                mixed ^= mixed >> np.uint64(29)
            yield pa.RecordBatch.from_arrays(
                [batch.column("cid").take(pa.array(at)), batch.column("label").take(pa.array(at)),
                 pa.array(np.full(len(at), table, np.int32)), pa.array(mixed.view(np.int64))],
                ["cid", "label", "which", "signature"],
            )


def _reaches(a: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    """Which rows of `a` and `b` have at least a cosine; sums on the limit are made exactly."""
    scores = a @ b.T
    held = scores >= least
    for i, j in zip(*np.nonzero(np.abs(scores - least) < 1e-12), strict=True):
        x, y = a[i], b[j]
        size = math.sqrt(math.fsum(x * x)) * math.sqrt(math.fsum(y * y))
        held[i, j] = math.fsum(x * y) / size >= least
    return held


def _near_hub(batch: pa.RecordBatch, least: float) -> Iterator[pa.RecordBatch]:
    """Rows of a class and a hub whose cosine reaches the threshold."""
    held = np.zeros(batch.num_rows, dtype=bool)
    hubs = {}
    for at, unit in _matrix(batch.column("hub_vec")):
        place = np.full(batch.num_rows, -1)
        place[at] = np.arange(len(at))
        hubs[unit.shape[1]] = place, unit
    for at, unit in _matrix(batch.column("vec")):
        # signatures of different dimensions may be equal by chance
        place, others = hubs.get(unit.shape[1], (np.full(batch.num_rows, -1), unit))
        both = place[at] >= 0
        held[at[both]] = (unit[both] * others[place[at[both]]]).sum(axis=1) >= least
    keep = pa.array(held)
    yield pa.RecordBatch.from_arrays(
        [batch.column("cid").filter(keep), batch.column("hub").filter(keep)], ["cid", "hub"]
    )


def _units(classes: DataFrame, least: float) -> DataFrame:
    """(cid, unit) of every class: the smallest near hub of its own, and then that hub's."""
    signed = stored(
        map_batches(
            classes.select("cid", "label", "vec"), _signatures,
            "cid long, label string, which int, signature long",
        ),
        "vector-signatures",
    )
    keys = ["label", "which", "signature"]
    hubs = signed.groupBy(*keys).agg(F.min("cid").alias("hub"), F.max("cid").alias("last"))
    pairs = stored(
        signed.join(hubs.filter("hub <> last"), keys).filter("cid <> hub")
        .select("cid", "hub").distinct(),
        "vector-hubs",
    )
    vectors = classes.select("cid", "vec")
    both = pairs.join(vectors, "cid").join(
        vectors.select(F.col("cid").alias("hub"), F.col("vec").alias("hub_vec")), "hub"
    )
    first = stored(
        map_batches(
            both.select("cid", "hub", "vec", "hub_vec"), partial(_near_hub, least=least),
            "cid long, hub long",
        ).groupBy("cid").agg(F.min("hub").alias("hub")),
        "vector-first",
    )
    jump = first.select(F.col("cid").alias("hub"), F.col("hub").alias("root"))
    found = first.join(jump, "hub", "left").select("cid", F.coalesce("root", "hub").alias("unit"))
    return stored(
        classes.join(found, "cid", "left")
        .select("cid", "rep", "weight", "label", "vec", F.coalesce("unit", "cid").alias("unit")),
        "vector-units",
    )


def _boxes(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The box of each unit's members in the batch, in all rotated coordinates."""
    units = batch.column("unit").to_numpy()
    for at, vectors in _matrix(batch.column("vec")):
        order = at[np.argsort(units[at], kind="stable")]
        back = np.empty(batch.num_rows, dtype=np.int64)
        back[at] = np.arange(len(at))
        turned = (vectors @ rotation(vectors.shape[1]))[back[order]]
        starts = np.flatnonzero(np.diff(units[order], prepend=units[order][0] - 1))
        low = np.minimum.reduceat(turned, starts).astype(np.float32)
        high = np.maximum.reduceat(turned, starts).astype(np.float32)
        ends = pa.array(np.arange(len(starts) + 1, dtype=np.int32) * vectors.shape[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(units[order][starts]), batch.column("label").take(pa.array(order[starts])),
             pa.ListArray.from_arrays(ends, pa.array(low.ravel())),
             pa.ListArray.from_arrays(ends, pa.array(high.ravel()))],
            ["unit", "label", "low", "high"],
        )


def _cells(
    low: np.ndarray, high: np.ndarray, reach: float, width: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(box, cell, distance is zero) of the grid cells within reach of each box.

    A box asks only cells that are not before its own first one: of two boxes in reach of each
    other, the one whose near point lies in the earlier cell finds the other's.
    """
    rows = np.arange(len(low))
    left = np.full(len(low), reach * reach)
    cell = np.zeros(len(low), dtype=np.int64)
    own = np.zeros(len(low), dtype=np.int64)
    for k in range(low.shape[1]):
        first = np.floor((low[rows, k] - reach) / width).astype(np.int64)
        last = np.floor((high[rows, k] + reach) / width).astype(np.int64)
        count = last - first + 1
        at = np.repeat(np.arange(len(rows)), count)
        step = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
        here = first[at] + step
        rows, left, cell, own = rows[at], left[at], cell[at], own[at]
        gap = np.maximum(
            np.maximum(here * width - high[rows, k], low[rows, k] - (here + 1) * width), 0
        )
        left = left - gap * gap
        # 256 cells a coordinate, as a unit vector's lie between -1 and 1
        cell = cell * 256 + here + 128
        own = own * 256 + np.floor(low[rows, k] / width).astype(np.int64) + 128
        keep = left >= 0
        rows, left, cell, own = rows[keep], left[keep], cell[keep], own[keep]
    keep = cell >= own
    return rows[keep], cell[keep], (left == reach * reach)[keep]


def _grid(batch: pa.RecordBatch, least: float, fine: float) -> Iterator[pa.RecordBatch]:
    """Rows (unit, block, cell, home, corners): a unit lives in its home cells and asks all."""
    sizes = np.diff(batch.column("low").offsets.to_numpy())
    lows, highs = (
        batch.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        for c in ("low", "high")
    )
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    units = batch.column("unit").to_numpy()
    for dim in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == dim)
        spot = starts[at][:, None] + np.arange(dim)
        for k, block in enumerate(_blocks(dim)):
            low, high = lows[spot][:, block], highs[spot][:, block]
            reach = math.sqrt((2 - 2 * least) * low.shape[1] / dim) + _SLACK
            # 256 cells of a block's coordinate are enough for any width
            width = max(fine * 8 / math.sqrt(dim), 1.5 * reach, 1 / 100)
            rows, cell, inside = _cells(low, high, reach, width)
            names = ["unit", "label", "dim", "block", "reach", "cell", "home"]
            arrays = [
                pa.array(units[at[rows]]), batch.column("label").take(pa.array(at[rows])),
                pa.array(np.full(len(rows), dim, np.int32)),
                pa.array(np.full(len(rows), k, np.int32)),
                pa.array(np.full(len(rows), reach * reach)),
                pa.array(cell), pa.array(inside),
            ]
            for j in range(BLOCK):
                # coordinates that a short block lacks are alike
                for name, side in (("l", low), ("h", high)):
                    values = side[rows, j] if j < side.shape[1] else np.zeros(len(rows))
                    names.append(f"{name}{j}")
                    arrays.append(pa.array(values.astype(np.float32)))
            yield pa.RecordBatch.from_arrays(arrays, names)


def _candidates(units: DataFrame, sizes: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) of units, a < b, whose boxes are in reach of each other in some block."""
    parts = stored(
        map_batches(
            units.select("unit", "label", "vec"), _boxes,
            "unit long, label string, low array<float>, high array<float>",
        ),
        "vector-boxes",
    )
    several = sizes.filter("members > 1").select("unit")
    single = parts.join(several, "unit", "left_anti")
    merged = (
        parts.join(several, "unit")
        .select("unit", "label", F.posexplode(F.arrays_zip("low", "high")).alias("k", "side"))
        .groupBy("unit", "label", "k")
        .agg(F.min("side.low").alias("low"), F.max("side.high").alias("high"))
        .groupBy("unit", "label")
        .agg(F.sort_array(F.collect_list(F.struct("k", "low", "high"))).alias("sides"))
        .select("unit", "label", F.col("sides.low").alias("low"), F.col("sides.high").alias("high"))
    )
    # the more vectors a label has, the finer the grid; the candidates are the same
    most = sizes.groupBy("label").count().agg(F.max("count")).first()[0] or 1
    fine = min(1.0, (10_000 / most) ** (1 / BLOCK))
    grid = stored(
        map_batches(
            single.unionByName(merged), partial(_grid, least=least, fine=fine),
            "unit long, label string, dim int, block int, reach double, cell long, home boolean, "
            + ", ".join(f"l{j} float, h{j} float" for j in range(BLOCK)),
        ),
        "vector-grid",
    )
    keys = ["label", "dim", "block", "cell"]
    corners = [f"{side}{j}" for j in range(BLOCK) for side in "lh"]
    asking = grid.select(*keys, "reach", F.col("unit").alias("a"), *corners)
    living = grid.filter("home").select(
        *keys, F.col("unit").alias("b"), *(F.col(c).alias(f"o{c}") for c in corners)
    )
    gaps = [
        F.greatest(F.col(f"l{j}") - F.col(f"oh{j}"), F.col(f"ol{j}") - F.col(f"h{j}"), F.lit(0.0))
        for j in range(BLOCK)
    ]
    apart = sum((gap * gap for gap in gaps[1:]), gaps[0] * gaps[0])
    same = [asking[key] == living[key] for key in keys]
    found = asking.join(living, [*same, asking["a"] != living["b"], apart <= F.col("reach")])
    return stored(
        found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "vector-candidates",
    )


def _chunk_links(batch: pa.RecordBatch, least: float) -> Iterator[pa.RecordBatch]:
    """Numbers of links, and edges to the smallest id reached, of pairs of chunks."""
    out: list[list[np.ndarray]] = [[], [], [], []]
    sides = []
    for name in ("x", "y"):
        column = batch.column(name)
        members = column.values
        ends = column.offsets.to_numpy()
        fields = [members.field(c).to_numpy(zero_copy_only=False) for c in ("cid", "rep", "weight")]
        sides.append((ends, fields, members.field("vec")))
    same = batch.column("same").to_numpy(zero_copy_only=False)
    for at in range(batch.num_rows):
        (cx, rx, wx, vx), (cy, ry, wy, vy) = (
            (*(f[ends[at] : ends[at + 1]] for f in fields),
             next(_matrix(vec.slice(ends[at], ends[at + 1] - ends[at])))[1])
            for ends, fields, vec in sides
        )
        held = _reaches(vx, vy, least)
        if same[at]:
            np.fill_diagonal(held, False)
        if not held.any():
            continue
        low_x, low_y = lowest_reached(held, rx, ry, bool(same[at]))
        for cid, rep, low, links in (
            (cx, rx, low_x, (held * wy[None, :]).sum(axis=1)),
            (cy, ry, low_y, (held * wx[:, None]).sum(axis=0)),
        )[: 1 if same[at] else 2]:
            some = links > 0
            for kept, values in zip(out, (cid, rep, low, links), strict=True):
                kept.append(values[some])
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([np.zeros(0, np.int64), *values])) for values in out],
        ["cid", "rep", "low", "links"],
    )


def _verified(units: DataFrame, sizes: DataFrame, pairs: DataFrame, least: float) -> DataFrame:
    """(cid, rep, low, links) from every pair of chunks of candidate units."""
    chunk_of = F.when(
        F.col("members") > CHUNK,
        F.pmod(F.xxhash64("cid"), F.ceil(F.col("members") / CHUNK)),
    ).otherwise(F.lit(0))
    asked = pairs.select(F.explode(F.array("a", "b")).alias("unit")).unionByName(
        sizes.filter("members > 1").select("unit")
    )
    chunks = stored(
        units.join(sizes.select("unit", "members"), "unit")
        .join(asked.distinct(), "unit", "left_semi")
        .withColumn("chunk", chunk_of)
        # dealt by the chunk as well, or the join's partitioning would put a unit into one task
        .repartition("unit", "chunk").groupBy("unit", "chunk")
        .agg(F.collect_list(F.struct("cid", "rep", "weight", "vec")).alias("x"))
        .select("unit", F.struct("unit", "chunk").alias("name"), "x"),
        "vector-chunks",
    )
    inner = sizes.filter("members > 1").select(F.col("unit").alias("a"), F.col("unit").alias("b"))
    other = chunks.select(
        F.col("unit").alias("b"), F.col("name").alias("name_y"), F.col("x").alias("y")
    )
    both = (
        pairs.unionByName(inner)
        .join(chunks.withColumnRenamed("unit", "a"), "a").join(other, "b")
        .filter("a <> b OR name.chunk <= name_y.chunk")
        .select("x", "y", (F.col("name") == F.col("name_y")).alias("same"))
    )
    return stored(
        map_batches(
            both, partial(_chunk_links, least=least), "cid long, rep long, low long, links long"
        ),
        "vector-links",
    )


def near_duplicates(
    vectors: DataFrame, *, least: float = 0.98, id_column: str = "vec_id",
    vector_column: str = "embedding", label_column: str = "label",
) -> DataFrame:
    """(id, n_links, component_id, kept) of every row of `vectors`.

    Rows are linked if their labels and dimensions are equal and the cosine of their vectors,
    in double precision, is at least `least`; a component is named by its smallest id. A row
    whose label or vector is null, or whose vector is empty, zero or holds a null or
    non-finite component, is linked with nothing, and so is a row without an id, whose
    component is null and which is not kept. Rows that share an id are one node: their links
    join, and each row counts its own links, to its namesakes also. An empty table gives none.
    """
    if not 0 < least <= 1:
        raise ValueError("the least cosine is over 0 and at most 1")
    rows = vectors.select(
        F.col(f"`{id_column}`").cast("long").alias("id"),
        F.col(f"`{label_column}`").cast("string").alias("label"),
        F.col(f"`{vector_column}`").cast("array<double>").alias("vec"),
    )
    whole = (
        (F.size("vec") > 0)
        & F.forall("vec", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
        & F.exists("vec", lambda x: x != 0)
    )
    usable = F.coalesce(whole & F.col("id").isNotNull() & F.col("label").isNotNull(), F.lit(False))
    classes = stored(
        rows.filter(usable).groupBy("label", "vec")
        .agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("weight"))
        .select(F.monotonically_increasing_id().alias("cid"), "*"),
        "vector-classes",
    )
    units = _units(classes, least)
    sizes = stored(
        units.groupBy("unit", "label").agg(F.count(F.lit(1)).alias("members")), "vector-sizes"
    )
    links = _verified(units, sizes, _candidates(units, sizes, least), least)
    counts = links.groupBy("cid").agg(F.sum("links").alias("links"))
    named = stored(
        rows.filter(usable)
        .join(classes.join(counts, "cid", "left"), ["label", "vec"])
        .select("id", "rep", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n")),
        "vector-named",
    )
    edges = links.select(F.col("rep").alias("a"), F.col("low").alias("b")).unionByName(
        named.select(F.col("id").alias("a"), F.col("rep").alias("b"))
    )
    roots = components(edges.filter("a <> b").distinct())
    alone = rows.filter(~usable).select("id", F.lit(0).cast("long").alias("n"))
    return (
        named.select("id", "n").unionByName(alone).join(roots, "id", "left")
        .select(
            "id", F.col("n").alias("n_links"), F.coalesce("component", "id").alias("component_id")
        )
        .withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)))
    )
