"""Jaccard self-join on word shingles by prefix filters under several token orders (3).

Two texts with a similarity of at least t share a token among the first
`n - ceil(t n) + 1` tokens of each, under any order of all tokens. All orders here put
frequent tokens last and differ in how they scramble the others, so a passage that many
texts share seldom makes candidates. A pair must pass the filter of every order, and the
bounds on sizes and positions, before its sets are compared in full.

The work runs in rounds, so that a large group of near copies never becomes all its pairs:

1. Each text is paired with one hub (the smallest id) for its first token under each of a
   few orders that ignore frequency. The pairs that hold connect most members of a group. A
   text also joins the unit of the smallest hub that it has something in common with, similar
   enough or not, so that a group of texts below the threshold makes one unit as well. Units of
   few texts are taken apart again.
2. The prefix tokens of the first order are gathered, where a unit of several texts is one
   row for each token. Pairs of units come out, and only if they hold different components, so
   no link between components is missed. A pair of single texts must share as many prefix
   tokens as its sizes call for, and then a prefix token under each of the other orders,
   before its texts are joined to it and compared.
3. Units of several texts are compared in chunks of bounded size inside a task, with each
   other and within, by the filters of all orders and then by counts of common tokens. An edge
   to the smallest id reached comes out for each text, never the pairs.

Texts with equal sets form a class and take part once, so copies cost nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial, reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslake.llm.common import as_bytes, lowest_reached, map_batches
from saleslake.llm.shingles import mix, overlap, shingle_sets
from saleslake.plans.staging import stored
from saleslake.session import ship_package

ORDERS = 3
LEADS = 6
#: Percent of two texts' tokens in common that make them a unit.
LOOSE = 30
#: Texts and characters of a chunk; a longer text is a chunk of its own.
CHUNK = 128
#: Texts from which on a group is a unit; the few pairs of a smaller one are made.
UNIT = 16
CHUNK_CHARS = 1 << 22
#: Texts of a component that make chunks of their own in a unit.
_OWN = 32
_COLUMNS = 4096
_BUCKETS = 1 << 16
_PAIRS = 50_000
_LEVEL = np.uint64(56)


def _bucket(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(48)).astype(np.int64)


def ranks(tokens: np.ndarray, levels: np.ndarray, order: int) -> np.ndarray:
    """The tokens' places in an order: by level, and by a scrambling of their own within it.

    A place names its token up to a chance of 2**-56, which costs a needless comparison.
    """
    level = levels[_bucket(tokens)].astype(np.uint64) << _LEVEL
    return level | (mix(tokens, 100 + order) >> np.uint64(8))


def prefix(tokens: np.ndarray, levels: np.ndarray, order: int, percent: int) -> np.ndarray:
    """The first tokens under an order, of which any similar text shares one."""
    count = len(tokens) - -(-percent * len(tokens) // 100) + 1
    return np.sort(ranks(tokens, levels, order))[:count]


def _enough(common, size_a, size_b, percent: int):
    return 100 * common >= percent * (size_a + size_b - common)


def _describe(batch: pa.RecordBatch, words: int) -> Iterator[pa.RecordBatch]:
    """Size and key of each text's set, and how many tokens fell into each bucket."""
    sizes, keys = [], []
    counts = np.zeros(_BUCKETS, dtype=np.int64)
    for tokens in shingle_sets(as_bytes(batch.column(1)), words):
        counts += np.bincount(_bucket(tokens), minlength=_BUCKETS) if len(tokens) > 4096 else 0
        if len(tokens) <= 4096:
            np.add.at(counts, _bucket(tokens), 1)
        sizes.append(len(tokens))
        spread = mix(tokens, 7)
        keys.append(
            int(mix(tokens, 5).sum(dtype=np.uint64)).to_bytes(8, "big")
            + int(spread.sum(dtype=np.uint64)).to_bytes(8, "big")
        )
    yield pa.RecordBatch.from_arrays(
        [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
         pa.nulls(len(sizes), pa.int32()), pa.nulls(len(sizes), pa.int64())],
        ["id", "size", "key", "bucket", "tokens"],
    )
    full = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.nulls(len(full), pa.int64()), pa.nulls(len(full), pa.int64()),
         pa.nulls(len(full), pa.binary()), pa.array(full, pa.int32()),
         pa.array(counts[full], pa.int64())],
        ["id", "size", "key", "bucket", "tokens"],
    )


def _levels(described: DataFrame) -> np.ndarray:
    """How common each bucket's tokens are, in quarters of a doubling over the median.

    The table has 65,536 entries whatever the input. A text's token cannot be more
    frequent than its bucket is full, so tokens of many texts get a high level.
    """
    rows = (
        described.filter("bucket IS NOT NULL").groupBy("bucket").agg(F.sum("tokens")).collect()
    )
    counts = np.zeros(_BUCKETS)
    for bucket, total in rows:
        counts[bucket] = total
    middle = max(np.median(counts), 1)
    return np.clip(4 * np.log2(np.maximum(counts, 1) / middle), 0, 255).astype(np.uint8)


def _arrays(ids: list, sizes: list, tokens: list[np.ndarray]) -> pa.RecordBatch:
    """A row for each text with a list of tokens."""
    ends = np.concatenate([[0], np.cumsum([len(x) for x in tokens])]).astype(np.int32)
    flat = np.concatenate(tokens).view(np.int64) if tokens else np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
         pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))],
        ["id", "size", "tokens"],
    )


def _tokens_of(
    batch: pa.RecordBatch, words: int, choose: Callable[[np.ndarray], np.ndarray]
) -> Iterator[pa.RecordBatch]:
    ids, sizes, chosen = [], [], []
    sets = shingle_sets(as_bytes(batch.column(1)), words)
    for one, tokens in zip(batch.column(0).to_pylist(), sets, strict=True):
        if len(tokens):
            ids.append(one)
            sizes.append(len(tokens))
            chosen.append(choose(tokens))
    yield _arrays(ids, sizes, chosen)


def _leads(tokens: np.ndarray) -> np.ndarray:
    """The first token under each of several orders that rank all tokens alike.

    Two texts share such a token with a chance that equals their similarity. Rare tokens
    would not do here, as those of a near copy are mostly its own.
    """
    return np.unique([tokens[np.argmin(mix(tokens, 200 + order))] for order in range(LEADS)])


def _verify_batch(
    batch: pa.RecordBatch, words: int, percent: int, loose: int
) -> Iterator[pa.RecordBatch]:
    """The pairs of a batch with `loose` percent in common, and which of them are similar.

    Rows of one hub mostly follow each other.
    """
    firsts, seconds, held, linked = batch.column(0), batch.column(1), [], []
    last, hub = None, None
    texts = as_bytes(batch.column(2))
    for at, tokens in enumerate(shingle_sets(as_bytes(batch.column(3)), words)):
        if hub is None or texts[at] != last:
            last = texts[at]
            hub = next(shingle_sets([last], words))
        common = overlap(hub, tokens)
        held.append(bool(_enough(common, len(hub), len(tokens), loose)))
        linked.append(bool(_enough(common, len(hub), len(tokens), percent)))
    keep = pa.array(held, pa.bool_())
    yield pa.RecordBatch.from_arrays(
        [firsts.filter(keep), seconds.filter(keep), pa.array(linked, pa.bool_()).filter(keep)],
        ["a", "b", "linked"],
    )


def _named(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("id"))


def _texts_of(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The texts of some ids."""
    ids = stored(ids.distinct(), "ngram-ids")
    return stored(texts.join(ids, "id", "left_semi"), "ngram-texts")


def _verify(
    wanted: DataFrame, pairs: DataFrame, words: int, percent: int, loose: int
) -> DataFrame:
    """(a, b, linked) of the pairs with `loose` percent in common, by their texts."""
    second = pairs.join(wanted.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    both = second.join(wanted.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    checked = map_batches(
        both.select("a", "b", "text_a", "text_b"),
        partial(_verify_batch, words=words, percent=percent, loose=loose),
        "a long, b long, linked boolean",
    )
    return stored(checked.groupBy("a", "b").agg(F.max("linked").alias("linked")), "ngram-links")


def _other_prefixes(
    batch: pa.RecordBatch, words: int, percent: int, levels: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """Prefixes under all orders but the first, a token by 32 bits of its place."""
    sets = list(shingle_sets(as_bytes(batch.column(1)), words))
    columns = []
    for order in range(1, ORDERS):
        found = [
            (prefix(tokens, levels, order, percent) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            if len(tokens) else np.zeros(0, np.uint32)
            for tokens in sets
        ]
        ends = np.concatenate([[0], np.cumsum([len(x) for x in found])])
        flat = np.concatenate([np.zeros(0, np.uint32), *found]).view(np.int32)
        columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)))
    yield pa.RecordBatch.from_arrays(
        [batch.column(0), *columns], ["id", *(f"prefix{k}" for k in range(1, ORDERS))]
    )


def _pass_all_orders(
    wanted: DataFrame, pairs: DataFrame, words: int, percent: int, levels: np.ndarray
) -> DataFrame:
    """The pairs that share a prefix token under every further order."""
    names = [f"prefix{k}" for k in range(1, ORDERS)]
    prefixes = stored(
        map_batches(
            wanted.select("id", "text"), partial(_other_prefixes, words=words, percent=percent, levels=levels),
            "id long, " + ", ".join(f"{name} array<int>" for name in names),
        ),
        "ngram-orders",
    )
    for order, name in enumerate(names, 1):
        mine = prefixes.select(F.col("id").alias("a"), F.col(name).alias("mine"))
        theirs = prefixes.select(F.col("id").alias("b"), F.col(name).alias("theirs"))
        pairs = (
            pairs.join(mine, "a").join(theirs, "b").filter(F.arrays_overlap("mine", "theirs"))
            .select("a", "b").distinct()
        )
    return stored(pairs, "ngram-passed")


def _common_counts(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """How many tokens each set of `x` has in common with each of `y`.

    Counts are products of indicator matrices over the tokens that both sides have, some
    columns at a time.
    """
    shared = np.intersect1d(np.concatenate(x), np.concatenate(y))
    counts = np.zeros((len(x), len(y)), dtype=np.int64)
    sides = []
    for sets in (x, y):
        flat = np.concatenate(sets)
        row = np.repeat(np.arange(len(sets)), [len(one) for one in sets])
        place = np.searchsorted(shared, flat)
        known = shared[np.minimum(place, len(shared) - 1)] == flat if len(shared) else place < 0
        order = np.argsort(place[known], kind="stable")
        sides.append((row[known][order], place[known][order]))
    for start in range(0, len(shared), _COLUMNS):
        matrices = []
        for (row, place), sets in zip(sides, (x, y), strict=True):
            part = slice(*np.searchsorted(place, [start, start + _COLUMNS]))
            matrix = np.zeros((len(sets), min(_COLUMNS, len(shared) - start)), dtype=np.float32)
            matrix[row[part], place[part] - start] = 1
            matrices.append(matrix)
        counts += (matrices[0] @ matrices[1].T).astype(np.int64)
    return counts


def _chunk_links(
    batch: pa.RecordBatch, words: int, percent: int, levels: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """Edges (a, b) from each text of two chunks to the smallest id that it reaches there."""
    firsts, seconds = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    same = batch.column("same").to_numpy(zero_copy_only=False)
    for at in range(batch.num_rows):
        sides = []
        for name in ("x", "y"):
            members = batch.column(name).slice(at, 1).flatten()
            sets = list(shingle_sets(as_bytes(members.field("text")), words))
            ids, comps = (
                members.field(c).to_numpy(zero_copy_only=False) for c in ("id", "component")
            )
            some = np.array([k for k, one in enumerate(sets) if len(one)], dtype=np.int64)
            sides.append((ids[some], comps[some], [sets[k] for k in some]))
        (ids_x, comps_x, x), (ids_y, comps_y, y) = sides
        if not x or not y:
            continue
        size_x, size_y = (np.array([len(one) for one in sets]) for sets in (x, y))
        small = np.minimum(size_x[:, None], size_y[None, :])
        large = np.maximum(size_x[:, None], size_y[None, :])
        held = (100 * small >= percent * large) & (comps_x[:, None] != comps_y[None, :])
        for order in range(ORDERS):
            if held.any():
                starts = [[prefix(one, levels, order, percent) for one in z] for z in (x, y)]
                held &= _common_counts(*starts) > 0
        if held.any():
            held &= _enough(_common_counts(x, y), size_x[:, None], size_y[None, :], percent)
        if held.any():
            low_x, low_y = lowest_reached(held, ids_x, ids_y, bool(same[at]))
            firsts += [ids_x, ids_y]
            seconds += [low_x, low_y]
    a, b = np.concatenate(firsts), np.concatenate(seconds)
    yield pa.RecordBatch.from_arrays([pa.array(a[a != b]), pa.array(b[a != b])], ["a", "b"])


def _in_chunks(texts: DataFrame, members: DataFrame, pool: list[str]) -> DataFrame:
    """(*pool, salt, x): each pool's texts (id, component, text) in chunks of bounded size."""
    number = F.greatest(
        F.ceil(F.count(F.lit(1)) / CHUNK), F.ceil(F.sum(F.length("text")) / CHUNK_CHARS), F.lit(1)
    )
    rows = stored(texts.join(members, "id"), "ngram-chunk-texts")
    sizes = rows.groupBy(*pool).agg(number.alias("chunks"))
    # dealt by the salt as well, or the join's partitioning would put a pool into one task
    return (
        rows.join(sizes, pool)
        .withColumn("salt", F.pmod(F.xxhash64("id"), "chunks"))
        .repartition(*pool, "salt").groupBy(*pool, "salt")
        .agg(F.collect_list(F.struct("id", "component", "text")).alias("x"))
    )


def _chunk_members(labelled: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Which texts are in chunks: (unit, id, component, pure, pool) of hosts in `pairs` (host,
    other) and of units of several components, and (host, id, component) of hosts' partners.

    A component with many texts in a unit is pure: it has chunks of its own.
    """
    held = labelled.groupBy("unit", "component").agg(F.count(F.lit(1)).alias("own"))
    mixed = (
        held.groupBy("unit").agg(F.count(F.lit(1)).alias("components"))
        .filter("components > 1").select("unit")
    )
    hosts = stored(
        pairs.select(F.col("host").alias("unit")).unionByName(mixed).distinct(), "ngram-asked"
    )
    members = stored(
        labelled.join(hosts, "unit", "left_semi").join(held, ["unit", "component"])
        .select("unit", "id", "component", (F.col("own") >= _OWN).alias("pure"),
                F.when(F.col("own") >= _OWN, F.col("component")).otherwise(0).alias("pool")),
        "ngram-members",
    )
    partners = stored(
        pairs.join(labelled.select(F.col("unit").alias("other"), "id", "component"), "other")
        .select("host", "id", "component").distinct(),
        "ngram-partners",
    )
    return members, partners


def _chunked(
    texts: DataFrame, members: DataFrame, partners: DataFrame, words: int, percent: int,
    levels: np.ndarray,
) -> DataFrame:
    """Edges between hosts and their partners, and within units of several components.

    A host's chunks meet chunks of all its partners, so a text is not sent a chunk for each of
    its pairs. Two chunks of one pure component are not compared.
    """
    chunks = stored(
        _in_chunks(texts, members, ["unit", "pure", "pool"]).select(
            "unit", F.struct("pure", "pool", "salt").alias("name"),
            F.when(F.col("pure"), F.col("pool")).alias("one"), "x",
        ),
        "ngram-chunks",
    )
    partner_chunks = stored(_in_chunks(texts, partners, ["host"]), "ngram-partner-chunks")
    twin = chunks.select(
        "unit", F.col("name").alias("name_y"), F.col("one").alias("one_y"), F.col("x").alias("y")
    )
    inner = (
        chunks.join(twin, "unit")
        .filter("name <= name_y AND NOT coalesce(one = one_y, false)")
        .select("x", "y", (F.col("name") == F.col("name_y")).alias("same"))
    )
    across = chunks.join(
        partner_chunks.select(F.col("host").alias("unit"), F.col("x").alias("y")), "unit"
    ).select("x", "y", F.lit(False).alias("same"))
    return stored(
        map_batches(
            inner.unionByName(across),
            partial(_chunk_links, words=words, percent=percent, levels=levels),
            "a long, b long",
        ).distinct(),
        "ngram-edges",
    )


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in `links` (a, b): the smallest id it is connected to.

    Every id takes the smallest label among its neighbours and then its label's own label,
    until none changes. All steps are joins and minima, so an id with many links is combined
    before the shuffle; each round is written, so a lost executor costs a task only.
    """
    edges = stored(
        links.select("a", "b").union(links.select("b", "a")).distinct().filter("a <> b"),
        "component-edges",
    )
    labels = stored(
        edges.groupBy("a").agg(F.least("a", F.min("b")).alias("c")).withColumnRenamed("a", "id"),
        "component-labels",
    )
    while True:
        near = (
            edges.join(labels.withColumnRenamed("id", "b"), "b")
            .groupBy(F.col("a").alias("id")).agg(F.min("c").alias("near"))
        )
        lower = stored(
            labels.join(near, "id").select("id", "c", F.least("c", "near").alias("low")),
            "component-step",
        )
        jumped = lower.select(F.col("id").alias("low"), F.col("low").alias("root"))
        labels = stored(
            lower.join(jumped, "low", "left")
            .select("id", F.col("c").alias("before"), F.coalesce("root", "low").alias("c")),
            "component-labels",
        )
        if labels.filter("before <> c").isEmpty():
            return labels.select("id", F.col("c").alias("component"))
        labels = labels.select("id", "c")


class _Postings(NamedTuple):
    """Units of one token, the smallest sizes rising.

    A unit has the sizes `low` to `high` and the components `first` to `last`; `place` is the
    token's in the prefix of a unit's only text, and -1 for a unit of several.
    """

    low: np.ndarray
    high: np.ndarray
    unit: np.ndarray
    first: np.ndarray
    last: np.ndarray
    place: np.ndarray


def _token_pairs(rows: _Postings, percent: int) -> Iterator[np.ndarray]:
    """(a, b, need) of one token's units that hold different components.

    If a pair of texts is similar, any token it shares fits the sizes and the places in both. As
    the tokens up to the end of the prefix that ends first are all seen here, it must also share
    `need` prefix tokens: the least overlap less what can follow that prefix. Units of several
    texts need no more than sizes that fit.
    """
    sizes, places = rows.low, rows.place
    after = -(-percent * sizes // 100) - 1
    for at in range(len(sizes) - 1):
        end = np.searchsorted(sizes, 100 * rows.high[at] // percent, side="right")
        near = slice(at + 1, end)
        least = -(-percent * (sizes[at] + sizes[near]) // (100 + percent))
        most = np.minimum(places[at], places[near]) + np.minimum(
            sizes[at] - places[at], sizes[near] - places[near]
        )
        several = (places[near] < 0) | (places[at] < 0)
        one = (rows.first[at] == rows.last[near]) & (rows.last[at] == rows.first[near])
        one &= rows.first[near] == rows.last[near]
        ok = ~one & (several | (most >= least))
        other = rows.unit[near][ok]
        if len(other):
            need = np.where(several, 0, least - np.maximum(after[at], after[near]))
            yield np.stack(
                [np.minimum(other, rows.unit[at]), np.maximum(other, rows.unit[at]), need[ok]],
                axis=1,
            )


def _pair_batch(found: list[np.ndarray]) -> pa.RecordBatch:
    rows = np.concatenate(found)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.ascontiguousarray(rows[:, k])) for k in range(3)], ["a", "b", "need"]
    )


def _cross_pairs(
    batches: Iterator[pa.RecordBatch], percent: int
) -> Iterator[pa.RecordBatch]:
    """Pairs across components, one for each shared token, from rows sorted by token and size.

    The last token of a batch waits for the next one, as its rows may go on there.
    """
    columns = ("token", *_Postings._fields)
    rest: list[list[np.ndarray]] = []

    def whole(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        tokens, held = rows[0], _Postings(*rows[1:])
        starts = np.flatnonzero(np.diff(tokens, prepend=~tokens[:1]))
        ends = np.append(starts[1:], len(tokens))
        mixed = np.minimum.reduceat(held.first, starts) != np.maximum.reduceat(held.last, starts)
        waiting, size = [], 0
        for start, end in zip(starts[mixed], ends[mixed], strict=True):
            part = _Postings(*(x[start:end] for x in held))
            for found in _token_pairs(part, percent):
                waiting.append(found)
                size += len(found)
                if size >= _PAIRS:
                    yield _pair_batch(waiting)
                    waiting, size = [], 0
        if waiting:
            yield _pair_batch(waiting)

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = [batch.column(name).to_numpy() for name in columns]
        cut = int(np.searchsorted(rows[0], rows[0][-1]))
        if rest and (cut or rows[0][0] != rest[-1][0][-1]):
            # the waiting token ends in this batch, or ended before it
            head = cut if cut else 0
            yield from whole(
                [np.concatenate(x) for x in zip(*rest, [y[:head] for y in rows], strict=True)]
            )
            rest = []
        elif cut:
            yield from whole([x[:cut] for x in rows])
        rest.append([x[cut:] for x in rows])
    if rest:
        yield from whole([np.concatenate(x) for x in zip(*rest, strict=True)])


def similar_components(
    documents: DataFrame, *, id_column: str = "doc_id", text_column: str = "text",
    words: int = 5, percent: int = 80,
) -> DataFrame:
    """(id, n_shingles, component_id) of every row.

    A document's set is its distinct shingles of `words` words, ASCII letters lower-cased;
    with fewer words it is the whole sequence; a null or blank text has an empty set and is
    linked with nothing. Documents are linked if 100 * intersection >= percent * union, and
    a component is named by its smallest id. Rows that share an id are one node: their links
    join. A row with a null id is linked with nothing and has a null component.
    """
    spark = documents.sparkSession
    texts = documents.select(
        F.col(f"`{id_column}`").cast("long").alias("id"),
        F.col(f"`{text_column}`").alias("text"),
    )
    described = stored(
        map_batches(
            texts, partial(_describe, words=words),
            "id long, size long, key binary, bucket int, tokens long",
        ),
        "ngram-sets",
    )
    levels = _levels(described)
    sets = described.filter("size IS NOT NULL").select("id", "size", "key")
    alive = sets.filter("id IS NOT NULL AND size > 0")
    classes = stored(
        alive.groupBy("key").agg(F.min("id").alias("rep"), F.max("id").alias("last")),
        "ngram-classes",
    )
    reps = classes.select(F.col("rep").alias("id")).distinct()

    # Round 1: hubs of first tokens.
    leads = map_batches(
        texts.filter("id IS NOT NULL"),
        partial(_tokens_of, words=words, choose=_leads),
        "id long, size long, tokens array<long>",
    )
    leads = stored(
        leads.join(reps, "id", "left_semi").select("id", "size", F.explode("tokens").alias("token")),
        "ngram-leads",
    )
    hubs = stored(
        leads.groupBy("token")
        .agg(F.min(F.struct("id", "size")).alias("hub"), F.max("id").alias("last"))
        .filter("hub.id <> last")
        .select("token", F.col("hub.id").alias("hub"), F.col("hub.size").alias("hub_size")),
        "ngram-hubs",
    )
    close = (
        f"id <> hub AND 100 * least(size, hub_size) >= {percent} * greatest(size, hub_size)"
    )
    pairs = leads.join(hubs, "token").filter(close).select(
        F.col("hub").alias("a"), F.col("id").alias("b")
    )
    texts_of_reps = texts.filter("id IS NOT NULL")
    pairs = stored(pairs.distinct(), "ngram-pairs")
    near = _verify(_texts_of(texts_of_reps, _named(pairs)), pairs, words, percent, LOOSE)
    known = components(near.filter("linked"))
    hub_of = stored(
        near.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("unit")), "ngram-units"
    )
    further = hub_of.select(F.col("id").alias("unit"), F.col("unit").alias("root"))
    unit_of = stored(
        hub_of.join(further, "unit", "left").select("id", F.coalesce("root", "unit").alias("unit")),
        "ngram-groups",
    )
    large = unit_of.groupBy("unit").agg(F.count(F.lit(1)).alias("texts")).filter(
        F.col("texts") >= UNIT
    )
    unit_of = unit_of.join(large.select("unit"), "unit", "left_semi")

    # Round 2: every prefix token, across components only.
    postings = map_batches(
        texts.filter("id IS NOT NULL"),
        partial(
            _tokens_of, words=words,
            choose=partial(prefix, levels=levels, order=0, percent=percent),
        ),
        "id long, size long, tokens array<long>",
    )
    labelled = stored(
        reps.join(known, "id", "left").join(unit_of, "id", "left").select(
            "id", F.coalesce("component", "id").alias("component"),
            F.coalesce("unit", "id").alias("unit"),
        ),
        "ngram-known",
    )
    several = stored(
        labelled.filter("unit <> id").select("unit").distinct(), "ngram-several"
    )
    marked = labelled.join(several.withColumn("grouped", F.lit(True)), "unit", "left")
    placed = stored(postings.join(marked, "id"), "ngram-prefixes")
    postings = placed.select(
        F.posexplode("tokens").alias("place", "token"),
        "size", "id", "component", "unit", F.coalesce("grouped", F.lit(False)).alias("grouped"),
    )
    common = F.shiftright("token", 56) != 0
    joining = stored(
        postings.filter(common).groupBy("token")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low <> high").select("token"),
        "ngram-joining",
    )
    gathered = postings.filter(~common).unionByName(
        postings.filter(common).join(joining, "token", "left_semi")
    )
    # rows that share an id are texts of one unit, too, and have a row each
    alone = gathered.filter("NOT grouped").select(
        "token", F.col("size").alias("low"), F.col("size").alias("high"), "unit",
        F.col("component").alias("first"), F.col("component").alias("last"),
        F.col("place").cast("long").alias("place"),
    )
    together = gathered.filter("grouped").groupBy("token", "unit").agg(
        F.min("size").alias("low"), F.max("size").alias("high"),
        F.min("component").alias("first"), F.max("component").alias("last"),
    )
    ship_package(spark)
    across = stored(
        alone.unionByName(together.withColumn("place", F.lit(-1).cast("long")))
        .repartition("token").sortWithinPartitions("token", "low")
        .mapInArrow(partial(_cross_pairs, percent=percent), "a long, b long, need long")
        .groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"), F.min("need").alias("need"))
        .filter("shared >= need").select("a", "b"),
        "ngram-across",
    )
    units = several.select(F.col("unit").alias("a"), F.lit(True).alias("many_a"))
    sided = stored(
        across.join(units, "a", "left")
        .join(several.select(F.col("unit").alias("b"), F.lit(True).alias("many_b")), "b", "left")
        .select("a", "b", "many_a", F.coalesce("many_a", "many_b", F.lit(False)).alias("many")),
        "ngram-sided",
    )
    single = sided.filter("NOT many").select("a", "b")
    hosted = sided.filter("many").select(
        F.when(F.col("many_a"), F.col("a")).otherwise(F.col("b")).alias("host"),
        F.when(F.col("many_a"), F.col("b")).otherwise(F.col("a")).alias("other"),
    )
    members, partners = _chunk_members(labelled, hosted)
    asked = reduce(
        DataFrame.unionByName, (_named(single), members.select("id"), partners.select("id"))
    )
    wanted = _texts_of(texts_of_reps, asked)
    passed = _pass_all_orders(wanted, single, words, percent, levels)
    far = _verify(wanted, passed, words, percent, percent).select("a", "b")
    edges = _chunked(wanted, members, partners, words, percent, levels)
    roots = components(
        known.select(F.col("id").alias("a"), F.col("component").alias("b"))
        .unionByName(far).unionByName(edges)
    )

    named = stored(
        classes.join(roots.withColumnRenamed("id", "rep"), "rep", "left")
        .select("key", F.coalesce("component", "rep").alias("root")),
        "ngram-named",
    )
    return sets.join(named, "key", "left").select(
        F.col("id"),
        F.col("size").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce(F.when(F.col("size") > 0, F.col("root")), "id"))
        .alias("component_id"),
    )
