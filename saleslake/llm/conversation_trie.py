"""The trie of rebuilt conversations' prefixes by composable fingerprints (12).

A conversation is rebuilt from the head of its base and its own turns after as many. Rebuilt
texts are never made. A sequence of turns has a fingerprint (n, h) in a monoid with the product

    (n1, h1) * (n2, h2) = (n1 + n2, h1 + B**n1 * h2)      modulo two primes,

where a turn is (1, B * e) with e from the digest of its role and text. One scan of the sorted
turns yields the product of every conversation's first k turns; pieces of a conversation that
lie in several tasks are joined by the product of their totals. Since B has an inverse, the
product of a conversation's turns after the first h follows from two of these, and with the
base's head before it from one more: all prefixes of a rebuilt conversation come from stored
products by arithmetic.

Equal fingerprints make a node. Each prefix row refers to its last stored turn by 128 bits of
that turn's SHA-256 digest; a node holds if all its rows agree in this reference and in the
parent, which by induction makes their sequences equal. If a node fails, everything is done
again under another B.

Sums over subtrees need no walk over levels. A node stands for its smallest member; below a node
its members' own sums are added, and only the smallest member's counts from the node's depth on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleslake.plans.staging import stored
from saleslake.session import ship_package

#: Conversations whose ids share all but the remainder by this have one base.
FAMILY = 20
#: Heads are shorter than this.
HEADS = 4
#: The largest two primes below 2**31, so that products fit into 64 bits.
PRIMES = (2**31 - 1, 2**31 - 19)
_RUN = 1024
_IDS = 1 << 16
_WORD = r"[^\x20\x09-\x0D]+"
_NODE = ["depth", "f1", "f2"]


def _bases(seed: int) -> tuple[int, int]:
    """The two bases of a seed."""
    random = np.random.Generator(np.random.PCG64(1000 + seed))
    return tuple(int(random.integers(1 << 16, prime - 1)) for prime in PRIMES)


def _powers(base: int, prime: int, size: int) -> np.ndarray:
    """base**0 ... base**(size - 1) modulo the prime."""
    out = np.ones(1, dtype=np.uint64)
    while len(out) < size:
        step = np.uint64(pow(base, len(out), prime))
        out = np.concatenate([out, out * step % np.uint64(prime)])
    return out[:size]


def _scan(batches: Iterator[pa.RecordBatch], bases: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Products of the turns of each conversation so far, within the task.

    Rows come sorted by conversation and place. The totals of the task's first and last
    conversation follow as rows of their own, as others may hold the rest of them.
    """
    part = TaskContext.get().partitionId()
    current, held, sums, totals = None, 0, [0, 0], []
    only = True
    for batch in batches:
        if not batch.num_rows:
            continue
        convs = batch.column("conv").to_numpy()
        digests = np.frombuffer(
            b"".join(batch.column("digest").to_pylist()), dtype=">u8"
        ).reshape(-1, 4).astype(np.uint64)
        starts = np.flatnonzero(np.diff(convs, prepend=convs[0] - 1 if current is None else current))
        bounds = np.unique(np.concatenate([[0], starts, [len(convs)]]))
        lengths = np.diff(bounds)
        goes_on = current is not None and convs[0] == current
        before = np.zeros(len(lengths), dtype=np.int64)
        if goes_on:
            before[0] = held
        places = np.arange(1, len(convs) + 1) - np.repeat(bounds[:-1] - before, lengths)
        columns, ends = [], []
        for k, (base, prime) in enumerate(zip(bases, PRIMES, strict=True)):
            p = np.uint64(prime)
            terms = (digests[:, k] % np.uint64(prime - 1) + np.uint64(1)) * _powers(
                base, prime, int(places.max()) + 1
            )[places] % p
            running = np.concatenate([[np.uint64(0)], np.cumsum(terms)])
            offset = p - running[bounds[:-1]] % p
            if goes_on:
                offset[0] = (offset[0] + np.uint64(sums[k])) % p
            product = (running[1:] + np.repeat(offset, lengths)) % p
            columns += [product.astype(np.int64), terms.astype(np.int64)]
            ends.append(product)
        # totals of a conversation that began the task and ends here
        if only and current is not None and not goes_on:
            totals.append((current, held, *sums))
            only = False
        if only and len(lengths) > 1:
            at = bounds[1] - 1
            totals.append((int(convs[at]), int(places[at]), int(ends[0][at]), int(ends[1][at])))
            only = False
        current, held = int(convs[-1]), int(places[-1])
        sums = [int(ends[0][-1]), int(ends[1][-1])]
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), pa.array(np.full(len(convs), part, np.int32)),
             pa.array(places), *(pa.array(c) for c in columns),
             pa.array(digests[:, 2].astype(np.int64)), pa.array(digests[:, 3].astype(np.int64)),
             batch.column("words"), pa.array(np.zeros(len(convs), dtype=bool))],
            ["conv", "part", "pos", "h1", "t1", "h2", "t2", "r1", "r2", "words", "total"],
        )
    if current is not None:
        totals.append((current, held, *sums))
        convs, places, first, second = (pa.array(x, pa.int64()) for x in zip(*totals, strict=True))
        none = pa.array([0] * len(totals), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [convs, pa.array([part] * len(totals), pa.int32()), places, first, none, second,
             none, none, none, none, pa.array([True] * len(totals))],
            ["conv", "part", "pos", "h1", "t1", "h2", "t2", "r1", "r2", "words", "total"],
        )


def _turns(
    conversations: DataFrame, conv: str, turn: str, role: str, text: str
) -> DataFrame:
    """Each turn's place, digest and number of words; null roles and texts are empty."""
    said = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    by = F.coalesce(F.col(f"`{role}`").cast("string"), F.lit(""))
    whole = F.concat(F.length(by).cast("string"), F.lit(":"), by, said)
    return stored(
        conversations.filter(F.col(f"`{conv}`").isNotNull()).select(
            F.monotonically_increasing_id().alias("tid"),
            F.col(f"`{conv}`").cast("long").alias("conv"),
            F.col(f"`{turn}`").alias("turn"),
            by.alias("role"),
            F.unhex(F.sha2(whole.cast("binary"), 256)).alias("digest"),
            F.regexp_count(said, F.lit(_WORD)).cast("long").alias("words"),
        ),
        "trie-turns",
    )


def _prefixes(turns: DataFrame, bases: tuple[int, int]) -> DataFrame:
    """(conv, pos, h1, h2, before1, before2, r1, r2, words) of every stored prefix."""
    order = [F.col("conv"), F.asc_nulls_first("turn"), F.col("role"), F.col("digest"), F.col("tid")]
    ship_package(turns.sparkSession)
    scanned = stored(
        turns.repartitionByRange(*order).sortWithinPartitions(*order)
        .mapInArrow(
            partial(_scan, bases=bases),
            "conv long, part int, pos long, h1 long, t1 long, h2 long, t2 long, r1 long, r2 long,"
            " words long, total boolean",
        ),
        "trie-scan",
    )
    # two rows a task at most
    totals = scanned.filter("total").select("part", "conv", "pos", "h1", "h2").collect()
    carries, state = [], {}
    for part, conv, size, *sums in sorted(totals):
        done, *held = state.get(conv, (0, 0, 0))
        if done:
            carries.append((
                part, conv, done, *held, *(pow(b, done, p) for b, p in zip(bases, PRIMES, strict=True))
            ))
        # only conversations of the last task can go on
        state = {conv: (
            done + size,
            *((x + pow(b, done, p) * y) % p
              for x, y, b, p in zip(held, sums, bases, PRIMES, strict=True)),
        )}
    rows = scanned.filter("NOT total")
    if carries:
        carried = turns.sparkSession.createDataFrame(
            carries, "part int, conv long, done long, c1 long, c2 long, w1 long, w2 long"
        )
        rows = rows.join(carried, ["part", "conv"], "left")
    else:
        rows = rows.selectExpr("*", "0L AS done", *(f"0L AS c{k}" for k in (1, 2)),
                               *(f"1L AS w{k}" for k in (1, 2)))
    moved = rows.select(
        "conv", (F.col("pos") + F.coalesce("done", F.lit(0))).alias("pos"),
        *(
            F.when(F.col("done").isNull(), F.col(f"h{k}"))
            .otherwise((F.col(f"c{k}") + F.col(f"w{k}") * F.col(f"h{k}")) % p).alias(f"h{k}")
            for k, p in enumerate(PRIMES, 1)
        ),
        *(
            (F.col(f"t{k}") * F.coalesce(f"w{k}", F.lit(1)) % p).alias(f"t{k}")
            for k, p in enumerate(PRIMES, 1)
        ),
        "r1", "r2", "words",
    )
    return stored(
        moved.select(
            "*", *(
                F.pmod(F.col(f"h{k}") - F.col(f"t{k}"), F.lit(p)).alias(f"before{k}")
                for k, p in enumerate(PRIMES, 1)
            )
        ).drop("t1", "t2"),
        "trie-prefixes",
    )


def _rebuilt(prefixes: DataFrame) -> DataFrame:
    """How each conversation is rebuilt: h of its own turns give way to `head` of the base's.

    `b1`, `b2` are the products of that head, `o1`, `o2` those of the own turns that give way.
    """
    shown = F.struct("pos", "h1", "h2", "before1", "before2", "r1", "r2", "words")
    convs = stored(
        prefixes.groupBy("conv").agg(
            F.max("pos").alias("len"),
            F.sort_array(F.collect_list(F.when(F.col("pos") < HEADS, shown))).alias("first"),
        ),
        "trie-conversations",
    )
    bases = convs.select(
        F.col("conv").alias("base"), F.col("len").alias("base_len"), F.col("first").alias("given")
    )
    own = F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS
    joined = (
        convs.select("*", own.alias("h"), (F.col("conv") - F.col("conv") % FAMILY).alias("base"))
        .join(bases, "base", "left")
        .withColumn("head", F.least(F.col("h"), F.coalesce("base_len", F.lit(0))))
    )

    def product(rows: str, size: str, part: str) -> Column:
        """The product of the first `size` turns; of none, 0; 0 also where there are fewer."""
        place = F.greatest(F.col(size), F.lit(1)).cast("int")
        held = F.when(F.col(size) > 0, F.try_element_at(F.col(rows), place)[part])
        return F.coalesce(held, F.lit(0)).cast("long")

    return stored(
        joined.select(
            "conv", "h", "head",
            (F.col("head") + F.greatest(F.col("len") - F.col("h"), F.lit(0))).alias("size"),
            *(product("given", "head", f"h{k}").alias(f"b{k}") for k in (1, 2)),
            *(product("first", "h", f"h{k}").alias(f"o{k}") for k in (1, 2)),
            F.when(F.col("head") > 0, F.slice("given", F.lit(1), F.col("head").cast("int")))
            .alias("given"),
        ),
        "trie-rebuilt",
    )


def _members(prefixes: DataFrame, rebuilt: DataFrame, bases: tuple[int, int]) -> DataFrame:
    """A row for each rebuilt conversation and depth: its node, its parent, its last turn."""
    heads = rebuilt.select("conv", "size", F.explode("given").alias("g")).select(
        "conv", F.col("g.pos").alias("depth"),
        *(F.col(f"g.h{k}").alias(f"f{k}") for k in (1, 2)),
        *(F.col(f"g.before{k}").alias(f"p{k}") for k in (1, 2)),
        "g.r1", "g.r2", "g.words", (F.col("g.pos") == F.col("size")).alias("ends"),
    )

    def moved(k: int, column: str) -> Column:
        """The base's head before the own turns after h, moved from h to head places."""
        base, prime = bases[k - 1], PRIMES[k - 1]
        back = F.array(*(F.lit(pow(base, -step, prime)) for step in range(HEADS)))
        after = F.pmod(F.col(column) - F.col(f"o{k}"), F.lit(prime))
        shift = F.get(back, (F.col("h") - F.col("head")).cast("int"))
        return (F.col(f"b{k}") + shift * after) % prime

    depth = F.col("head") + F.col("pos") - F.col("h")
    own = (
        prefixes.join(rebuilt.drop("given"), "conv").filter("pos > h")
        .select(
            "conv", depth.alias("depth"),
            *(moved(k, f"h{k}").alias(f"f{k}") for k in (1, 2)),
            *(moved(k, f"before{k}").alias(f"p{k}") for k in (1, 2)),
            "r1", "r2", "words", (depth == F.col("size")).alias("ends"),
        )
    )
    return stored(heads.unionByName(own), "trie-members")


def _nodes(members: DataFrame) -> DataFrame:
    """Groups of equal fingerprints; `whole` tells whether their rows agree."""
    agree = [F.min(c) == F.max(c) for c in ("p1", "p2", "r1", "r2")]
    return stored(
        members.groupBy(*_NODE).agg(
            F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"),
            F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.max("words").alias("words"),
            F.count_if("ends").alias("n_ends"), F.min(F.when(F.col("ends"), F.col("conv"))).alias("end"),
            (agree[0] & agree[1] & agree[2] & agree[3]).alias("whole"),
        ),
        "trie-nodes",
    )


def _root(rebuilt: DataFrame) -> DataFrame:
    """The node of no turns, which all conversations share; no row for no conversations."""
    empty = F.col("size") == 0
    zero = [F.lit(0).cast("long").alias(c) for c in ("depth", "f1", "f2")]
    return rebuilt.agg(
        F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"),
        F.count_if(empty).alias("n_ends"), F.min(F.when(empty, F.col("conv"))).alias("end"),
    ).filter("n_convs > 0").select(
        *zero, "conv", "n_convs", F.lit(None).cast("long").alias("p1"),
        F.lit(None).cast("long").alias("p2"), F.lit(0).cast("long").alias("words"),
        "n_ends", "end", F.lit(True).alias("whole"),
    )


def _below(nodes: DataFrame, members: DataFrame, leaves: DataFrame) -> DataFrame:
    """n_leaves and saved_tokens of the nodes with several members.

    `members` has the root's rows too. Each node's saving belongs to its smallest member; a
    node's subtree holds all savings of its other members, as these begin below it, and those
    of its smallest member from its own depth on. That last sum runs over blocks of depths
    first, so that no task sees more than a share of a long conversation.
    """
    shared = nodes.filter("n_convs > 1").select(
        *_NODE, "conv", ((F.col("n_convs") - 1) * F.col("words")).alias("saved")
    )
    shared = stored(
        shared.withColumn("run", F.floor(F.col("depth") / _RUN).cast("long")), "trie-shared"
    )
    runs = shared.groupBy("conv", "run").agg(F.sum("saved").alias("in_run"))
    later = Window.partitionBy("conv").orderBy(F.desc("run")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    rest = Window.partitionBy("conv", "run").orderBy(F.desc("depth")).rowsBetween(
        Window.unboundedPreceding, 0
    )
    from_here = (
        shared.join(runs.select("conv", "run", F.sum("in_run").over(later).alias("later")),
                    ["conv", "run"])
        .select(*_NODE, "conv",
                (F.coalesce("later", F.lit(0)) + F.sum("saved").over(rest)).alias("from_here"))
    )
    own = stored(
        shared.groupBy("conv").agg(F.sum("saved").alias("own"), F.lit(0).alias("leaf"))
        .unionByName(leaves.select("conv", F.lit(0).cast("long").alias("own"), F.lit(1).alias("leaf")))
        .groupBy("conv").agg(F.sum("own").alias("own"), F.max("leaf").alias("leaf")),
        "trie-own",
    )
    sums = (
        members.select(*_NODE, "conv").join(own, "conv")
        .groupBy(*_NODE)
        .agg(F.sum("own").alias("all_own"), F.sum("leaf").alias("n_leaves"))
    )
    return (
        from_here.join(own.select("conv", F.col("own").alias("mine")), "conv")
        .join(sums, _NODE)
        .select(*_NODE, "n_leaves",
                (F.col("all_own") - F.col("mine") + F.col("from_here")).alias("saved_tokens"))
    )


def _joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of a node's ids as text, from rows sorted by node and id."""
    for batch in batches:
        for at in range(0, batch.num_rows, _IDS):
            some = batch.slice(at, _IDS)
            keys = np.stack([some.column(c).to_numpy() for c in _NODE])
            changes = np.flatnonzero((np.diff(keys, axis=1) != 0).any(axis=0)) + 1
            starts = np.concatenate([[0], changes]) if some.num_rows else changes
            ends = np.append(starts[1:], some.num_rows)
            ids = some.column("conv").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(row[starts]) for row in keys),
                 pa.array([ids[s] for s in starts], pa.int64()),
                 pa.array([",".join(map(str, ids[s:e])) for s, e in zip(starts, ends, strict=True)],
                          pa.string())],
                [*_NODE, "conv", "ids"],
            )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's ids, read run by run."""
    node, state = None, None

    def out(done: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [*(pa.array([key[k] for key, _ in done], pa.int64()) for k in range(3)),
             pa.array([digest for _, digest in done], pa.string())],
            [*_NODE, "ends_sha256"],
        )

    for batch in batches:
        done = []
        for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*_NODE, "ids")), strict=True):
            if key == node:
                state.update(b"," + ids.encode())
                continue
            if node is not None:
                done.append((node, state.hexdigest()))
            node, state = key, hashlib.sha256(ids.encode())
        if done:
            yield out(done)
    if node is not None:
        yield out([(node, state.hexdigest())])


def _ends(nodes: DataFrame, members: DataFrame) -> DataFrame:
    """ends_sha256 of the nodes at which several conversations end.

    Ids are sorted and written out by many tasks; a node's last task hashes whole runs of them.
    """
    several = nodes.filter("n_ends > 1").select(*_NODE)
    ids = members.filter("ends").select(*_NODE, "conv").join(several, _NODE, "left_semi")
    runs = stored(
        ids.repartitionByRange(*_NODE, "conv").sortWithinPartitions(*_NODE, "conv")
        .mapInArrow(_joined_ids, "depth long, f1 long, f2 long, conv long, ids string"),
        "trie-ends",
    )
    return (
        runs.repartition(*_NODE).sortWithinPartitions(*_NODE, "conv")
        .mapInArrow(_hashed, "depth long, f1 long, f2 long, ends_sha256 string")
    )


def prefix_trie(
    conversations: DataFrame, *, conv_column: str = "conv_id", turn_column: str = "turn",
    role_column: str = "role", text_column: str = "text", seed: int = 0,
) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations.

    A conversation's turns are ordered by turn, null first, then by role, then by the digest of
    role and text; rows that agree in all of these are turns of their own, in any order. Null
    roles and texts are empty; rows without a conversation id take no part. Conversation c is
    rebuilt from the first h turns of conversation c - c % 20 (all if it has fewer, none if it is
    absent) and its own turns after the first h, with h = crc32(c) % 4. Each distinct sequence
    of the first d rebuilt turns is a node; an empty table has none, not even the root.

    Columns: conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256, as the module says. `seed` chooses the first base.
    """
    turns = _turns(conversations, conv_column, turn_column, role_column, text_column)
    for attempt in count(seed):
        bases = _bases(attempt)
        prefixes = _prefixes(turns, bases)
        rebuilt = _rebuilt(prefixes)
        members = _members(prefixes, rebuilt, bases)
        nodes = _nodes(members)
        if nodes.filter("NOT whole").isEmpty():
            break
    return _described(stored(nodes.unionByName(_root(rebuilt)), "trie-all"), members, rebuilt)


def _described(nodes: DataFrame, members: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """The nodes with what hangs below them."""
    top = rebuilt.select(
        *(F.lit(0).cast("long").alias(c) for c in _NODE), "conv", (F.col("size") == 0).alias("ends")
    )
    everyone = members.select(*_NODE, "conv", "ends").unionByName(top)
    children = stored(
        nodes.filter("depth > 0")
        .groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("f1"), F.col("p2").alias("f2"))
        .agg(F.count(F.lit(1)).alias("n_children")),
        "trie-children",
    )
    leaves = nodes.join(children, _NODE, "left_anti").select("conv")
    below = _below(nodes, everyone, leaves)
    ends = _ends(nodes, everyone)
    parents = nodes.join(children, _NODE, "left_semi").select(
        (F.col("depth") + 1).alias("depth"), F.col("f1").alias("p1"), F.col("f2").alias("p2"),
        F.col("conv").alias("parent_conv_id"),
    )
    alone = F.when(F.col("n_ends") == 0, F.lit("")).otherwise(F.col("end").cast("string"))
    return (
        nodes.join(children, _NODE, "left").join(below, _NODE, "left").join(ends, _NODE, "left")
        .join(parents, ["depth", "p1", "p2"], "left")
        .select(
            F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs",
            F.coalesce("n_children", F.lit(0)).alias("n_children"),
            F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"),
            F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(alone.cast("binary"), 256)).alias("ends_sha256"),
        )
    )
