"""Conditional upsert on plain tables.

`MERGE INTO` needs a table format that supports it, which Parquet tables do not, so the
merge is written in two parts:

* target LEFT JOIN batch keeps every target row and replaces its value when the batch
  has a different one. AQE may split the target side of a hot key, which it cannot do for
  a full outer join.
* batch LEFT ANTI JOIN (target keys LEFT SEMI JOIN batch) gives the rows to insert. Only
  keys that the batch has leave the inner join.

A batch whose size Spark knows to be small, such as one read from a file, is broadcast to
both target scans, and no target row is shuffled. A larger batch shuffles the target's rows
for the first join and its keys, without the other columns, for the second. The target is
read twice, the second time for its keys only, and is meant to be a stored table, as is the
batch, which would be computed more than once otherwise.

A target that is bucketed by a hash of its keys is merged in one full outer join instead, which
reads it once and moves the batch only, however large. Where its buckets have outgrown what a
task should sort, the target is dealt once, to more and smaller partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACTION = "merge_action"
KEPT, UPDATED, INSERTED = "kept", "updated", "inserted"

_NEW, _OLD, _KEY = "merge_new_", "merge_old_", "merge_key_"

#: The value to store, from the target's and the batch's.
Combine = Callable[[Column, Column], Column]


def replace(old: Column, new: Column) -> Column:
    """The batch's value."""
    return new


def add(old: Column, new: Column) -> Column:
    """The sum, for batches of changes; NULL, and so no change, if either is."""
    return old + new


def key_hash(keys: Sequence[str], types: Mapping) -> Column:
    """A hash of the keys in the target's types, in which NULL is a value like others."""
    return F.xxhash64(*(F.col(key).cast(types[key]) for key in keys))


def _one_row_per_key(
    source: DataFrame, target: DataFrame, keys: Sequence[str], value: str
) -> DataFrame:
    """The source under private names and in the target's types, its keys proven unique.

    The check guards the keys as well as the value, so every use of the batch runs it.
    """
    types = {f.name: f.dataType for f in target.schema.fields}
    grouped = source.groupBy(*keys).agg(
        F.max(value).alias(value), F.count(F.lit(1)).alias(f"{_NEW}rows")
    )
    single = F.col(f"{_NEW}rows") == 1
    failure = F.raise_error(F.lit("merge source has more than one row for a key"))
    return grouped.select(
        *(
            F.when(single, F.col(c).cast(types[c])).otherwise(failure).alias(_NEW + c)
            for c in (*keys, value)
        ),
        F.lit(True).alias(f"{_NEW}matched"),
    )


def _same_key(keys: Sequence[str], left: str, right: str, null_safe: bool) -> Column:
    """Equality of two prefixed sets of keys."""
    return reduce(
        and_,
        (
            F.col(left + key).eqNullSafe(F.col(right + key)) if null_safe
            else F.col(left + key) == F.col(right + key)
            for key in keys
        ),
    )


def _missing(
    batch: DataFrame, target: DataFrame, keys: Sequence[str], null_safe: bool
) -> DataFrame:
    """Batch rows whose key the target lacks."""
    theirs = target.select(*(F.col(key).alias(_OLD + key) for key in keys))
    mine = batch.select(*(F.col(_NEW + key).alias(_KEY + key) for key in keys))
    present = theirs.join(mine, _same_key(keys, _OLD, _KEY, null_safe), "left_semi")
    return batch.join(present, _same_key(keys, _NEW, _OLD, null_safe), "left_anti")


def tag_merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    value: str,
    *,
    null_safe: bool = False,
    on_update: Mapping[str, Column] | None = None,
    on_insert: Mapping[str, Column] | None = None,
    combine: Combine = replace,
) -> DataFrame:
    """Rows of the merged target, each with the action that produced it.

    A matched row takes the source's value where `target != source` is true, so a NULL
    on either side leaves it alone; an unmatched source row is inserted with its keys and
    value, other columns NULL; an unmatched target row stays. Keys match by `=`, or by
    `<=>` when `null_safe`. `on_update` and `on_insert` set further columns. `combine` makes
    the new value of both, which else is the source's.
    """
    on_update, on_insert = on_update or {}, on_insert or {}
    batch = _one_row_per_key(source, target, keys, value)
    match = _same_key(keys, "", _NEW, null_safe)
    new_value = F.col(_NEW + value)
    set_value = combine(F.col(value), new_value).cast(target.schema[value].dataType)
    changed = F.col(f"{_NEW}matched") & (F.col(value) != set_value)
    set_to = {value: set_value, **on_update}
    filled = {**{key: F.col(_NEW + key) for key in keys}, value: new_value, **on_insert}

    merged = target.join(batch, match, "left").select(
        *(
            F.when(changed, set_to[c]).otherwise(F.col(c)).alias(c) if c in set_to else F.col(c)
            for c in target.columns
        ),
        F.when(changed, F.lit(UPDATED)).otherwise(F.lit(KEPT)).alias(ACTION),
    )
    inserted = _missing(batch, target, keys, null_safe).select(
        *(
            filled.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.schema.fields
        ),
        F.lit(INSERTED).alias(ACTION),
    )
    return merged.unionByName(inserted)


def tag_merge_bucketed(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    value: str,
    bucket: str,
    buckets: int,
    *,
    null_safe: bool = False,
    on_update: Mapping[str, Column] | None = None,
    on_insert: Mapping[str, Column] | None = None,
    combine: Combine = replace,
    parts: int = 1,
) -> DataFrame:
    """`tag_merge` for a target whose column `bucket` is `key_hash` and which is bucketed by it.

    The batch is dealt to as many partitions by the same hash and meets the target's buckets
    where they are. The session must let a join use a partitioning by some of its keys
    (`spark.sql.requireAllClusterKeysForCoPartition` off). With `parts` above one, both sides are
    dealt to that many partitions for each bucket.
    """
    on_update, on_insert = on_update or {}, on_insert or {}
    types = {f.name: f.dataType for f in target.schema.fields}
    hashed = source.select(
        key_hash(keys, types).alias(_NEW + bucket), *keys, F.col(value)
    ).repartition(buckets * parts, _NEW + bucket)
    grouped = hashed.groupBy(_NEW + bucket, *keys).agg(
        F.max(value).alias(value), F.count(F.lit(1)).alias(f"{_NEW}rows")
    )
    single = F.col(f"{_NEW}rows") == 1
    failure = F.raise_error(F.lit("merge source has more than one row for a key"))
    batch = grouped.select(
        _NEW + bucket,
        *(F.col(key).cast(types[key]).alias(_NEW + key) for key in keys),
        F.when(single, F.col(value).cast(types[value])).otherwise(failure).alias(_NEW + value),
        F.lit(True).alias(f"{_NEW}matched"),
    )
    if parts > 1:
        target = target.repartition(buckets * parts, bucket)
    held = target.withColumn(f"{_OLD}row", F.lit(True))
    match = _same_key(keys, "", _NEW, null_safe) & (F.col(bucket) == F.col(_NEW + bucket))
    new_value = F.col(_NEW + value)
    set_value = combine(F.col(value), new_value).cast(types[value])
    present = F.col(f"{_OLD}row").isNotNull()
    changed = present & F.col(f"{_NEW}matched") & (F.col(value) != set_value)
    set_to = {value: set_value, **on_update}
    filled = {
        **{key: F.col(_NEW + key) for key in keys}, value: new_value,
        bucket: F.col(_NEW + bucket), **on_insert,
    }
    return held.join(batch, match, "full").select(
        *(
            F.when(changed, set_to[f.name] if f.name in set_to else F.col(f.name))
            .when(present, F.col(f.name))
            .otherwise(filled.get(f.name, F.lit(None)).cast(f.dataType)).alias(f.name)
            for f in target.schema.fields
        ),
        F.when(changed, F.lit(UPDATED)).when(present, F.lit(KEPT)).otherwise(F.lit(INSERTED))
        .alias(ACTION),
    )


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    value: str,
    **options,
) -> DataFrame:
    """The merged target without the action column; options as in `tag_merge`."""
    return tag_merge(target, source, keys, value, **options).drop(ACTION)
