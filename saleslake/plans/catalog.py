"""Databases, declared tables and writes into them."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from saleslake.functions.columns import conform
from saleslake.operators.merge import (
    ACTION,
    INSERTED,
    KEPT,
    UPDATED,
    Combine,
    key_hash,
    replace,
    tag_merge,
    tag_merge_bucketed,
)
from saleslake.plans.staging import BRIEF_SHUFFLES, remove, settings, staged, staging_path
from saleslake.schemas import (
    BATCH,
    DATABASE,
    ENGINE_TABLES,
    KEY_HASH,
    OWN,
    TABLES,
    TableSpec,
)

_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
#: A join may use buckets by one of its keys, and a copy of a bucketed table reads its buckets.
_BUCKETED = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
}
#: A copy of a table whose buckets are too large for a task reads its files in any order.
_BY_FILES = {
    "spark.sql.sources.bucketing.enabled": "false",
    "spark.sql.files.maxPartitionBytes": str(32 * 1024 * 1024),
}
#: Of the tables' files, which are kept, and so on the disk for longer than any shuffle.
_COMPRESSION = "zstd"
#: Rows that a bucket of a merged table should hold: a task of a merge sorts those of one bucket.
BUCKET_ROWS = 500_000
_MAX_BUCKETS = 10_000


def buckets_for(rows: int, least: int = 1) -> int:
    """Buckets for a table that is to hold about so many rows, so that a task's share stays."""
    return min(max(least, -(-rows // BUCKET_ROWS)), max(least, _MAX_BUCKETS))


def _parts(rows: int, buckets: int) -> int:
    """Into how many parts a bucket is cut, where a table holds twice what it was made for."""
    return -(-rows // (buckets * BUCKET_ROWS)) if rows > 2 * buckets * BUCKET_ROWS else 1


def create_database(
    spark: SparkSession, database: str = DATABASE, location: str | None = None
) -> None:
    """Create the database unless it exists."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")


def create_tables(
    spark: SparkSession,
    database: str = DATABASE,
    tables: Iterable[TableSpec] = tuple(TABLES.values()),
    *,
    buckets: int | None = None,
) -> None:
    """Create the declared tables unless they exist.

    With `buckets`, tables with keys are bucketed and sorted by a hash of them, in a column
    beside the declared ones. A partition value's rows then lie in that many files. `buckets_for`
    tells how many a table of known size should have; a table that has outgrown its number is
    merged by finer partitions, for which its rows are shuffled.
    """
    for spec in tables:
        columns, split = spec.schema.toDDL(), list(spec.partition_by)
        if spec.by_batch:
            columns, split = f"{columns}, {BATCH} STRING", [BATCH, *split]
        clause = f" PARTITIONED BY ({', '.join(split)})" if split else ""
        if buckets and spec.keys:
            columns = f"{columns}, {KEY_HASH} BIGINT"
            clause += (
                f" CLUSTERED BY ({KEY_HASH}) SORTED BY ({KEY_HASH}) INTO {int(buckets)} BUCKETS"
            )
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS `{database}`.`{spec.name}` ({columns})"
            f" USING parquet OPTIONS (compression '{_COMPRESSION}'){clause}"
        )


def use_database(spark: SparkSession, database: str = DATABASE) -> None:
    """Make the database current for unqualified names (D3)."""
    spark.catalog.setCurrentDatabase(database)


def drop_database(spark: SparkSession, database: str = DATABASE) -> None:
    """Drop the database with all its tables."""
    spark.sql(f"DROP DATABASE IF EXISTS `{database}` CASCADE")


def list_databases(spark: SparkSession) -> list[str]:
    """Names of all databases."""
    return sorted(entry.name for entry in spark.catalog.listDatabases())


def list_tables(spark: SparkSession, database: str = DATABASE) -> list[str]:
    """Names of the database's tables (D5); temporary views and the engine's own are left out."""
    entries = spark.catalog.listTables(database)
    return sorted(
        entry.name for entry in entries
        if not entry.isTemporary and not entry.name.startswith(OWN)
    )


def _declared(name: str) -> TableSpec | None:
    return TABLES.get(name) or ENGINE_TABLES.get(name)


def _stored_table(spark: SparkSession, name: str, database: str) -> DataFrame:
    return spark.table(f"`{database}`.`{name}`")


def table(
    spark: SparkSession, name: str, database: str = DATABASE, batch: str | None = None
) -> DataFrame:
    """Scan a table (S7), or what one batch has brought, in the declared columns."""
    rows = _stored_table(spark, name, database)
    if batch is not None:
        rows = rows.filter(F.col(BATCH) == batch)
    spec = _declared(name)
    return rows.select(*spec.schema.names) if spec else rows


def _bucket_count(spark: SparkSession, name: str, database: str) -> int:
    """Buckets by the keys' hash; 0 for a table without."""
    if KEY_HASH not in _stored_table(spark, name, database).columns:
        return 0
    rows = spark.sql(f"DESCRIBE FORMATTED `{database}`.`{name}`")
    return int(rows.filter("col_name = 'Num Buckets'").first()["data_type"])


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _into_batch(rows: DataFrame, name: str, database: str, batch: str | None) -> None:
    """Write into a batch's partition: a named batch replaces all that it has brought before."""
    view = f"{OWN}{uuid.uuid4().hex}"
    rows.createOrReplaceTempView(view)
    verb, value = ("INTO", "NULL") if batch is None else ("OVERWRITE", _quoted(batch))
    try:
        rows.sparkSession.sql(
            f"INSERT {verb} TABLE `{database}`.`{name}` PARTITION ({BATCH} = {value})"
            f" SELECT * FROM `{view}`"
        )
    finally:
        rows.sparkSession.catalog.dropTempView(view)


def append(
    df: DataFrame, name: str, database: str = DATABASE, batch: str | None = None
) -> None:
    """Append to an existing table, conformed to its declared schema (K1, K3).

    A name that is not a table is an error; it is never created on the fly. With a `batch`
    name the rows become that batch's partition, in place of what it held: the same append can be
    repeated after any failure, and rows are never doubled. Rows without a batch are added.

    Rows of a partitioned table are gathered by partition value first, or every task would
    write a file into every partition; AQE spreads a value with much data over several files.
    A table filed by year is gathered by year and sorted by date within a task, so files and
    row groups hold narrow ranges of dates. A bucketed table's rows are gathered by bucket; AQE
    spreads a bucket with much data over several tasks.
    """
    spark = df.sparkSession
    rows = conform(df, table(spark, name, database).schema)
    spec = _declared(name)
    if batch is not None and not (spec and spec.by_batch):
        raise ValueError(f"table '{name}' is not filed by batch")
    buckets = _bucket_count(spark, name, database) if spec and spec.keys else 0
    if buckets:
        types = {f.name: f.dataType for f in rows.schema.fields}
        rows = (
            rows.withColumn(KEY_HASH, key_hash(spec.keys, types))
            # the number of the bucket that Spark files a row in
            .withColumn("_bucket", F.pmod(F.hash(KEY_HASH), F.lit(buckets)))
            .hint("rebalance", "_bucket").select(*_stored_table(spark, name, database).columns)
        )
    elif spec and spec.partition_by:
        rows = rows.hint("rebalance", *spec.partition_by)
    elif spec and spec.by_year_of:
        rows = (
            rows.withColumn("_year", F.year(spec.by_year_of)).hint("rebalance", "_year")
            .sortWithinPartitions(spec.by_year_of).drop("_year")
        )
    with settings(spark, **BRIEF_SHUFFLES):
        if spec and spec.by_batch:
            _into_batch(rows, name, database, batch)
        else:
            rows.write.insertInto(f"`{database}`.`{name}`")


def overwrite(rows: DataFrame, name: str, database: str = DATABASE) -> None:
    """Replace all rows of a table; columns go by position, the batch last."""
    with settings(rows.sparkSession, **{_OVERWRITE_MODE: "static"}, **BRIEF_SHUFFLES):
        rows.write.mode("overwrite").insertInto(f"`{database}`.`{name}`")


def drop_batch(spark: SparkSession, name: str, batch: str, database: str = DATABASE) -> None:
    """Take away what a batch has brought to a table."""
    spark.sql(
        f"ALTER TABLE `{database}`.`{name}` DROP IF EXISTS PARTITION ({BATCH} = {_quoted(batch)})"
    )


def any_of(column: str, values: Iterable[int | None]) -> Column:
    """`column IN values` where None stands for IS NULL, fit for partition pruning."""
    values = set(values)
    known = sorted(value for value in values if value is not None)
    tests = [F.col(column).isin(known)] if known else []
    if None in values:
        tests.append(F.col(column).isNull())
    return reduce(or_, tests, F.lit(False)) if len(tests) != 1 else tests[0]


def merge_into(
    source: DataFrame,
    name: str,
    keys: Sequence[str],
    value: str,
    *,
    database: str = DATABASE,
    partitions: Iterable[int | None] | None = None,
    null_safe: bool = False,
    on_update: Mapping[str, Column] | None = None,
    on_insert: Mapping[str, Column] | None = None,
    combine: Combine = replace,
    size: int | None = None,
) -> dict[str, int]:
    """Upsert `source` into a partitioned table; returns rows updated and inserted (K2).

    In a bucketed table only the batch is moved: it is dealt to the buckets of its keys. Only if
    the rows are too many for a task to sort a bucket of them, they are shuffled to more
    partitions. `size` is how many rows the source has at most; they are counted if it is not
    given. In another table, the source is written first: its size is then known, so a small one
    is broadcast and the table's rows stay where they are, and it is computed once for both joins.

    `partitions` lists the partition values the source touches, when the caller knows
    them, so that the others are not read. The merged rows are staged, because Spark refuses
    to overwrite what it reads, and only partitions with a changed row are replaced from there.
    Running the same merge again changes nothing.

    Replacing is not one transaction: after a failure in between, the staged rows are still
    there and the merge can be run again.
    """
    options = {
        "null_safe": null_safe, "on_update": on_update, "on_insert": on_insert,
        "combine": combine,
    }
    with merging(source, name, keys, value, None, database, partitions, options, size) as counts:
        return counts


@contextmanager
def merging(
    source: DataFrame, name: str, keys: Sequence[str], value: str, run: str | None,
    database: str, partitions: Iterable[int | None] | None = None, options: Mapping | None = None,
    size: int | None = None,
) -> Iterator[dict[str, int]]:
    """Merge as `merge_into` does, and keep the staged rows until the block has succeeded.

    With a `run` name, a merge that was staged before and not finished is taken up again from
    its staged rows, whatever `source` is by now, and replaces the same partitions by the same rows.
    """
    if not TABLES[name].partition_by:
        raise ValueError(f"table '{name}' has no partition column to merge by")
    spark = source.sparkSession
    target = _stored_table(spark, name, database)
    split_by = TABLES[name].partition_by[0]
    buckets = _bucket_count(spark, name, database)
    stage = staged_merge(name, run or uuid.uuid4().hex)
    with settings(spark, **_BUCKETED, **BRIEF_SHUFFLES):
        if not spark.catalog.tableExists(f"`{database}`.`{stage}`"):
            touched = target if partitions is None else target.filter(
                any_of(split_by, partitions)
            )
            rows = source.select(*keys, value)
            path = staging_path(spark, name)
            if buckets:
                held = touched.count() + (rows.count() if size is None else size)
                merged = tag_merge_bucketed(
                    touched, rows, keys, value, KEY_HASH, buckets,
                    parts=_parts(held, buckets), **(options or {}),
                )
                (
                    merged.write.partitionBy(split_by).bucketBy(buckets, KEY_HASH)
                    .sortBy(KEY_HASH).option("path", path).option("compression", _COMPRESSION)
                    .saveAsTable(f"`{database}`.`{stage}`")
                )
            else:
                with staged(rows, f"{name}-batch") as batch:
                    merged = tag_merge(touched, batch, keys, value, **(options or {}))
                    # AQE cuts a partition value that holds much data into several files.
                    (
                        merged.hint("rebalance", split_by).write.partitionBy(split_by)
                        .option("path", path).option("compression", _COMPRESSION)
                        .saveAsTable(f"`{database}`.`{stage}`")
                    )
        counts = _replace_changed(
            _stored_table(spark, stage, database), target.columns, name, database, split_by,
            buckets,
        )
        yield {
            action: sum(row["count"] for row in counts if row[ACTION] == action)
            for action in (UPDATED, INSERTED)
        }
        path = spark.sql(f"DESCRIBE FORMATTED `{database}`.`{stage}`").filter(
            "col_name = 'Location'"
        ).first()["data_type"]
        spark.sql(f"DROP TABLE `{database}`.`{stage}`")
        remove(spark, path)


def staged_merge(name: str, run: str) -> str:
    """The table of a run's staged rows; a run's name is in it by its letters' numbers."""
    return f"{OWN}{name}_{run.encode().hex()}"


def unfinished_merges(spark: SparkSession, name: str, database: str = DATABASE) -> list[str]:
    """Names of the runs whose merge into the table is staged and not finished."""
    start = f"{OWN}{name}_"
    return sorted(
        bytes.fromhex(entry.name.removeprefix(start)).decode()
        for entry in spark.catalog.listTables(database)
        if not entry.isTemporary and entry.name.startswith(start)
    )


def _replace_changed(
    rows: DataFrame, columns: list[str], name: str, database: str, split_by: str, buckets: int
) -> list[Row]:
    """Replace the partitions with a changed row; returns the changes per partition."""
    found = rows.groupBy(split_by, ACTION).count().collect()
    counts = [row for row in found if row[ACTION] != KEPT]
    changed = {row[split_by] for row in counts}
    if changed:
        outgrown = buckets and _parts(sum(row["count"] for row in found), buckets) > 1
        scan = _BY_FILES if outgrown else {}
        with settings(rows.sparkSession, **{_OVERWRITE_MODE: "dynamic"}, **scan):
            (
                rows.filter(any_of(split_by, changed))
                .select(*columns)
                .write.mode("overwrite")
                .insertInto(f"`{database}`.`{name}`")
            )
    return counts
