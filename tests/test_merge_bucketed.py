"""Merging into a table that is bucketed by a hash of its keys."""

from __future__ import annotations

import uuid
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from pyspark.sql import functions as F

from saleslake.operators import merge
from saleslake.plans import catalog
from saleslake.schemas import KEY_HASH, SUMMARY_KEYS, TABLES
from test_merge import _model, sources, targets

SUMMARY = (
    "year int, product_category string, product_sub_category string, customer_name string,"
    " total_profit decimal(20,2)"
)
VALUES = "year int, name string, total decimal(20,2), note string"


@pytest.fixture
def bucketed(spark, tmp_path):
    """A database whose summary has buckets."""
    name = f"sales_{uuid.uuid4().hex}"
    catalog.create_database(spark, name, str(tmp_path / "db"))
    catalog.create_tables(spark, name, buckets=3)
    yield name
    catalog.drop_database(spark, name)


def _summary(spark, *rows):
    return spark.createDataFrame(
        [(year, "c", "s", name, Decimal(total)) for year, name, total in rows], SUMMARY
    )


def _merge(source, database, **options):
    return catalog.merge_into(
        source, "sales_summary", SUMMARY_KEYS, "total_profit", database=database, **options
    )


def _stored(spark, database):
    rows = catalog.table(spark, "sales_summary", database).collect()
    return sorted(((r.year, r.customer_name, int(r.total_profit)) for r in rows), key=str)


@pytest.mark.parametrize("null_safe", [False, True])
@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(target=targets, source=sources)
def test_same_as_row_by_row(spark, null_safe, target, source):
    """NULL keys, repeated target keys and NULL totals, as in the merge of any frame."""
    rows = spark.createDataFrame(target, VALUES)
    types = {f.name: f.dataType for f in rows.schema.fields}
    hashed = rows.withColumn(KEY_HASH, merge.key_hash(("year", "name"), types))
    merged = merge.tag_merge_bucketed(
        hashed, spark.createDataFrame(source, "year int, name string, total decimal(20,2)"),
        ("year", "name"), "total", KEY_HASH, 3, null_safe=null_safe,
    ).collect()
    ours = [(r.year, r.name, r.total, r.note, r.merge_action) for r in merged]
    assert sorted(ours, key=str) == _model(target, source, null_safe)
    assert all(r[KEY_HASH] is not None for r in merged)


def _exchanges(plan) -> list[int]:
    """For each scan of a stored table, the exchanges over it."""
    found = []

    def walk(node, over):
        name = node.nodeName()
        over += name in ("Exchange", "BroadcastExchange")
        if name.startswith("Scan parquet"):
            found.append(over)
        children = node.children()
        for at in range(children.size()):
            walk(children.apply(at), over)

    walk(plan, 0)
    return found


@pytest.mark.parametrize("null_safe", [False, True])
def test_a_large_batch_moves_no_target_row(spark, bucketed, conf, null_safe):
    conf(spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1",
         spark__sql__requireAllClusterKeysForCoPartition="false")
    old = spark.range(2000).selectExpr(
        "if(id % 7 = 0, null, 2015) AS year", "'c' AS product_category",
        "if(id % 5 = 0, null, 's') AS product_sub_category",
        "concat('n', id) AS customer_name", "cast(0 AS decimal(20,2)) AS total_profit",
    )
    catalog.append(old, "sales_summary", bucketed)
    new = old.filter("substr(customer_name, 2) % 3 = 0").withColumn(
        "total_profit", F.lit(9).cast("decimal(20,2)")
    )
    merged = merge.tag_merge_bucketed(
        spark.table(f"`{bucketed}`.sales_summary"), new, SUMMARY_KEYS, "total_profit",
        KEY_HASH, 3, null_safe=null_safe,
    )
    assert _exchanges(merged._jdf.queryExecution().executedPlan()) == [0]
    counts = {r.merge_action: r["count"] for r in merged.groupBy("merge_action").count().collect()}
    both = sum(1 for k in range(0, 2000, 3) if null_safe or (k % 7 and k % 5))
    expected = {"updated": both, "kept": 2000 - both, "inserted": 667 - both}
    assert counts == {action: n for action, n in expected.items() if n}


def test_table_is_merged_bucket_by_bucket(spark, bucketed, tmp_path):
    assert catalog.table(spark, "sales_summary", bucketed).schema == TABLES["sales_summary"].schema
    catalog.append(
        _summary(spark, (2015, "a", 1), (2016, "a", 2), (2016, "b", 3), (None, "a", 4)),
        "sales_summary", bucketed,
    )
    folder = tmp_path / "db" / "sales_summary"
    before = {str(path) for path in folder.rglob("*.parquet")}
    source = _summary(spark, (2015, "a", 1), (2016, "a", 9), (2017, "c", 5), (None, "a", 7))
    assert _merge(source, bucketed, null_safe=True) == {"updated": 2, "inserted": 1}
    assert _stored(spark, bucketed) == [
        (2015, "a", 1), (2016, "a", 9), (2016, "b", 3), (2017, "c", 5), (None, "a", 7)
    ]
    after = {str(path) for path in folder.rglob("*.parquet")}
    assert {path for path in before if "year=2015" in path} <= after
    assert not {path for path in before if "year=2016" in path} & after
    assert _merge(source, bucketed, null_safe=True) == {"updated": 0, "inserted": 0}
    assert {str(path) for path in folder.rglob("*.parquet")} == after
    # no bucket has more than a file in a year
    names = [(path.parent.name, path.name.rsplit("_", 1)[1]) for path in folder.rglob("*.parquet")]
    assert len(names) == len(set(names))
    assert catalog.list_tables(spark, bucketed) == sorted(TABLES)


def test_listed_partitions_and_changes(spark, bucketed):
    catalog.append(_summary(spark, (2015, "a", 1), (2016, "a", 2)), "sales_summary", bucketed)
    counts = _merge(
        _summary(spark, (2016, "a", 5), (2016, "b", -1)), bucketed,
        partitions=[2016], null_safe=True, combine=merge.add,
    )
    assert counts == {"updated": 1, "inserted": 1}
    assert _stored(spark, bucketed) == [(2015, "a", 1), (2016, "a", 7), (2016, "b", -1)]


def test_duplicate_source_keys_are_refused(spark, bucketed):
    catalog.append(_summary(spark, (2016, "a", 1)), "sales_summary", bucketed)
    for key in (2016, None):
        with pytest.raises(Exception, match="more than one row for a key"):
            _merge(_summary(spark, (key, "a", 5), (key, "a", 6)), bucketed)
    assert _stored(spark, bucketed) == [(2016, "a", 1)]


def test_a_named_append_replaces_the_batch(spark, bucketed):
    rows = spark.createDataFrame([("p1",), ("p2",)], "product_id string")
    catalog.append(rows, "products", bucketed)
    for batch in ("x", "it's", "x", "it's"):
        catalog.append(rows, "products", bucketed, batch)
    assert catalog.table(spark, "products", bucketed).count() == 6
    catalog.append(rows.limit(0), "products", bucketed, "x")
    assert catalog.table(spark, "products", bucketed, "x").count() == 0
    assert catalog.table(spark, "products", bucketed, "it's").count() == 2
    catalog.drop_batch(spark, "products", "it's", bucketed)
    assert catalog.table(spark, "products", bucketed).count() == 2
    with pytest.raises(ValueError, match="not filed by batch"):
        catalog.append(_summary(spark), "sales_summary", bucketed, "x")


def test_an_append_that_fails_half_way_can_be_repeated(spark, bucketed):
    """Between the files and their use nothing is left to do twice."""
    good = spark.range(100).selectExpr("concat('p', id) AS product_id")
    bad = good.withColumn(
        "product_name", F.when(F.col("product_id") == "p99", F.raise_error(F.lit("lost")))
    )
    catalog.append(good.limit(10), "products", bucketed, "x")
    for _ in range(2):
        with pytest.raises(Exception, match="lost"):
            catalog.append(bad, "products", bucketed, "x")
        catalog.append(good, "products", bucketed, "x")
        assert catalog.table(spark, "products", bucketed).count() == 100


def _wide(spark, rows, value):
    return spark.range(rows).selectExpr(
        "cast(2010 + id % 3 AS int) AS year", "'c' AS product_category",
        "'s' AS product_sub_category", "concat('n', id) AS customer_name",
        f"cast({value} AS decimal(20,2)) AS total_profit",
    )


def _largest(rows, part) -> int:
    return rows.groupBy(part).count().agg(F.max("count")).first()[0]


def test_buckets_that_have_outgrown_a_task_are_cut(spark, bucketed, tmp_path, monkeypatch):
    """Neither side of the merge, nor the copy, puts a whole bucket into one task."""
    monkeypatch.setattr(catalog, "BUCKET_ROWS", 100)
    catalog.append(_wide(spark, 3000, 1), "sales_summary", bucketed)
    largest, tag = [], catalog.tag_merge_bucketed

    def tagged(*args, **options):
        merged = tag(*args, **options)
        largest.append(_largest(merged, F.spark_partition_id()))
        return merged

    monkeypatch.setattr(catalog, "tag_merge_bucketed", tagged)
    source = _wide(spark, 4000, "if(id % 2 = 0, 1, 2)")
    assert _merge(source, bucketed, null_safe=True) == {"updated": 1500, "inserted": 1000}
    assert max(largest) <= 100  # of 4,000 rows in 3 buckets
    files = spark.read.parquet(str(tmp_path / "db" / "sales_summary"))
    # about 444 of a bucket's rows lie in a year
    assert _largest(files, F.col("_metadata.file_name")) <= 300
    rows = catalog.table(spark, "sales_summary", bucketed)
    assert rows.count() == 4000 == rows.select(*SUMMARY_KEYS).distinct().count()
    assert rows.agg(F.sum("total_profit")).first()[0] == 6000
    # the table is still read by its buckets
    monkeypatch.setattr(catalog, "BUCKET_ROWS", 100_000)
    assert _merge(source, bucketed, null_safe=True) == {"updated": 0, "inserted": 0}
    more = _wide(spark, 4001, 2)
    assert _merge(more, bucketed, null_safe=True) == {"updated": 2000, "inserted": 1}
    assert catalog.table(spark, "sales_summary", bucketed).count() == 4001


def test_buckets_grow_with_the_rows():
    assert catalog.buckets_for(0, 8) == catalog.buckets_for(4_000_000, 8) == 8
    assert catalog.buckets_for(200_000_000, 8) == 400
