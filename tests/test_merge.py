from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from conftest import final_plan
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from saleslake.operators.merge import merge_upsert, tag_merge

KEYS = ("year", "name")
SCHEMA = "year int, name string, total decimal(20,2), note string"
SOURCE = "year int, name string, total decimal(20,2)"


def _model(target, source, null_safe):
    """The merge row by row."""

    def same(a, b):
        return all(x == y if x is not None or null_safe else False for x, y in zip(a, b))

    out = []
    for *key, total, note in target:
        match = [row for row in source if same(key, row[:2])]
        if match and total is not None and match[0][2] is not None and match[0][2] != total:
            out.append((*key, match[0][2], note, "updated"))
        else:
            out.append((*key, total, note, "kept"))
    for *key, total in source:
        if not any(same(key, row[:2]) for row in target):
            out.append((*key, total, None, "inserted"))
    return sorted(out, key=str)


keys = st.tuples(st.sampled_from([2015, 2016, None]), st.sampled_from(["a", "b", "", None]))
totals = st.none() | st.integers(0, 2).map(Decimal)
targets = st.lists(st.tuples(keys, totals), max_size=12).map(
    lambda rows: [(*key, total, f"row {i}") for i, (key, total) in enumerate(rows)]
)
sources = st.dictionaries(keys, totals, max_size=8).map(
    lambda rows: [(*key, total) for key, total in rows.items()]
)


@pytest.mark.parametrize("null_safe", [False, True])
@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(target=targets, source=sources)
def test_same_as_row_by_row(spark, null_safe, target, source):
    """Target keys may repeat: every matching row is updated."""
    merged = tag_merge(
        spark.createDataFrame(target, SCHEMA), spark.createDataFrame(source, SOURCE),
        KEYS, "total", null_safe=null_safe,
    )
    assert sorted(map(tuple, merged.collect()), key=str) == _model(target, source, null_safe)


def test_merging_again_changes_nothing(spark):
    target = spark.createDataFrame([(2015, "a", Decimal(1), "x"), (None, "b", Decimal(2), "y")],
                                   SCHEMA)
    source = spark.createDataFrame(
        [(2015, "a", Decimal(5)), (None, "b", Decimal(6)), (2016, None, Decimal(7))], SOURCE
    )
    once = merge_upsert(target, source, KEYS, "total", null_safe=True)
    again = tag_merge(once, source, KEYS, "total", null_safe=True)
    assert {row.merge_action for row in again.collect()} == {"kept"}
    assert sorted(map(tuple, again.drop("merge_action").collect()), key=str) == sorted(
        map(tuple, once.collect()), key=str
    )
    assert once.columns == target.columns and once.dtypes == target.dtypes


def test_null_keys_are_inserted_again_under_equality(spark):
    target = spark.createDataFrame([(None, "b", Decimal(2), "y")], SCHEMA)
    source = spark.createDataFrame([(None, "b", Decimal(2))], SOURCE)
    out = tag_merge(target, source, KEYS, "total").collect()
    assert sorted(row.merge_action for row in out) == ["inserted", "kept"]


@pytest.mark.parametrize("key", [(2015, "a"), (2020, "new"), (None, "b")])
@pytest.mark.parametrize("null_safe", [False, True])
def test_duplicate_source_key_is_refused(spark, key, null_safe):
    target = spark.createDataFrame([(2015, "a", Decimal(1), "x")], SCHEMA)
    source = spark.createDataFrame([(*key, Decimal(5)), (*key, Decimal(5))], SOURCE)
    merged = tag_merge(target, source, KEYS, "total", null_safe=null_safe)
    with pytest.raises(Exception, match="more than one row for a key"):
        merged.collect()


def test_further_columns_are_set_on_request(spark):
    target = spark.createDataFrame(
        [(2015, "a", Decimal(1), "x"), (2015, "b", Decimal(1), "y")], SCHEMA
    )
    source = spark.createDataFrame(
        [(2015, "a", Decimal(5)), (2015, "b", Decimal(1)), (2016, "a", Decimal(7))], SOURCE
    )
    out = merge_upsert(
        target, source, KEYS, "total",
        on_update={"note": F.lit("changed")}, on_insert={"note": F.lit("new")},
    )
    assert {(r.year, r.name, r.note) for r in out.collect()} == {
        (2015, "a", "changed"), (2015, "b", "y"), (2016, "a", "new")
    }


def test_hot_target_key_is_split(spark, conf):
    """Copies of one target key are updated by several tasks, and none is lost."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="40KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
    )
    target = spark.range(60_000, numPartitions=6).selectExpr(
        "2015 AS year", "if(id % 3 < 2, 'hot', concat('n', id)) AS name",
        "cast(0 AS decimal(20,2)) AS total", "cast(id AS string) AS note",
    )
    source = spark.createDataFrame([(2015, "hot", Decimal(9)), (2016, "x", Decimal(1))], SOURCE)
    merged = tag_merge(target, source, KEYS, "total", null_safe=True)
    assert "skew=true" in final_plan(merged)
    counts = {row.merge_action: row["count"] for row in
              merged.groupBy("merge_action").count().collect()}
    assert counts == {"updated": 40_000, "kept": 20_000, "inserted": 1}


def _stored_pair(spark, folder, rows_in_source):
    spark.range(2000).selectExpr(
        "2015 AS year", "concat('n', id) AS name", "cast(0 AS decimal(20,2)) AS total",
        "'x' AS note",
    ).write.parquet(f"{folder}/target")
    spark.range(rows_in_source).selectExpr(
        "2015 AS year", "concat('n', id * 3) AS name", "cast(9 AS decimal(20,2)) AS total",
    ).write.parquet(f"{folder}/source")
    return spark.read.parquet(f"{folder}/target"), spark.read.parquet(f"{folder}/source")


def _exchanges_above_target(merged):
    """For each scan of the target, the exchanges between it and its first join."""
    found = []

    def walk(node, above):
        name = node.nodeName()
        if name.startswith("Scan"):
            if node.relation().location().rootPaths().mkString(",").endswith("/target"):
                found.append(above)
            return
        above = 0 if "Join" in name else above + (name == "Exchange")
        children = node.children()
        for at in range(children.size()):
            walk(children.apply(at), above)

    walk(merged._jdf.queryExecution().executedPlan(), 0)
    return found


@pytest.mark.parametrize("null_safe", [False, True])
def test_small_stored_batch_moves_no_target_row(spark, conf, tmp_path, null_safe):
    conf(spark__sql__adaptive__enabled="false")
    target, source = _stored_pair(spark, tmp_path, 5)
    merged = tag_merge(target, source, KEYS, "total", null_safe=null_safe)
    assert _exchanges_above_target(merged) == [0, 0]


@pytest.mark.parametrize("null_safe", [False, True])
def test_large_batch_shuffles_rows_once_and_keys_once(spark, conf, tmp_path, null_safe):
    conf(spark__sql__adaptive__enabled="false", spark__sql__autoBroadcastJoinThreshold="-1")
    target, source = _stored_pair(spark, tmp_path, 900)
    merged = tag_merge(target, source, KEYS, "total", null_safe=null_safe)
    assert _exchanges_above_target(merged) == [1, 1]
    counts = {r.merge_action: r["count"] for r in merged.groupBy("merge_action").count().collect()}
    assert counts == {"updated": 667, "kept": 1333, "inserted": 233}


def test_day_values_keep_their_type(spark):
    target = spark.createDataFrame([(1, dt.date(2020, 1, 1))], "k int, d date")
    source = spark.createDataFrame([(1, dt.date(2021, 1, 1))], "k long, d date")
    assert merge_upsert(target, source, ["k"], "d").first() == (1, dt.date(2021, 1, 1))
