from __future__ import annotations

import datetime as dt

import pytest
from conftest import final_plan
from pyspark.sql import functions as F

from saleslake.functions.columns import conform, with_audit
from saleslake.operators import enrich, join_customers, join_products
from saleslake.schemas import TABLES

DAY = dt.date(2020, 1, 1)


def _orders(spark, rows):
    return conform(
        spark.createDataFrame(rows, "row_id int, customer_id string, product_id string"),
        TABLES["raw_orders"].schema,
    )


def _customers(spark, rows):
    return conform(
        spark.createDataFrame(rows, "customer_id string, customer_name string"),
        TABLES["customers"].schema,
    )


def _products(spark, rows):
    return conform(
        spark.createDataFrame(rows, "product_id string, category string, subcategory string"),
        TABLES["products"].schema,
    )


def test_unmatched_orders_drop_and_duplicates_fan_out(spark):
    orders = _orders(spark, [(1, "a", "p"), (2, "a", "q"), (3, "z", "p"), (4, None, "p")])
    customers = _customers(spark, [("a", "Ann"), ("a", "Anna"), ("b", "Bob"), (None, "No")])
    products = _products(spark, [("p", "c", "s")])
    assert sorted(
        (r.row_id, r.customer_name) for r in join_customers(orders, customers).collect()
    ) == [(1, "Ann"), (1, "Anna"), (2, "Ann"), (2, "Anna")]
    assert sorted(r.row_id for r in join_products(orders, products).collect()) == [1, 3, 4]
    out = enrich(orders, customers, products, as_of=DAY)
    assert sorted((r.row_id, r.customer_name) for r in out.collect()) == [(1, "Ann"), (1, "Anna")]


def test_projection_and_audit(spark):
    stamped = [
        with_audit(frame, as_of=dt.date(2000, 1, 1), user="loader")
        for frame in (
            _orders(spark, [(1, "a", "p")]),
            _customers(spark, [("a", "Ann")]),
            _products(spark, [("p", "c", "s")]),
        )
    ]
    out = enrich(*stamped, as_of=DAY)
    assert out.columns == TABLES["transactions"].schema.names
    row = out.first()
    assert (row.product_category, row.product_sub_category) == ("c", "s")
    assert (row.created_dt, row.updated_dt) == (DAY, DAY)
    assert (row.created_by, row.updated_by) == ("system_user", "system_user")


def test_dimension_columns_are_pruned(spark, tmp_path):
    path = str(tmp_path / "customers")
    _customers(spark, [("a", "Ann")]).write.parquet(path)
    out = enrich(
        _orders(spark, [(1, "a", "p")]), spark.read.parquet(path),
        _products(spark, [("p", "c", "s")]),
    )
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<customer_id:string,customer_name:string,country:string>" in plan


@pytest.mark.parametrize("hot_side", ["customer", "product"])
def test_hot_key_is_split(spark, conf, hot_side):
    """One customer or product with most of the orders is joined by several tasks."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="40KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
    )
    hot, cold = "if(id % 3 < 2, 0, id % 200)", "id % 200"
    by_customer, by_product = (hot, cold) if hot_side == "customer" else (cold, hot)
    orders = conform(
        spark.range(60_000, numPartitions=6).selectExpr(
            "cast(id AS int) AS row_id",
            f"concat('c', {by_customer}) AS customer_id",
            f"concat('p', {by_product}) AS product_id",
        ),
        TABLES["raw_orders"].schema,
    )
    customers = conform(
        spark.range(200).selectExpr(
            "concat('c', id) AS customer_id", "concat('n', id) AS customer_name"
        ),
        TABLES["customers"].schema,
    )
    products = conform(
        spark.range(200).selectExpr("concat('p', id) AS product_id", "'c' AS category"),
        TABLES["products"].schema,
    )
    out = enrich(orders, customers, products, as_of=DAY).select(
        "row_id", "customer_name", "product_category"
    )
    assert "skew=true" in final_plan(out)
    assert out.select(F.countDistinct("row_id"), F.count("*")).first() == (60_000, 60_000)
