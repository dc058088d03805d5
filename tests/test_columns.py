from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql.types import StructType

from saleslake.functions.columns import conform, standard_name, standardize_names, with_audit
from saleslake.schemas import ORDER_FILE_SCHEMA, TABLES

DAY = dt.date(2020, 1, 1)


def test_order_headers(spark):
    values = (7, "ZK-2031-700004", "02/03/2031", "9/3/2031", "Barge", "QX-40417",
              "SEA-TK-73310052", 12, 60.125, 0.05, 8.75)
    row = Row(**dict(zip(ORDER_FILE_SCHEMA.names, values, strict=True)))
    renamed = standardize_names(spark.createDataFrame([row]))
    assert renamed.columns == [
        "row_id", "order_id", "order_date", "ship_date", "ship_mode", "customer_id",
        "product_id", "quantity", "price", "discount", "profit",
    ]
    assert tuple(renamed.first()) == tuple(row)


def test_blanks_and_hyphens(spark):
    df = spark.createDataFrame([(1, 2)], [" Sub-Category ", "Price per product"])
    assert standardize_names(df).columns == ["subcategory", "price_per_product"]


def test_colliding_names_are_refused(spark):
    df = spark.createDataFrame([(1, 2)], ["Sub-Category", "SubCategory"])
    with pytest.raises(ValueError, match="subcategory"):
        standardize_names(df)


@given(st.text())
def test_renaming_twice_is_renaming_once(name):
    once = standard_name(name)
    assert "-" not in once and " " not in once
    # Deleting a hyphen can bare white space of other kinds, which only `strip` removes.
    twice = standard_name(once)
    assert standard_name(twice) == twice


def test_renaming_an_empty_frame(spark):
    df = spark.createDataFrame([], "`Order ID` string")
    out = with_audit(standardize_names(df), as_of=DAY)
    assert out.columns == ["order_id", "created_dt", "created_by"]
    assert out.count() == 0


def test_audit_stamps(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert with_audit(df, as_of=DAY).first() == Row(
        a=1, created_dt=DAY, created_by="system_user"
    )
    both = with_audit(df, as_of=DAY, user="me", updated=True).first()
    assert (both.updated_dt, both.updated_by) == (DAY, "me")
    today = with_audit(df).selectExpr("created_dt = current_date() AS same").first()
    assert today.same


def test_conform_orders_types_and_fills(spark):
    df = spark.createDataFrame(
        [("12.345", DAY, "x"), ("abc", DAY, None), ("123456789012.00", None, "y")],
        "price_per_product string, created_dt date, product_id string",
    )
    out = conform(df, TABLES["products"].schema)
    assert out.schema.names == TABLES["products"].schema.names
    assert [f.dataType for f in out.schema] == [f.dataType for f in TABLES["products"].schema]
    rows = {row.product_id: row for row in out.collect()}
    assert rows["x"].price_per_product == Decimal("12.35")
    assert rows["x"].created_dt == dt.datetime(2020, 1, 1)
    assert rows[None].price_per_product is None
    assert rows["y"].price_per_product is None
    assert rows["x"].category is None and rows["x"].updated_by is None


def test_conform_refuses_unknown_columns(spark):
    df = spark.createDataFrame([(1, 2)], "product_id int, surprise int")
    with pytest.raises(ValueError, match="surprise"):
        conform(df, TABLES["products"].schema)


def test_declared_schemas_are_nullable():
    for spec in TABLES.values():
        assert isinstance(spec.schema, StructType)
        assert all(field.nullable for field in spec.schema)
        assert set(spec.partition_by) <= set(spec.schema.names)
