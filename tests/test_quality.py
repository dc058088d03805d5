from __future__ import annotations

import datetime as dt

import pytest

from saleslake.functions import quality
from saleslake.functions.quality import (
    RELAXED_DATE_FORMAT,
    RELAXED_DATE_SHAPE,
    ParseDate,
    RequireMatch,
    Strip,
    apply_rules,
    cleanse,
    customer_rules,
    order_rules,
    product_rules,
)
from saleslake.queries import inputs

ORDERS = "order_id string, customer_id string, product_id string, order_date string, ship_date string"
CUSTOMERS = "customer_id string, customer_name string, email string, phone string, postal_code string"
GOOD = ("ZK-2031-700004", "QX-40417", "SEA-TK-73310052", "28/02/2031", "05/03/2031")


def test_valid_order_is_kept_with_dates(spark):
    out = cleanse(spark.createDataFrame([GOOD], ORDERS), "raw_orders").collect()
    assert [(row.order_date, row.ship_date) for row in out] == [
        (dt.date(2031, 2, 28), dt.date(2031, 3, 5))
    ]


@pytest.mark.parametrize("at", [0, 1, 2])
@pytest.mark.parametrize("bad", ["no id", None, "", "zk-2031-700004", "ZK-2031-7000041"])
def test_order_with_a_bad_id_is_dropped(spark, at, bad):
    row = list(GOOD)
    row[at] = bad
    assert cleanse(spark.createDataFrame([tuple(row)], ORDERS), "raw_orders").collect() == []


def test_customers(spark):
    rows = [
        ("QX-404", "Ida", "ida@north.example", "555.010.0199", "90210"),
        ("QX-40417", "Ida Lund", "ida.lund+shop@north.example", "(555) 010-0199", "90210-0001"),
        ("QX-40418", "Olu\tAde", "olu@a.b.example", "+15550100199", "00501"),
        ("QX-40419", "R2-D2 & Co.", "r2@d2", "0199", "90210-1"),
    ]
    out = cleanse(spark.createDataFrame(rows, CUSTOMERS), "raw_customers").collect()
    assert sorted(tuple(row) for row in out) == [
        rows[1], rows[2], ("QX-40419", "RD  Co", None, None, None)
    ]


def _one(spark, table, schema, row, column):
    return cleanse(spark.createDataFrame([row], schema), table).first()[column]


@pytest.mark.parametrize(
    ("phone", "kept"),
    [
        ("1234567890", True), ("(123) 456-7890", True), ("123.456.7890", True),
        ("+11234567890", True), ("+1(123)456-7890", True), ("+1 123-456-7890", True),
        ("421.580.0902x9815", False), ("#ERROR!", False), ("12345", False), (None, False),
    ],
)
def test_phone(spark, phone, kept):
    row = ("QX-40417", "A", None, phone, None)
    assert _one(spark, "raw_customers", CUSTOMERS, row, "phone") == (phone if kept else None)


@pytest.mark.parametrize(
    ("code", "kept"),
    [("12345", True), ("12345-6789", True), ("1234", False), ("12345.0", False), (None, False)],
)
def test_postal_code(spark, code, kept):
    row = ("QX-40417", "A", None, None, code)
    assert _one(spark, "raw_customers", CUSTOMERS, row, "postal_code") == (code if kept else None)


def test_names(spark):
    name = "O'Brien José-3"
    row = ("QX-40417", name, None, None, None)
    assert _one(spark, "raw_customers", CUSTOMERS, row, "customer_name") == "OBrien Jos"
    schema = "product_id string, product_name string"
    assert _one(
        spark, "raw_products", schema, ("SEA-TK-73310052", name), "product_name"
    ) == "O'Brien Jos-3"


def test_valid_products_are_unchanged(spark):
    rows = [("SEA-TK-73310052", "Teak seat 2.0"), ("INK-PD-61200847", "~Pad/ink (blue)")]
    df = spark.createDataFrame(rows, "product_id string, product_name string")
    assert [tuple(row) for row in cleanse(df, "raw_products").collect()] == rows


@pytest.mark.parametrize(
    ("text", "default", "month_first", "relaxed"),
    [
        ("30/09/2018", dt.date(2018, 9, 30), None, dt.date(2018, 9, 30)),
        ("10/11/2016", dt.date(2016, 11, 10), dt.date(2016, 10, 11), dt.date(2016, 11, 10)),
        ("4/12/2018", None, None, dt.date(2018, 12, 4)),
        ("31/02/2016", None, None, None),
        ("2018-09-30", None, None, None),
        (" 30/09/2018", None, None, None),
        ("", None, None, None),
        (None, None, None, None),
    ],
)
def test_dates(spark, text, default, month_first, relaxed):
    df = spark.createDataFrame([(text,)], "d string")
    rules = (
        ParseDate("d"),
        ParseDate("d", "MM/dd/yyyy"),
        ParseDate("d", RELAXED_DATE_FORMAT, RELAXED_DATE_SHAPE),
    )
    got = tuple(apply_rules(df, [rule]).first().d for rule in rules)
    assert got == (default, month_first, relaxed)


def test_order_rules_take_another_format(spark):
    df = spark.createDataFrame([(*GOOD[:3], "4/12/2018", "5/12/2018")], ORDERS)
    out = cleanse(df, "raw_orders", order_rules(RELAXED_DATE_FORMAT, RELAXED_DATE_SHAPE)).first()
    assert (out.order_date, out.ship_date) == (dt.date(2018, 12, 4), dt.date(2018, 12, 5))


def test_unknown_table_is_refused(spark):
    with pytest.raises(ValueError, match="raw_customer'"):
        cleanse(spark.createDataFrame([(1,)], "a int"), "raw_customer")


def test_two_rewrites_of_a_column_are_refused(spark):
    df = spark.createDataFrame([("a",)], "a string")
    with pytest.raises(ValueError, match="more than one"):
        apply_rules(df, [Strip("a", "x"), Strip("a", "y")])


def test_rule_subsets_and_empty_input(spark):
    df = spark.createDataFrame([("x1", "y")], "a string, b string")
    assert apply_rules(df, [RequireMatch("a", "^y")]).count() == 0
    assert apply_rules(df, [Strip("a", r"\d")]).first().a == "x"
    assert apply_rules(df, []).collect() == df.collect()
    assert apply_rules(df.limit(0), [Strip("a", r"\d")]).count() == 0


def test_wider_ids_by_rule(spark):
    """Query inputs have longer ids for large keys; none of their rows is lost."""
    keys = spark.createDataFrame(
        [(key,) for key in (0, 67_599_999, 67_600_000, 15_000_000_000)], "key long"
    )
    wide = keys.selectExpr(
        "key", f"{inputs.customer_code('key', wide=True)} AS customer_id",
        "'A' AS customer_name", "'' AS email", "'' AS phone", "'' AS postal_code",
    )
    kept = cleanse(wide, "raw_customers", customer_rules(inputs.WIDE_CUSTOMER_ID))
    assert kept.select("customer_id").distinct().count() == 4
    short = keys.selectExpr(f"{inputs.customer_code('key')} AS customer_id",
                            "'A' AS customer_name", "'' AS email", "'' AS phone",
                            "'' AS postal_code")
    assert cleanse(short, "raw_customers").count() == 4
    parts = keys.selectExpr(
        f"{inputs.product_code('key * 10', wide=True)} AS product_id", "'P' AS product_name"
    )
    assert cleanse(parts, "raw_products", product_rules(inputs.WIDE_PRODUCT_ID)).select(
        "product_id"
    ).distinct().count() == 4


def test_judged_rows_split_into_kept_and_rejected(spark):
    rows = [(1, "CA-2016-000001", "QX-40417", "SEA-TK-73310052", "30/09/2018"),
            (2, "bad", "QX-40417", "SEA-TK-73310052", "31/02/2016"),
            (3, None, "x", None, None), (4, "CA-2016-000001", "QX-40417", "SEA-TK-73310052", "x")]
    raw = spark.createDataFrame(
        [(*row, row[-1]) for row in rows],
        "row_id int, order_id string, customer_id string, product_id string, order_date string,"
        " ship_date string",
    )
    judged = quality.judge_rows(raw, quality.RULES["raw_orders"])
    kept = quality.accepted_rows(judged)
    assert kept.schema == quality.cleanse(raw, "raw_orders").schema
    assert sorted(kept.collect()) == sorted(quality.cleanse(raw, "raw_orders").collect())
    rejected = {row.row_id: row for row in quality.rejected_rows(judged).collect()}
    assert {k: row.failed_rules for k, row in rejected.items()} == {
        2: ["order_id does not match"],
        3: ["order_id does not match", "customer_id does not match", "product_id does not match"],
    }
    assert rejected[2].order_date == "31/02/2016"
    assert len(rejected) + kept.count() == len(rows)
    none = quality.judge_rows(raw, [])
    assert quality.accepted_rows(none).count() == 4 and quality.rejected_rows(none).count() == 0
