from __future__ import annotations

import datetime as dt
from collections import defaultdict
from decimal import Decimal

from conftest import final_plan
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from saleslake.operators import summary
from saleslake.operators.summary import (
    REPORTS,
    profit_by_customer,
    profit_by_customer_year,
    profit_by_year,
    profit_by_year_category,
    summarize,
)

SALES = (
    "order_date date, product_category string, product_sub_category string,"
    " customer_name string, profit decimal(10,2)"
)
SUMMARY = (
    "year int, product_category string, product_sub_category string, customer_name string,"
    " total_profit decimal(20,2)"
)


def test_summary_groups_null_years_and_ignores_null_profit(spark):
    day = dt.date(2016, 10, 31)
    rows = [
        (day, "c", "s", "Ann", Decimal("1.10")),
        (dt.date(2016, 1, 1), "c", "s", "Ann", Decimal("-3.00")),
        (day, "c", "s", "Ann", None),
        (None, "c", "s", "Ann", Decimal("5.00")),
        (None, "c", "s", "Ann", Decimal("6.00")),
        (day, "c", "t", "Ann", None),
    ]
    out = summarize(spark.createDataFrame(rows, SALES))
    assert dict(out.dtypes)["total_profit"] == "decimal(20,2)"
    assert {tuple(row) for row in out.collect()} == {
        (2016, "c", "s", "Ann", Decimal("-1.90")),
        (None, "c", "s", "Ann", Decimal("11.00")),
        (2016, "c", "t", "Ann", None),
    }


ROWS = [
    (2017, "b", "s", "Bob", Decimal("1.00")),
    (2016, "b", "s", "Ann", Decimal("2.00")),
    (2016, "a", "t", "Bob", Decimal("4.00")),
    (None, "a", "t", "Ann", Decimal("8.00")),
    (2017, "b", "t", "Bob", Decimal("16.00")),
]


def test_reports_are_ordered(spark):
    summary = spark.createDataFrame(ROWS, SUMMARY)

    def rows(report):
        return [tuple(row) for row in report(summary).collect()]

    d = Decimal
    assert rows(profit_by_year) == [(None, d(8)), (2016, d(6)), (2017, d(17))]
    assert rows(profit_by_year_category) == [
        (None, "a", d(8)), (2016, "a", d(4)), (2016, "b", d(2)), (2017, "b", d(17))
    ]
    assert rows(profit_by_customer) == [("Ann", d(10)), ("Bob", d(21))]
    assert rows(profit_by_customer_year) == [
        ("Ann", None, d(8)), ("Ann", 2016, d(2)), ("Bob", 2016, d(4)), ("Bob", 2017, d(17))
    ]


money = st.none() | st.decimals("-99999", "99999", places=2)
row = st.tuples(
    st.none() | st.dates(dt.date(2014, 1, 1), dt.date(2016, 12, 31)),
    st.sampled_from("ab"), st.sampled_from("st"), st.sampled_from(["Ann", "Bob", None]), money,
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, max_size=30))
def test_summary_and_reports_add_up(spark, rows):
    expected = defaultdict(list)
    for date, category, sub, name, profit in rows:
        expected[(date and date.year, category, sub, name)].append(profit)
    summary = summarize(spark.createDataFrame(rows, SALES))

    def total(values):
        known = [value for value in values if value is not None]
        return sum(known) if known else None

    assert {tuple(r[:4]): r[4] for r in summary.collect()} == {
        key: total(values) for key, values in expected.items()
    }
    everything = total([r[4] for r in rows])
    for report in REPORTS.values():
        assert total([r[-1] for r in report(summary).collect()]) == everything


def test_hot_group_is_combined_before_the_shuffle(spark):
    """A group with a third of the rows reaches the shuffle as one row per map task."""
    sales = spark.range(30_000, numPartitions=6).selectExpr(
        "date'2016-01-01' AS order_date", "'c' AS product_category",
        "'s' AS product_sub_category", "if(id % 3 = 0, 'hot', concat('n', id % 50)) AS customer_name",
        "cast(1 AS decimal(10,2)) AS profit",
    )
    out = summarize(sales)
    plan = final_plan(out)
    assert plan.index("functions=[partial_sum") > plan.index("Exchange hashpartitioning")
    assert plan.count("Exchange") - plan.count("ReusedExchange") == 1
    assert max(row.total_profit for row in out.collect()) == 10_000


def test_places_follow_the_order_over_ranges(spark, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false",
         spark__sql__shuffle__partitions="6")
    rows = [(None if k % 9 == 0 else f"n{k * 37 % 100:03d}", k % 4 or None) for k in range(300)]
    df = spark.createDataFrame(rows, "name string, year int").repartition(5)
    got = summary.ranked(df, ["name", "year"]).collect()
    assert sorted(row.place for row in got) == list(range(1, 301))
    in_order = [(row.name, row.year) for row in sorted(got, key=lambda row: row.place)]
    low = lambda row: tuple((x is not None, x or 0) for x in row)
    assert in_order == sorted(rows, key=low)
    assert summary.ranked(df.limit(0), ["name"]).collect() == []
