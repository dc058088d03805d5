from __future__ import annotations

import datetime as dt
import json
import uuid
from decimal import Decimal
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from saleslake.plans import catalog, staging
from saleslake.plans.pipeline import (
    SalesFiles,
    _in_years,
    ingest,
    refresh_batch,
    refresh_summary,
    reports,
    run_pipeline,
)
from saleslake.operators.summary import summarize
from saleslake.queries.workbooks import workbook_bytes
from saleslake.schemas import COUNTS, CUSTOMER_FILE_SCHEMA, ORDER_FILE_SCHEMA

DAY = dt.date(2020, 1, 1)
KNOWN, OTHER = "QX-40417", "QX-40418"
CHAIR, PAPER = "SEA-TK-73310052", "INK-PD-61200847"


def _order(row_id, customer, product, date, profit):
    values = (row_id, f"CA-2016-{row_id:06d}", date, date, "Standard Class", customer, product,
              2, 10.5, 0.1, profit)
    return dict(zip(ORDER_FILE_SCHEMA.names, values, strict=True))


def _customer(key, name):
    return (key, name, "a@b.co", "123-456-7890", "1 Street", "Consumer", "Spain", "C", "S",
            "12345", "EU")


def _files(folder, customers, products, orders) -> SalesFiles:
    folder.mkdir()
    (folder / "Customer.xlsx").write_bytes(workbook_bytes(CUSTOMER_FILE_SCHEMA.names, customers))
    lines = ["Product ID,Category,Sub-Category,Product Name,State,Price per product", *products]
    (folder / "Product.csv").write_text("\n".join(lines) + "\n")
    (folder / "Order.json").write_text("".join(json.dumps(order) + "\n" for order in orders))
    return SalesFiles(*(str(folder / n) for n in ("Customer.xlsx", "Product.csv", "Order.json")))


CUSTOMERS = [_customer(KNOWN, "Ann-1"), _customer(OTHER, "Bob"), _customer("BAD", "X")]
PRODUCTS = [f"{CHAIR},Furniture,Chairs,Chair é,S,10.50", f"{PAPER},Office,Paper,Paper,S,oops",
            "BAD,Office,Paper,Paper,S,1"]


def _first_batch(folder):
    return _files(folder, CUSTOMERS, PRODUCTS, [
        _order(1, KNOWN, CHAIR, "31/10/2016", -6.4449),
        _order(2, KNOWN, CHAIR, "01/01/2016", 20),
        _order(3, OTHER, PAPER, "01/01/2017", 3),
        _order(4, OTHER, PAPER, "6/11/2016", 4),
        _order(5, "BAD", PAPER, "01/01/2017", 100),
        _order(6, "QX-99999", PAPER, "01/01/2017", 100),
        _order(7, OTHER, "BAD", "01/01/2017", 100),
    ])


def _summary(spark, database):
    rows = catalog.table(spark, "sales_summary", database).collect()
    return {
        (r.year, r.product_category, r.product_sub_category, r.customer_name, r.total_profit)
        for r in rows
    }


FIRST = {
    (2016, "Furniture", "Chairs", "Ann", Decimal("13.56")),
    (2017, "Office", "Paper", "Bob", Decimal("3.00")),
    (None, "Office", "Paper", "Bob", Decimal("4.00")),
}


def test_one_batch(spark, database, tmp_path):
    out = run_pipeline(spark, _first_batch(tmp_path / "in"), database, as_of=DAY)
    assert _summary(spark, database) == FIRST
    counts = {name: catalog.table(spark, name, database).count()
              for name in catalog.list_tables(spark, database)}
    assert counts == {
        "raw_customers": 3, "customers": 2, "raw_products": 3, "products": 2, "raw_orders": 7,
        "transactions": 4, "sales_summary": 3,
    }
    assert list(out) == ["profit_by_year", "profit_by_year_category", "profit_by_customer",
                         "profit_by_customer_year"]
    assert [tuple(row) for row in out["profit_by_year"].collect()] == [
        (None, Decimal("4.00")), (2016, Decimal("13.56")), (2017, Decimal("3.00"))
    ]
    first = catalog.table(spark, "transactions", database).filter("row_id = 1").first()
    assert (first.order_date, first.price, first.profit, first.country) == (
        dt.date(2016, 10, 31), Decimal("10.50"), Decimal("-6.44"), "Spain"
    )
    assert (first.created_dt, first.updated_by) == (dt.datetime(2020, 1, 1), "system_user")
    products = {r.product_id: r for r in catalog.table(spark, "products", database).collect()}
    assert products[CHAIR].product_name == "Chair "
    assert products[PAPER].price_per_product is None
    raw = catalog.table(spark, "raw_orders", database).filter("row_id = 4").first()
    assert (raw.order_date, raw.created_by) == ("6/11/2016", "system_user")
    left = Path(staging.shared_folder(spark), staging.STAGING).glob("raw_*")
    assert list(left) == []


def test_next_batch_adds_to_stored_totals(spark, database, tmp_path):
    run_pipeline(spark, _first_batch(tmp_path / "in"), database, as_of=DAY)
    more = _files(tmp_path / "more", CUSTOMERS, PRODUCTS, [
        _order(8, KNOWN, CHAIR, "05/05/2016", 1),
        _order(9, OTHER, CHAIR, "05/05/2018", 2),
        _order(10, OTHER, PAPER, "no date", 10),
    ])
    run_pipeline(spark, more, database, as_of=DAY)
    assert _summary(spark, database) == {
        (2016, "Furniture", "Chairs", "Ann", Decimal("14.56")),
        (2017, "Office", "Paper", "Bob", Decimal("3.00")),
        (2018, "Furniture", "Chairs", "Bob", Decimal("2.00")),
        (None, "Office", "Paper", "Bob", Decimal("14.00")),
    }
    whole = summarize(catalog.table(spark, "transactions", database))
    assert {tuple(row) for row in whole.collect()} == _summary(spark, database)


def test_batch_without_usable_orders(spark, database, tmp_path):
    files = _files(tmp_path / "in", CUSTOMERS, PRODUCTS, [_order(1, "BAD", CHAIR, "", 1)])
    out = run_pipeline(spark, files, database, as_of=DAY)
    assert _summary(spark, database) == set()
    assert all(report.collect() == [] for report in out.values())
    counts = {r.step: r.row_count for r in spark.table(f"{database}.{COUNTS.name}").collect()}
    assert (counts["orders_read"], counts["orders_kept"]) == (1, 0)
    assert counts["transactions_joined"] == 0


def test_refresh_again_changes_nothing(spark, database, tmp_path):
    run_pipeline(spark, _first_batch(tmp_path / "in"), database, as_of=DAY)
    assert refresh_summary(spark, database) == {"updated": 0, "inserted": 0}
    assert refresh_summary(spark, database, years=[2016, None]) == {"updated": 0, "inserted": 0}
    assert _summary(spark, database) == FIRST


def test_reports_read_the_stored_summary(spark, database, tmp_path):
    run_pipeline(spark, _first_batch(tmp_path / "in"), database, as_of=DAY)
    by_customer = reports(spark, database)["profit_by_customer"]
    assert [tuple(row) for row in by_customer.collect()] == [
        ("Ann", Decimal("13.56")), ("Bob", Decimal("7.00"))
    ]
    plan = by_customer._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<customer_name:string,total_profit:decimal(20,2)>" in plan


def test_year_filter_reaches_the_scan(spark, database):
    scan = catalog.table(spark, "transactions", database).filter(
        _in_years("order_date", [2016, None])
    )
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(order_date,2016-01-01)" in plan
    assert "LessThanOrEqual(order_date,2016-12-31)" in plan


def test_any_parsed_date_is_loaded(spark, database, tmp_path):
    files = _files(tmp_path / "in", CUSTOMERS, PRODUCTS, [
        _order(1, KNOWN, CHAIR, "01/01/0000", 1),
        _order(2, KNOWN, CHAIR, "31/12/9999", 2),
        _order(3, KNOWN, CHAIR, "29/02/2016", 3),
        *(_order(year, KNOWN, CHAIR, f"01/06/{year}", 1) for year in range(1990, 2020)),
    ])
    run_pipeline(spark, files, database, as_of=DAY)
    totals = {row[0]: row[4] for row in _summary(spark, database)}
    assert len(totals) == 32
    assert (totals[0], totals[9999], totals[2016]) == (Decimal(1), Decimal(2), Decimal(4))


def test_any_number_of_years(spark):
    days = spark.range(1000, 5000).selectExpr("make_date(cast(id AS int), 12, 31) AS d")
    found = days.filter(_in_years("d", range(0, 6000, 2)))
    assert found.count() == 2000
    assert days.filter(_in_years("d", [None])).count() == 0
    assert days.filter(_in_years("d", [])).count() == 0
    undated = spark.sql("SELECT cast(NULL AS date) AS d").unionByName(days)
    assert undated.filter(_in_years("d", [1000, None])).count() == 2
    assert undated.filter(_in_years("d", [1000])).count() == 1


@pytest.mark.parametrize("failing", ["raw_customers", "products", "transactions"])
def test_failed_batch_can_be_run_again(spark, database, tmp_path, monkeypatch, failing):
    files, append = _first_batch(tmp_path / "in"), catalog.append

    def broken(df, name, *rest):
        if name == failing:
            raise OSError("lost")
        append(df, name, *rest)

    monkeypatch.setattr(catalog, "append", broken)
    with pytest.raises(OSError, match="lost"):
        run_pipeline(spark, files, database, as_of=DAY, batch="first")
    monkeypatch.setattr(catalog, "append", append)
    for _ in range(2):
        run_pipeline(spark, files, database, as_of=DAY, batch="first")
        assert _summary(spark, database) == FIRST
        assert catalog.table(spark, "raw_orders", database).count() == 7
        assert catalog.table(spark, "customers", database).count() == 2
    run_pipeline(spark, files, database, as_of=DAY, batch="second")
    assert catalog.table(spark, "transactions", database).count() == 8


def test_orders_of_earlier_customers_are_kept(spark, database, tmp_path):
    run_pipeline(spark, _first_batch(tmp_path / "in"), database, as_of=DAY)
    more = _files(tmp_path / "more", CUSTOMERS[1:], PRODUCTS[2:], [
        _order(8, KNOWN, CHAIR, "05/05/2016", 1)
    ])
    run_pipeline(spark, more, database, as_of=DAY)
    assert _summary(spark, database) == {
        (2016, "Furniture", "Chairs", "Ann", Decimal("14.56")),
        *(row for row in FIRST if row[0] != 2016),
    }


def test_orders_join_the_latest_row_up_to_their_batch(spark, database, tmp_path):
    def run(batch, name, order):
        customers = [_customer(KNOWN, name)] if name else []
        files = _files(tmp_path / uuid.uuid4().hex, customers, PRODUCTS, [order])
        run_pipeline(spark, files, database, as_of=DAY, batch=batch)

    steps = [("a", "Ann", 1), ("b", "Bea", 2), ("c", None, 4), ("d", "Dee", 8)]
    for batch, name, profit in steps:
        run(batch, name, _order(profit, KNOWN, CHAIR, "01/01/2016", profit))
    expected = {("Ann", 1), ("Bea", 6), ("Dee", 8)}
    assert {(r[3], int(r[4])) for r in _summary(spark, database)} == expected
    # run again, an earlier batch does not see what came later
    run("c", None, _order(4, KNOWN, CHAIR, "01/01/2016", 4))
    assert {(r[3], int(r[4])) for r in _summary(spark, database)} == expected


def test_parked_orders_are_taken_up_once(spark, database, tmp_path):
    late, new = "QX-70001", "TOY-AB-00000001"
    orders = [_order(20, late, CHAIR, "01/01/2016", 1), _order(21, late, new, "01/01/2016", 2),
              _order(22, KNOWN, new, "01/01/2016", 4)]
    batches = {
        "orders": _files(tmp_path / "a", CUSTOMERS, PRODUCTS, orders),
        "customer": _files(tmp_path / "b", [_customer(late, "Lea")], PRODUCTS, []),
        "product": _files(tmp_path / "c", [_customer(late, "Lea")], [f"{new},Toys,Blocks,T,S,1"], []),
    }
    seen = []
    for batch in ("orders", "customer", "product", "orders", "customer"):
        run_pipeline(spark, batches[batch], database, as_of=DAY, batch=batch)
        rows = catalog.table(spark, "transactions", database).collect()
        seen.append(sorted((r.row_id, r.customer_name, r.product_category) for r in rows))
        assert sum(r[4] for r in _summary(spark, database)) == sum(r.profit for r in rows)
    assert seen[0] == []
    assert seen[1] == [(20, "Lea", "Furniture")]
    assert seen[2] == [(20, "Lea", "Furniture"), (21, "Lea", "Toys"), (22, "Ann", "Toys")]
    assert seen[3:] == [seen[2]] * 2


def test_failed_unnamed_run_leaves_no_rows(spark, database, tmp_path, monkeypatch):
    files, append = _first_batch(tmp_path / "in"), catalog.append

    def broken(df, name, *rest):
        append(df, name, *rest)
        if name == "transactions":
            raise OSError("lost")

    monkeypatch.setattr(catalog, "append", broken)
    with pytest.raises(OSError, match="lost"):
        run_pipeline(spark, files, database, as_of=DAY)
    monkeypatch.setattr(catalog, "append", append)
    for name in catalog.list_tables(spark, database):
        assert catalog.table(spark, name, database).count() == 0


@pytest.mark.parametrize("step", ["replace", "ledger", "drop"])
def test_a_refresh_that_failed_adds_nothing_twice(spark, database, tmp_path, monkeypatch, step):
    """Whether the totals were replaced or not, the next refresh of any batch finishes the work."""
    files = _first_batch(tmp_path / "in")
    patched = {"replace": (catalog, "_replace_changed"), "ledger": (catalog, "append"),
               "drop": (catalog, "remove")}[step]
    real = getattr(*patched)

    def broken(*args):
        if step == "replace":
            real(*args)
            raise OSError("lost")
        if step == "ledger" and args[1] != "engine_summary_ledger":
            return real(*args)
        if step == "drop":
            return None  # the files of the staged rows stay, as after a loss of the driver
        raise OSError("lost")

    monkeypatch.setattr(*patched, broken)
    if step == "drop":
        run_pipeline(spark, files, database, as_of=DAY, batch="first")
    else:
        with pytest.raises(OSError, match="lost"):
            run_pipeline(spark, files, database, as_of=DAY, batch="first")
        assert catalog.unfinished_merges(spark, "sales_summary", database) == ["first"]
    monkeypatch.setattr(*patched, real)
    none = _files(tmp_path / "none", CUSTOMERS, PRODUCTS, [])
    run_pipeline(spark, none, database, as_of=DAY, batch="it's \\ second")
    assert _summary(spark, database) == FIRST
    run_pipeline(spark, files, database, as_of=DAY, batch="first")
    assert _summary(spark, database) == FIRST
    assert catalog.unfinished_merges(spark, "sales_summary", database) == []


def test_a_batch_refresh_reads_its_own_transactions_only(spark, database, tmp_path):
    run_pipeline(spark, _first_batch(tmp_path / "in"), database, as_of=DAY, batch="first")
    for path in (tmp_path / "db" / "transactions" / "load_batch=first").glob("*.parquet"):
        path.write_bytes(b"not a file of rows")
    more = _files(tmp_path / "more", CUSTOMERS, PRODUCTS, [_order(8, KNOWN, CHAIR, "05/05/2016", 1)])
    run_pipeline(spark, more, database, as_of=DAY, batch="second")
    assert (2016, "Furniture", "Chairs", "Ann", Decimal("14.56")) in _summary(spark, database)


batch_rows = st.lists(
    st.tuples(st.sampled_from([None, "2015-01-01", "2016-05-05"]), st.sampled_from(["a", None]),
              st.integers(-3, 3)), max_size=4,
)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(steps=st.lists(st.tuples(st.sampled_from("xyz"), batch_rows), min_size=1, max_size=4))
def test_batches_add_up_to_a_full_refresh(spark, steps):
    """Any batches, loaded again with other rows too; keys that vanish count as zero."""
    name = f"sales_{uuid.uuid4().hex}"
    catalog.create_database(spark, name)
    catalog.create_tables(spark, name, buckets=3)
    try:
        for batch, rows in steps:
            df = spark.createDataFrame(rows, "order_date string, customer_name string, profit int")
            catalog.append(df, "transactions", name, batch)
            refresh_batch(spark, name, batch)
        whole = summarize(catalog.table(spark, "transactions", name)).collect()
        totals = {tuple(row)[:4]: row.total_profit for row in whole if row.total_profit}
        assert {r[:4]: r[4] for r in _summary(spark, name) if r[4]} == totals
        refresh_summary(spark, name)
        assert {r[:4]: r[4] for r in _summary(spark, name) if r[4]} == totals
        counts = refresh_batch(spark, name, steps[-1][0])
        assert counts == {"updated": 0, "inserted": 0}
    finally:
        catalog.drop_database(spark, name)


def test_rejected_rows_and_counts_are_kept(spark, database, tmp_path):
    run_pipeline(spark, _first_batch(tmp_path / "in"), database, as_of=DAY, batch="first")
    rejected = {
        name: sorted((row[0], *row.failed_rules) for row in
                     catalog.table(spark, f"engine_rejected_{name}", database).collect())
        for name in ("customers", "products", "orders")
    }
    assert rejected == {
        "customers": [("BAD", "customer_id does not match")],
        "products": [("BAD", "product_id does not match")],
        "orders": [(5, "customer_id does not match"), (7, "product_id does not match")],
    }
    counts = catalog.table(spark, "engine_load_counts", database, "first").collect()
    assert {row.step: row.row_count for row in counts} == {
        "customers_read": 3, "customers_kept": 2, "products_read": 3, "products_kept": 2,
        "orders_read": 7, "orders_kept": 5, "transactions_joined": 4,
    }


def test_ingest_stamps_and_renames(spark, tmp_path):
    files = _first_batch(tmp_path / "in")
    df = ingest(spark, "Product.csv", files.products, as_of=DAY, user="loader")
    assert df.columns == ["product_id", "category", "subcategory", "product_name", "state",
                          "price_per_product", "created_dt", "created_by"]
    assert {(row.created_dt, row.created_by) for row in df.collect()} == {(DAY, "loader")}
