from __future__ import annotations

import os
from pathlib import Path

import pytest

import __spark_entry__ as driver
from check_oracle import compare, duck
from saleslake.queries import oracle_sql, queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test data")


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


def test_every_query_has_its_sql():
    assert set(queries()) == set(oracle_sql())
    assert set(queries()) <= set(driver.queries())


@pytest.mark.parametrize("name", list(queries()))
def test_same_as_sql(spark, connection, name):
    assert compare(spark, connection, name, SF_DIR) == ""


def test_entry(spark):
    assert driver.entry(spark).columns == [
        "year", "product_category", "product_sub_category", "customer_name", "total_profit"
    ]


PYTHON = {"xlsx_scan"}


@pytest.mark.parametrize("name", [
    name for name in queries()
    if name not in {"merge_table", "append_batches", "catalog_tables", "report_pack",
                    "full_run"}
])
def test_only_workbooks_need_python(spark, name):
    plan = driver.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert ("Python" in plan or "MapInArrow" in plan) == (name in PYTHON)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
