"""What queries write and how their tables are cut, on tables of the tests' own."""

from __future__ import annotations

import datetime as dt
import gzip
from pathlib import Path

import pytest

from saleslake.operators.enrich import enrich, unmatched
from saleslake.plans import catalog, pipeline, staging
from saleslake.queries import inputs, registry

LINES = 200


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    ids = spark.range(LINES)
    frames = {
        "region": spark.range(1).selectExpr("id AS r_regionkey", "'here' AS r_name"),
        "nation": spark.range(1).selectExpr(
            "id AS n_nationkey", "'land' AS n_name", "0L AS n_regionkey"
        ),
        "customer": spark.range(1, 51).selectExpr(
            "id AS c_custkey", "concat('Customer#', id) AS c_name", "'m' AS c_mktsegment",
            "0L AS c_nationkey",
        ),
        "part": spark.range(1, 21).selectExpr(
            "id AS p_partkey", "concat('t', id % 5) AS p_type", "concat('b', id) AS p_brand",
            "concat('p', id) AS p_name", "1.5D AS p_retailprice",
        ),
        "orders": ids.selectExpr(
            "id AS o_orderkey", "timestamp'1998-01-01' + make_interval(0, 0, 0, cast(id AS int))"
            " AS o_orderdate", "'1-URGENT' AS o_orderpriority", "1 + id % 50 AS o_custkey",
        ),
        "lineitem": ids.selectExpr(
            "id AS l_orderkey", "1 AS l_linenumber", "1 + id % 20 AS l_partkey",
            "1 + id % 9 AS l_suppkey", "2D AS l_quantity", "cast(100 + id AS double) AS"
            " l_extendedprice", "0.5D AS l_discount", "timestamp'1998-06-01' AS l_shipdate",
        ),
    }
    for name, frame in frames.items():
        frame.coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", ["json_scan", "json_broken_records"])
def test_lines_are_written_compressed_in_bounded_files(
    spark, tables, tmp_path, monkeypatch, name
):
    monkeypatch.setattr(registry, "FILE_RECORDS", 64, raising=False)
    monkeypatch.setattr(
        registry, "new_folder", lambda spark, purpose: str(tmp_path / "lines")
    )
    rows = getattr(registry, name)(spark, tables)
    assert rows.count() == LINES
    files = [path for path in (tmp_path / "lines").iterdir() if path.name.startswith("part-")]
    assert {path.suffix for path in files} == {".gz"}
    lines = [len(gzip.decompress(path.read_bytes()).splitlines()) for path in files]
    assert sum(lines) == LINES and max(lines) <= 64
    text = sum(len(gzip.decompress(path.read_bytes())) for path in files)
    assert sum(path.stat().st_size for path in files) < text / 3


@pytest.mark.parametrize("name", ["merge_table", "report_pack", "full_run"])
def test_a_summary_has_buckets_for_its_rows(spark, tables, monkeypatch, name):
    monkeypatch.setattr(catalog, "BUCKET_ROWS", 10, raising=False)
    made, database = [], registry._database

    def noted(*args):
        made.append(database(*args))
        return made[-1]

    monkeypatch.setattr(registry, "_database", noted)
    assert getattr(registry, name)(spark, tables).count()
    assert catalog._bucket_count(spark, "sales_summary", made[0]) >= LINES // 10


def test_a_run_writes_between_its_joins_and_drops_what_is_read(spark, tables, monkeypatch):
    joins, held, staged = {}, {}, staging.staged

    def folders():
        return set(Path(staging.shared_folder(spark), staging.STAGING).glob("*"))

    before = folders()

    def noted(df, purpose, *args):
        held[purpose] = {path.name.rsplit("-", 1)[0] for path in folders() - before}
        joins[purpose] = df._jdf.queryExecution().optimizedPlan().toString().count("Join ")
        return staged(df, purpose, *args)

    monkeypatch.setattr(pipeline, "staged", noted)
    assert registry.full_run(spark, tables).count()
    assert joins["flagged-orders"] == joins["joined"] == 1
    judged = {"judged-customers", "judged-products", "judged-orders"}
    assert held["named-orders"] >= judged and not held["joined"] & judged
    assert not held["contributions"]


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def test_shuffle_files_go_with_the_write_that_made_them(spark, tmp_path, database, monkeypatch):
    seen, into = [], catalog._into_batch

    def noted(rows, *args):
        seen.append(rows.sparkSession.conf.get(CLEANUP))
        into(rows, *args)

    monkeypatch.setattr(catalog, "_into_batch", noted)
    before = spark.conf.get(CLEANUP, None)
    rows = spark.range(3).selectExpr("cast(id AS string) AS customer_id")
    catalog.append(rows, "customers", database, "b")
    assert seen == ["true"] and spark.conf.get(CLEANUP, None) == before
    files = catalog.table(spark, "customers", database).inputFiles()
    assert files and all(".zstd." in name for name in files)
    with staging.staged(rows, "rows") as held:
        assert all(".zstd." in name for name in held.inputFiles())


def test_rows_written_between_the_joins_change_nothing(spark, tables):
    orders = inputs.orders(spark, tables).unionByName(
        inputs.orders(spark, tables).limit(3).selectExpr(
            "* EXCEPT (customer_id, product_id)", "-1L AS customer_id", "NULL AS product_id"
        )
    )
    known = inputs.customers(spark, tables).filter("customer_id % 7 > 0")
    sides = orders, known.unionByName(known.limit(5)), inputs.products(spark, tables)
    calls = []

    def between(rows):
        calls.append(rows)
        return staging.stored(rows, "between")

    day = dt.date(2020, 1, 1)
    for run in (unmatched, lambda *args, **more: enrich(*args, as_of=day, **more)):
        rows = run(*sides)
        assert rows.exceptAll(run(*sides, between=between)).isEmpty()
        assert run(*sides, between=between).exceptAll(rows).isEmpty()
        assert not rows.isEmpty()
    assert len(calls) == 4
