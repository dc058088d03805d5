from __future__ import annotations

import uuid
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from saleslake.plans import catalog, staging
from saleslake.schemas import SUMMARY_KEYS, TABLES

SUMMARY = (
    "year int, product_category string, product_sub_category string, customer_name string,"
    " total_profit decimal(20,2)"
)
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def _summary(spark, *rows):
    return spark.createDataFrame(
        [(year, "c", "s", name, Decimal(total)) for year, name, total in rows], SUMMARY
    )


def _stored(spark, database):
    rows = catalog.table(spark, "sales_summary", database).collect()
    return {(row.year, row.customer_name, int(row.total_profit)) for row in rows}


def _files(folder: Path) -> set[str]:
    return {str(path) for path in folder.rglob("*.parquet")}


def _merge(source, database, **options):
    return catalog.merge_into(
        source, "sales_summary", SUMMARY_KEYS, "total_profit", database=database, **options
    )


def test_declared_tables_exist(spark, database):
    assert database in catalog.list_databases(spark)
    assert catalog.list_tables(spark, database) == [
        "customers", "products", "raw_customers", "raw_orders", "raw_products",
        "sales_summary", "transactions",
    ]
    for name, spec in TABLES.items():
        assert catalog.table(spark, name, database).schema == spec.schema


def test_creating_again_keeps_the_rows(spark, database):
    catalog.append(_summary(spark, (2016, "a", 1)), "sales_summary", database)
    catalog.create_database(spark, database)
    catalog.create_tables(spark, database)
    assert _stored(spark, database) == {(2016, "a", 1)}


def test_use_and_drop(spark, tmp_path):
    name = f"sales_{uuid.uuid4().hex}"
    catalog.create_database(spark, name, str(tmp_path / "db"))
    catalog.create_tables(spark, name)
    catalog.use_database(spark, name)
    try:
        assert spark.table("transactions").count() == 0
        spark.range(1).createOrReplaceTempView("a_view")
        assert "a_view" not in catalog.list_tables(spark, name)
    finally:
        catalog.use_database(spark, "default")
    catalog.drop_database(spark, name)
    catalog.drop_database(spark, name)
    assert name not in catalog.list_databases(spark)


def test_append_adds_and_conforms(spark, database):
    df = spark.createDataFrame([("p1", "2.345"), ("p2", "bad")],
                               "product_id string, price_per_product string")
    catalog.append(df, "products", database)
    catalog.append(df.limit(1), "products", database)
    rows = catalog.table(spark, "products", database).collect()
    assert sorted((row.product_id, row.price_per_product) for row in rows if row.product_id == "p1"
                  ) == [("p1", Decimal("2.35"))] * 2
    assert len(rows) == 3 and all(row.category is None for row in rows)


def test_append_never_creates_a_table(spark, database):
    with pytest.raises(AnalysisException, match="TABLE_OR_VIEW_NOT_FOUND"):
        catalog.append(spark.range(1), "product", database)
    assert "product" not in catalog.list_tables(spark, database)


def test_append_writes_few_files_per_partition(spark, database, tmp_path):
    rows = [(2010 + i % 3, f"n{i}", i) for i in range(300)]
    catalog.append(_summary(spark, *rows).repartition(8), "sales_summary", database)
    assert len(_stored(spark, database)) == 300
    assert len(_files(tmp_path / "db" / "sales_summary")) == 3


def test_merge_replaces_changed_partitions_only(spark, database, tmp_path):
    folder = tmp_path / "db" / "sales_summary"
    catalog.append(
        _summary(spark, (2015, "a", 1), (2016, "a", 2), (2016, "b", 3), (None, "a", 4)),
        "sales_summary", database,
    )
    before = _files(folder)
    spark.conf.set(OVERWRITE_MODE, "static")
    counts = _merge(
        _summary(spark, (2015, "a", 1), (2016, "a", 9), (2017, "c", 5), (None, "a", 7)),
        database, null_safe=True,
    )
    assert counts == {"updated": 2, "inserted": 1}
    assert _stored(spark, database) == {
        (2015, "a", 1), (2016, "a", 9), (2016, "b", 3), (2017, "c", 5), (None, "a", 7)
    }
    after = _files(folder)
    assert {path for path in before if "year=2015" in path} <= after
    assert not {path for path in before if "year=2016" in path} & after
    assert spark.conf.get(OVERWRITE_MODE) == "static"


def test_merging_again_writes_nothing(spark, database, tmp_path):
    source = _summary(spark, (2016, "a", 1), (None, "b", 2))
    assert _merge(source, database, null_safe=True) == {"updated": 0, "inserted": 2}
    before = _files(tmp_path / "db")
    assert _merge(source, database, null_safe=True) == {"updated": 0, "inserted": 0}
    assert _files(tmp_path / "db") == before


def test_merge_of_listed_partitions(spark, database):
    catalog.append(
        _summary(spark, (2015, "a", 1), (2016, "a", 2), (None, "a", 3)), "sales_summary", database
    )
    counts = _merge(
        _summary(spark, (2016, "a", 8), (None, "a", 3), (2017, "a", 4)), database,
        partitions=[2016, 2017, None], null_safe=True,
    )
    assert counts == {"updated": 1, "inserted": 1}
    assert _stored(spark, database) == {
        (2015, "a", 1), (2016, "a", 8), (2017, "a", 4), (None, "a", 3)
    }


def test_merge_under_equality_inserts_null_keys_again(spark, database):
    catalog.append(_summary(spark, (None, "a", 3)), "sales_summary", database)
    assert _merge(_summary(spark, (None, "a", 3)), database) == {"updated": 0, "inserted": 1}
    assert catalog.table(spark, "sales_summary", database).count() == 2


def test_failed_merge_leaves_the_table_alone(spark, database):
    catalog.append(_summary(spark, (2016, "a", 1)), "sales_summary", database)
    source = _summary(spark, (2016, "a", 5), (2016, "a", 6))
    with pytest.raises(Exception, match="more than one row"):
        _merge(source, database)
    assert _stored(spark, database) == {(2016, "a", 1)}


def test_merge_needs_a_partition_column(spark, database):
    with pytest.raises(ValueError, match="products"):
        catalog.merge_into(spark.range(1), "products", ["id"], "id", database=database)


def test_partition_filters_prune(spark, database):
    catalog.append(
        _summary(spark, (2015, "a", 1), (2016, "a", 2), (None, "a", 3)), "sales_summary", database
    )
    stored = catalog.table(spark, "sales_summary", database)
    for years, rows in (([2016], 1), ([2016, None], 2), ([None], 1), ([], 0)):
        assert stored.filter(catalog.any_of("year", years)).count() == rows
    plan = stored.filter(catalog.any_of("year", [2016, None]))._jdf.queryExecution()
    assert "PartitionFilters: [((year" in plan.executedPlan().toString()


def _staged_folders(spark):
    return set(Path(staging.shared_folder(spark), staging.STAGING).glob("*"))


def test_staging_is_in_the_shared_folder_and_removed(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    before = _staged_folders(spark)
    assert staging.shared_folder(spark) == shared
    assert staging.new_folder(spark, "x").startswith(shared + "/")
    df = spark.createDataFrame([(1, None), (2, "b")], "a int, b string")
    with staging.staged(df, "rows", ["a"]) as rows:
        assert sorted(rows.select("a", "b").collect()) == sorted(df.collect())
        assert rows.inputFiles()[0].startswith(f"file://{shared}/saleslake/staging/rows-")
    assert _staged_folders(spark) == before


def test_staging_survives_a_failure(spark):
    before = _staged_folders(spark)
    with pytest.raises(KeyError), staging.staged(spark.range(3), "kept"):
        raise KeyError
    (left,) = _staged_folders(spark) - before
    assert left.name.startswith("kept-")
    assert spark.read.parquet(str(left)).count() == 3


def test_files_of_transactions_hold_few_years(spark, database, tmp_path, conf):
    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
         spark__sql__shuffle__partitions="16")
    rows = spark.range(24_000, numPartitions=6).selectExpr(
        "cast(id AS int) AS row_id", "sha2(cast(id AS string), 256) AS order_id",
        "make_date(cast(2000 + id % 8 AS int), 1 + cast(id % 12 AS int), 1) AS order_date",
    )
    catalog.append(rows, "transactions", database)
    stored = catalog.table(spark, "transactions", database)
    assert stored.count() == 24_000
    years = stored.groupBy(F.input_file_name().alias("file")).agg(
        F.count_distinct(F.year("order_date")).alias("n"), F.max(F.year("order_date")).alias("y")
    ).collect()
    assert len(years) > 4
    assert max(row.n for row in years) <= 4


def test_shared_folder_is_required_on_a_cluster(spark):
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.shared_folder(Session())


def test_hot_year_is_split_over_files(spark, database, tmp_path, conf):
    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="50KB")
    rows = spark.range(60_000, numPartitions=6).selectExpr(
        "if(id % 3 = 0, 2016, cast(2000 + id % 10 AS int)) AS year", "'c' AS product_category",
        "'s' AS product_sub_category", "sha2(cast(id AS string), 256) AS customer_name",
        "cast(id AS decimal(20,2)) AS total_profit",
    )
    catalog.append(rows, "sales_summary", database)
    assert catalog.table(spark, "sales_summary", database).count() == 60_000
    assert len(_files(tmp_path / "db" / "sales_summary" / "year=2016")) > 2
