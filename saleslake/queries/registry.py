"""One runnable query per operator of the engine: `(spark, sf_dir) -> DataFrame`.

Queries that need files or tables derive them from the driver's tables first and write
them below the session's shared folder.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from saleslake.functions.columns import conform, standardize_names, with_audit
from saleslake.functions.quality import (
    ACCEPTED,
    RELAXED_DATE_FORMAT,
    RELAXED_DATE_SHAPE,
    RULES,
    ParseDate,
    RequireMatch,
    accepted_rows,
    apply_rules,
    cleanse,
    customer_rules,
    judge_rows,
    order_rules,
    product_rules,
    rejected_rows,
)
from saleslake.operators import enrich, join_customers, join_products, merge_upsert, summarize
from saleslake.operators.merge import tag_merge
from saleslake.operators.summary import REPORTS, all_reports, ranked
from saleslake.plans import catalog
from saleslake.plans.pipeline import BUCKETS, SalesFiles, ingest, refresh_summary, run_pipeline
from saleslake.plans.staging import (
    BRIEF_SHUFFLES,
    new_folder,
    observed_counts,
    settings,
    stored,
)
from saleslake.queries import inputs
from saleslake.queries.workbooks import write_workbooks
from saleslake.schemas import SUMMARY_KEYS, TABLES, SourceSpec
from saleslake.sources import read_source
from saleslake.sources.files import read_records

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = dt.date(2020, 1, 1)

#: Records of a compressed file, which one task reads whole: some 270 MB of order lines.
FILE_RECORDS = 1_000_000

#: Rules for queries that join by ids, whose number of digits grows with the data.
WIDE_RULES = {
    "raw_orders": order_rules(
        customer_id=inputs.WIDE_CUSTOMER_ID, product_id=inputs.WIDE_PRODUCT_ID
    ),
    "raw_customers": customer_rules(inputs.WIDE_CUSTOMER_ID),
    "raw_products": product_rules(inputs.WIDE_PRODUCT_ID),
}

_DATES = tuple(rule for rule in RULES["raw_orders"] if isinstance(rule, ParseDate))
_IDS = tuple(rule for rule in RULES["raw_orders"] if isinstance(rule, RequireMatch))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3 over clean inputs."""
    return enrich(
        inputs.orders(spark, sf_dir),
        inputs.customers(spark, sf_dir),
        inputs.products(spark, sf_dir),
        as_of=AS_OF,
    )


def sales_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 over T3: the flagship."""
    return summarize(transactions(spark, sf_dir))


def _report(name: str) -> Query:
    """A report over the summary as a temp view, scanned by name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        view = "sales_summary_" + re.sub(r"\W", "_", sf_dir)
        sales_summary(spark, sf_dir).createOrReplaceTempView(view)
        return REPORTS[name](spark.table(view))

    return run


def profit_by_customer_year_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report with each row's place in its order."""
    report = REPORTS["profit_by_customer_year"](sales_summary(spark, sf_dir))
    return ranked(report, ["customer_name", "year"])


def orders_with_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1."""
    return join_customers(
        inputs.orders(spark, sf_dir), inputs.customers(spark, sf_dir)
    ).select("row_id", "order_id", "customer_id", "customer_name", "country")


def orders_with_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2."""
    return join_products(
        inputs.orders(spark, sf_dir), inputs.products(spark, sf_dir)
    ).select("row_id", "order_id", "product_id", "category", "subcategory")


def _product_file(spark: SparkSession, sf_dir: str, wide: bool = False) -> DataFrame:
    return inputs.raw_products(spark, sf_dir, wide).toDF(*inputs.PRODUCT_HEADERS)


def _order_file(spark: SparkSession, sf_dir: str, wide: bool = False) -> DataFrame:
    return inputs.raw_orders(spark, sf_dir, wide).toDF(*inputs.ORDER_HEADERS)


def _customer_file(spark: SparkSession, sf_dir: str, wide: bool = False) -> DataFrame:
    return inputs.raw_customers(spark, sf_dir, wide).toDF(*inputs.CUSTOMER_HEADERS)


def _compressed(rows: DataFrame) -> DataFrameWriter:
    """A writer of files of lines that take a fraction of their text's size on disk."""
    return rows.write.option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS)


def standardized_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 on a products file's header."""
    return standardize_names(_product_file(spark, sf_dir))


def audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3."""
    return with_audit(inputs.products(spark, sf_dir), as_of=AS_OF)


def conform_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text to the declared types, misfits and missing columns to NULL."""
    texts = inputs.read(spark, sf_dir, "lineitem").selectExpr(
        "cast((l_orderkey * 8 + l_linenumber) % 2147483647 AS string) AS row_id",
        "cast(l_orderkey AS string) AS order_id",
        "CASE WHEN l_suppkey % 7 = 0 THEN 'n/a' ELSE cast(cast(l_quantity AS int) AS string)"
        " END AS quantity",
        "CASE WHEN l_suppkey % 5 = 0 THEN '123456789012.00'"
        " ELSE concat(cast(cast(l_extendedprice AS decimal(12,2)) AS string), '5') END AS price",
        "CASE WHEN l_suppkey % 3 = 0 THEN '' ELSE cast(cast(l_discount AS decimal(4,2)) AS"
        " string) END AS discount",
        "cast(l_shipdate AS date) AS ship_date",
        "cast(l_shipdate AS date) AS created_dt",
    )
    return conform(texts, TABLES["transactions"].schema)


def orders_valid_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1."""
    return apply_rules(inputs.raw_orders(spark, sf_dir), _IDS).select(
        "row_id", "order_id", "customer_id", "product_id"
    )


def _parsed_dates(rules) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return apply_rules(inputs.raw_orders(spark, sf_dir), rules).select(
            "row_id", "order_date", "ship_date"
        )

    return run


def _month_first(column: str) -> ParseDate:
    return ParseDate(column, "MM/dd/yyyy")


def _relaxed(column: str) -> ParseDate:
    return ParseDate(column, RELAXED_DATE_FORMAT, RELAXED_DATE_SHAPE)


def orders_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2 on orders: F1, C6, C7, F5."""
    return cleanse(inputs.raw_orders(spark, sf_dir), "raw_orders")


def customers_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2, C1, C3-C5, P5."""
    return cleanse(inputs.raw_customers(spark, sf_dir), "raw_customers")


def products_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3, C2."""
    return cleanse(inputs.raw_products(spark, sf_dir), "raw_products")


def _batch_summaries(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A stored earlier and a stored later summary by customer, whose ship dates overlap.

    Orders of one priority go without an order date, so both hold NULL-year groups.
    """
    dated = F.when(F.col("ship_mode") != "5-LOW", F.col("order_date"))
    sales = enrich(
        inputs.orders(spark, sf_dir).withColumn("order_date", dated),
        inputs.customers(spark, sf_dir),
        inputs.products(spark, sf_dir),
        as_of=AS_OF,
    )
    return (
        stored(
            summarize(sales.filter(F.col("ship_date") < dt.date(1999, 1, 1))), "earlier-summary"
        ),
        stored(
            summarize(sales.filter(F.col("ship_date") >= dt.date(1997, 1, 1))), "later-summary"
        ),
    )


def _merge(null_safe: bool) -> Query:
    """K2, J3, F4 as a plan, with the action taken for every row."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        earlier, later = _batch_summaries(spark, sf_dir)
        return tag_merge(earlier, later, SUMMARY_KEYS, "total_profit", null_safe=null_safe)

    return run


def merge_inserts_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: into a wider target, where inserted rows leave the audit columns NULL."""
    earlier, later = _batch_summaries(spark, sf_dir)
    target = conform(with_audit(earlier, as_of=AS_OF), TABLES["sales_summary"].schema)
    merged = merge_upsert(target, later, SUMMARY_KEYS, "total_profit", null_safe=True)
    return merged.select(*SUMMARY_KEYS, "total_profit", "created_by", "updated_by")


def _database(spark: SparkSession, purpose: str, rows: int = 0) -> str:
    """A new database of this call's own in the shared folder.

    It stays while the application runs, as the frames handed out read its tables. Its summary is
    made for so many rows.
    """
    name = f"saleslake_{purpose}_{uuid.uuid4().hex}"
    catalog.create_database(spark, name, new_folder(spark, purpose))
    catalog.create_tables(spark, name, buckets=catalog.buckets_for(rows, BUCKETS))
    return name


def merge_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 into the stored, year-partitioned summary."""
    earlier, later = _batch_summaries(spark, sf_dir)
    database = _database(spark, "merge", earlier.count() + later.count())
    catalog.append(earlier, "sales_summary", database)
    catalog.merge_into(
        later, "sales_summary", SUMMARY_KEYS, "total_profit", database=database, null_safe=True
    )
    return catalog.table(spark, "sales_summary", database).select(*SUMMARY_KEYS, "total_profit")


def append_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: two batches, split by whether the postal code survived cleansing."""
    database = _database(spark, "append")
    clean = customers_clean(spark, sf_dir)
    known = F.col("postal_code").isNotNull()
    for part in (clean.filter(known), clean.filter(~known)):
        catalog.append(with_audit(part, as_of=AS_OF), "customers", database)
    return catalog.table(spark, "customers", database).drop("created_dt", "updated_dt")


def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared tables with their row counts after loading raw and clean data."""
    database = _database(spark, "catalog")
    raw = {
        "raw_customers": inputs.raw_customers(spark, sf_dir),
        "raw_products": inputs.raw_products(spark, sf_dir),
        "raw_orders": inputs.raw_orders(spark, sf_dir),
    }
    for name, frame in raw.items():
        catalog.append(frame, name, database)
    for name in ("customers", "products"):
        clean = cleanse(catalog.table(spark, f"raw_{name}", database), f"raw_{name}")
        catalog.append(clean, name, database)
    counts = [
        catalog.table(spark, name, database)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("table_name"), "row_count")
        for name in catalog.list_tables(spark, database)
    ]
    return reduce(DataFrame.unionByName, counts)


def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read, kept by the rules, and joined, each observed while it is written."""
    counts, clean = {}, {}
    for name, read in _RAW.items():
        judged = judge_rows(read(spark, sf_dir, wide=True), WIDE_RULES[name])
        counts[name] = Observation()
        seen = judged.observe(
            counts[name], F.count(F.lit(1)).alias("read"), F.count_if(ACCEPTED).alias("valid")
        )
        clean[name] = stored(accepted_rows(seen), f"valid-{name}")
    counts["transactions"] = Observation()
    enrich(
        clean["raw_orders"], clean["raw_customers"], clean["raw_products"], as_of=AS_OF
    ).observe(counts["transactions"], F.count(F.lit(1)).alias("joined")).write.format(
        "noop"
    ).mode("overwrite").save()
    joined = observed_counts(counts.pop("transactions"), "joined")["joined"]
    raw = {name: observed_counts(seen, "read", "valid") for name, seen in counts.items()}
    steps = [
        ("orders_read", raw["raw_orders"]["read"]),
        *((f"{name}_valid", raw[f"raw_{name}"]["valid"])
          for name in ("orders", "customers", "products")),
        ("transactions", joined),
    ]
    return spark.createDataFrame(steps, "step string, row_count long")


def orders_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw orders that failed a rule, as they came, with the columns that failed."""
    judged = judge_rows(inputs.raw_orders(spark, sf_dir), RULES["raw_orders"])
    failed = F.array_join(F.transform("failed_rules", lambda x: F.split(x, " ")[0]), ",")
    return rejected_rows(judged).select(
        "row_id", "order_id", "customer_id", "product_id", "order_date", "ship_date",
        failed.alias("failed"),
    )


_RAW = {
    "raw_orders": inputs.raw_orders,
    "raw_customers": inputs.raw_customers,
    "raw_products": inputs.raw_products,
}


def _all_keys(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The cleansed inputs with ids that tell any number of keys apart."""
    return {
        name: cleanse(read(spark, sf_dir, wide=True), name, WIDE_RULES[name])
        for name, read in _RAW.items()
    }


def _clean_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = _all_keys(spark, sf_dir)
    return enrich(
        clean["raw_orders"], clean["raw_customers"], clean["raw_products"], as_of=AS_OF
    )


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A products file, all text."""
    path = new_folder(spark, "products-csv")
    _product_file(spark, sf_dir).write.option("header", True).csv(path)
    # Names in the header keep their blanks here; renaming them is P1.
    return standardize_names(read_source(spark, "Product.csv", path))


def json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An orders file with its declared schema."""
    path = new_folder(spark, "orders-json")
    _compressed(_order_file(spark, sf_dir)).json(path)
    return standardize_names(read_source(spark, "Order.json", path))


def csv_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of product files with the columns in two orders."""
    path = new_folder(spark, "products-mixed")
    rows = _product_file(spark, sf_dir)
    odd = F.crc32(F.col(f"`{rows.columns[0]}`").cast("binary")) % 2 == 1
    rows.filter(~odd).write.option("header", True).csv(path)
    rows.filter(odd).select(*(f"`{c}`" for c in reversed(rows.columns))).write.option(
        "header", True
    ).mode("append").csv(path)
    return standardize_names(read_source(spark, "Product.csv", path))


def json_broken_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: an orders file in which some lines end too soon, as good rows and broken lines."""
    path = new_folder(spark, "orders-broken")
    rows = _order_file(spark, sf_dir)
    whole = F.to_json(F.struct(*(f"`{c}`" for c in rows.columns)))
    short = F.concat(F.lit('{"Row ID": '), F.col("Row ID").cast("string"))
    lines = rows.select(F.when(F.col("Row ID") % 97 == 0, short).otherwise(whole))
    _compressed(lines).text(path)
    good, broken = read_records(spark, "Order.json", path)
    return standardize_names(good).select(
        "row_id", "order_id", "quantity", F.lit(None).cast("string").alias("broken_record")
    ).unionByName(broken.select("broken_record"), allowMissingColumns=True)


def xlsx_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of customer workbooks."""
    path = new_folder(spark, "customers-xlsx")
    write_workbooks(_customer_file(spark, sf_dir), path)
    return standardize_names(read_source(spark, "Customer.xlsx", path))


def xlsx_scan_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same workbooks without a declared schema; columns and types come from the cells."""
    path = new_folder(spark, "customers-xlsx-inferred")
    write_workbooks(_customer_file(spark, sf_dir), path)
    return standardize_names(read_source(spark, SourceSpec("any.xlsx", "xlsx", "raw"), path))


def xlsx_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as workbooks with typed cells, read without a declared schema."""
    path = new_folder(spark, "orders-xlsx-typed")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("double"),
        F.col("o_orderdate").cast("date"), (F.col("o_custkey") % 2 == 0).alias("even"),
        # whole numbers in most rows and texts in the others: the column is text
        F.when(F.col("o_orderkey") % 1000 == 0, F.lit("none"))
        .otherwise(F.col("o_custkey").cast("string")).alias("mixed"),
    )
    write_workbooks(orders, path)
    return read_source(spark, SourceSpec("any.xlsx", "xlsx", "raw"), path)


def ingest_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan, rename and stamp."""
    path = new_folder(spark, "products-csv")
    _product_file(spark, sf_dir).write.option("header", True).csv(path)
    return ingest(spark, "Product.csv", path, as_of=AS_OF)


def full_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored summary after a run over files in all three formats."""
    # the summary has no more rows than there are order lines
    database = _database(spark, "pipeline", inputs.read(spark, sf_dir, "lineitem").count())
    folder = new_folder(spark, "pipeline-files")
    files = SalesFiles(f"{folder}/customers", f"{folder}/products", f"{folder}/orders")
    with settings(spark, **BRIEF_SHUFFLES):
        write_workbooks(_customer_file(spark, sf_dir, True), files.customers)
        _product_file(spark, sf_dir, True).write.option("header", True).csv(files.products)
        _compressed(_order_file(spark, sf_dir, True)).json(files.orders)
    run_pipeline(spark, files, database, as_of=AS_OF, rules=WIDE_RULES)
    return catalog.table(spark, "sales_summary", database).select(*SUMMARY_KEYS, "total_profit")


def report_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4, T5: the four reports of a refreshed stored summary, in one frame and one pass."""
    # the summary has no more rows than there are order lines
    database = _database(spark, "reports", inputs.read(spark, sf_dir, "lineitem").count())
    catalog.append(_clean_transactions(spark, sf_dir), "transactions", database)
    refresh_summary(spark, database)
    return all_reports(catalog.table(spark, "sales_summary", database)).select(
        "report", "year", "product_category", "customer_name",
        F.col("total").cast("decimal(30,2)").alias("total"),
    )


def queries() -> dict[str, Query]:
    """All queries by name."""
    return {
        "sales_summary": sales_summary,
        **{name: _report(name) for name in REPORTS},
        "profit_by_customer_year_ranked": profit_by_customer_year_ranked,
        "orders_with_customers": orders_with_customers,
        "orders_with_products": orders_with_products,
        "transactions": transactions,
        "standardize_names": standardized_products,
        "audit_columns": audit_columns,
        "conform_types": conform_types,
        "orders_valid_ids": orders_valid_ids,
        "orders_parsed_dates": _parsed_dates(_DATES),
        "orders_parsed_dates_relaxed": _parsed_dates(
            (_relaxed("order_date"), _relaxed("ship_date"))
        ),
        "orders_parsed_dates_month_first": _parsed_dates(
            (_month_first("order_date"), _month_first("ship_date"))
        ),
        "orders_clean": orders_clean,
        "orders_rejected": orders_rejected,
        "customers_clean": customers_clean,
        "products_clean": products_clean,
        "merge_summary": _merge(null_safe=False),
        "merge_summary_null_safe": _merge(null_safe=True),
        "merge_inserts_columns": merge_inserts_columns,
        "merge_table": merge_table,
        "append_batches": append_batches,
        "catalog_tables": catalog_tables,
        "row_counts": row_counts,
        "csv_scan": csv_scan,
        "csv_mixed_headers": csv_mixed_headers,
        "json_scan": json_scan,
        "json_broken_records": json_broken_records,
        "xlsx_scan": xlsx_scan,
        "xlsx_scan_inferred": xlsx_scan_inferred,
        "xlsx_types": xlsx_types,
        "ingest_products": ingest_products,
        "report_pack": report_pack,
        "full_run": full_run,
    }
