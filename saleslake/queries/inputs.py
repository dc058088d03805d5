"""Sales-shaped frames derived from the driver's tables.

`orders`, `customers` and `products` are clean and keep the tables' own integer keys.
`raw_orders`, `raw_customers` and `raw_products` look like files before cleansing: text
ids and dates, with bad values planted on fixed residues of the keys.

A customer id has two letters and five digits, which tells 67,600,000 keys apart. Later
keys take ids again from the start, so no row is lost to the id rules. Where ids are joined
they must stay apart: `wide` ids have further digits in front for such keys, and rules with
the `WIDE_` patterns take them. Products have three more digits of both kinds.

The row id is an int, so it wraps at 2^31, and an order number has six digits; both may
repeat in a large table. No query joins or groups by either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WIDE_CUSTOMER_ID = r"^[A-Z]{2}-\d{5,}$"
WIDE_PRODUCT_ID = r"^[A-Z]{3}-[A-Z]{2}-\d{8,}$"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _with_geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their nation's and region's name."""
    nations = read(spark, sf_dir, "nation").join(
        read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "inner"
    )
    return read(spark, sf_dir, "customer").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey"), "inner"
    )


def _code(prefix: str, key: str, span: int, digits: int, wide: bool) -> str:
    """A keyed id: two letters for the span the key is in, then its number there."""
    letters = ", ".join(
        f"char(65 + {part})" for part in
        (f"(({key} div {span}) % 676) div 26", f"({key} div {span}) % 26")
    )
    number = f"{key} % {span}"
    if wide:
        number += f" + ({key} div {676 * span}) * {span}"
    text = f"cast({number} AS string)"
    return (
        f"concat('{prefix}', {letters}, '-',"
        f" lpad({text}, greatest({digits}, length({text})), '0'))"
    )


def customer_code(key: str, wide: bool = False) -> str:
    """SQL text of the sales customer id for an integer key."""
    return _code("", f"cast({key} AS long)", 100_000, 5, wide)


def product_code(key: str, wide: bool = False) -> str:
    """SQL text of the sales product id for an integer key."""
    return _code("FUR-", f"cast({key} AS long)", 100_000_000, 8, wide)


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order: one sales order row each."""
    return read(spark, sf_dir, "lineitem").join(
        read(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"), "inner"
    )


_ROW_ID = "cast((l_orderkey * 8 + l_linenumber) % 2147483647 AS int) AS row_id"
_ORDER_ID = (
    "concat('CA-', cast(year(o_orderdate) AS string), '-',"
    " lpad(cast(o_orderkey % 1000000 AS string), 6, '0'))"
)
_MEASURES = (
    "cast(l_quantity AS int) AS quantity",
    "cast(l_extendedprice AS decimal(10,2)) AS price",
    "cast(l_discount AS decimal(5,2)) AS discount",
    "cast(cast(l_extendedprice AS decimal(12,2)) * cast(l_discount AS decimal(4,2))"
    " AS decimal(10,2)) AS profit",
)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_lines(spark, sf_dir).selectExpr(
        _ROW_ID,
        f"{_ORDER_ID} AS order_id",
        "cast(o_orderdate AS date) AS order_date",
        "cast(l_shipdate AS date) AS ship_date",
        "o_orderpriority AS ship_mode",
        "o_custkey AS customer_id",
        "l_partkey AS product_id",
        *_MEASURES,
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_geography(spark, sf_dir).selectExpr(
        "c_custkey AS customer_id", "c_name AS customer_name", "n_name AS country",
        "c_mktsegment AS segment",
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").selectExpr(
        "p_partkey AS product_id", "p_type AS category", "p_brand AS subcategory",
        "p_name AS product_name",
    )


def _planted_date(key: str, date: str) -> str:
    return (
        f"CASE WHEN {key} % 11 = 0 THEN '31/02/2016'"
        f" WHEN {key} % 13 = 0 THEN date_format({date}, 'd/M/yyyy')"
        f" ELSE date_format({date}, 'dd/MM/yyyy') END"
    )


def raw_orders(spark: SparkSession, sf_dir: str, wide: bool = False) -> DataFrame:
    return _order_lines(spark, sf_dir).selectExpr(
        _ROW_ID,
        f"CASE WHEN o_orderkey % 17 = 0 THEN 'BAD' ELSE {_ORDER_ID} END AS order_id",
        f"{_planted_date('o_orderkey', 'o_orderdate')} AS order_date",
        f"{_planted_date('l_suppkey', 'l_shipdate')} AS ship_date",
        "o_orderpriority AS ship_mode",
        f"CASE WHEN o_orderkey % 23 <> 0 THEN {customer_code('o_custkey', wide)} END AS customer_id",
        f"{product_code('l_partkey', wide)} AS product_id",
        *_MEASURES,
    )


def raw_customers(spark: SparkSession, sf_dir: str, wide: bool = False) -> DataFrame:
    four = "lpad(cast(c_custkey % 10000 AS string), 4, '0')"
    five = "lpad(cast(c_custkey % 100000 AS string), 5, '0')"
    return _with_geography(spark, sf_dir).selectExpr(
        "CASE WHEN c_custkey % 19 = 0 THEN concat('BAD-', c_custkey)"
        f" WHEN c_custkey % 29 <> 0 THEN {customer_code('c_custkey', wide)} END AS customer_id",
        "concat(translate(c_name, '0123456789', 'ABCDEFGHIJ'),"
        " CASE WHEN c_custkey % 4 = 0 THEN '-José 3' ELSE '' END) AS customer_name",
        "CASE c_custkey % 5 WHEN 0 THEN concat('user', c_custkey, '@mail')"
        " WHEN 1 THEN concat('user.', c_custkey, '@mail.example.com')"
        " WHEN 2 THEN NULL WHEN 3 THEN '#ERROR!'"
        " ELSE concat('u_', c_custkey, '+x@example.org') END AS email",
        "CASE c_custkey % 8 WHEN 0 THEN '421.580.0902x9815' WHEN 1 THEN '#ERROR!'"
        f" WHEN 2 THEN concat('(123) 456-', {four}) WHEN 3 THEN concat('+1 123-456-', {four})"
        f" WHEN 4 THEN concat('123.456.', {four}) WHEN 5 THEN '12345' WHEN 6 THEN NULL"
        f" ELSE concat('+1(123)456-', {four}) END AS phone",
        "concat('No ', c_custkey, ' Main Street') AS address",
        "c_mktsegment AS segment",
        "n_name AS country",
        "concat('City ', c_custkey % 100) AS city",
        "concat('State ', c_custkey % 50) AS state",
        f"CASE c_custkey % 6 WHEN 0 THEN '1234' WHEN 1 THEN concat({five}, '-6789')"
        f" WHEN 2 THEN '12345.0' WHEN 3 THEN NULL ELSE {five} END AS postal_code",
        "r_name AS region",
    )


def raw_products(spark: SparkSession, sf_dir: str, wide: bool = False) -> DataFrame:
    return read(spark, sf_dir, "part").selectExpr(
        f"CASE WHEN p_partkey % 19 = 0 THEN 'BAD' ELSE {product_code('p_partkey', wide)} END"
        " AS product_id",
        "p_type AS category",
        "p_brand AS subcategory",
        "concat(p_name, CASE WHEN p_partkey % 3 = 0 THEN ' José-3 ®' ELSE '' END)"
        " AS product_name",
        "concat('State ', p_partkey % 50) AS state",
        "cast(p_retailprice AS decimal(10,2)) AS price_per_product",
    )


# Header rows of the three kinds of files, in the column order of the raw frames.
ORDER_HEADERS = (
    "Row ID", "Order ID", "Order Date", "Ship Date", "Ship Mode", "Customer ID",
    "Product ID", "Quantity", "Price", "Discount", "Profit",
)
CUSTOMER_HEADERS = (
    "Customer ID", "Customer Name", "Email", "Phone", "Address", "Segment", "Country",
    "City", "State", "Postal Code", "Region",
)
PRODUCT_HEADERS = (
    "Product ID", "Category", " Sub-Category ", "Product Name", "State", "Price per product",
)
