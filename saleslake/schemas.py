"""Declared tables and source files.

The sink schemas fix the types every frame is conformed to before a write; the
sources say which reader, header mode and schema a raw file needs.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from types import MappingProxyType

from pyspark.sql.types import (
    ArrayType,
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

DATABASE = "sales"

STRING, INT, DATE, TIMESTAMP = StringType(), IntegerType(), DateType(), TimestampType()
MONEY, RATE = DecimalType(10, 2), DecimalType(5, 2)
# As wide as SUM(decimal(10,2)), so storing a sum cannot overflow its own column.
TOTAL = DecimalType(20, 2)


def struct(**fields: DataType) -> StructType:
    """A schema of nullable columns, in the order given."""
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


AUDIT = {
    "created_dt": TIMESTAMP,
    "created_by": STRING,
    "updated_dt": TIMESTAMP,
    "updated_by": STRING,
}

# The names and order of the columns of tables and files, here and below.
_CUSTOMER = struct(
    customer_id=STRING,
    customer_name=STRING,
    email=STRING,
    phone=STRING,
    address=STRING,
    segment=STRING,
    country=STRING,
    city=STRING,
    state=STRING,
    postal_code=STRING,
    region=STRING,
    **AUDIT,
)

_PRODUCT = struct(
    product_id=STRING,
    category=STRING,
    subcategory=STRING,
    product_name=STRING,
    state=STRING,
    price_per_product=MONEY,
    **AUDIT,
)

_RAW_ORDER = struct(
    row_id=INT,
    order_id=STRING,
    order_date=STRING,
    ship_date=STRING,
    ship_mode=STRING,
    customer_id=STRING,
    product_id=STRING,
    quantity=INT,
    price=MONEY,
    discount=RATE,
    profit=MONEY,
    **AUDIT,
)

_TRANSACTION = struct(
    row_id=INT,
    order_id=STRING,
    order_date=DATE,
    ship_date=DATE,
    ship_mode=STRING,
    quantity=INT,
    price=MONEY,
    discount=RATE,
    profit=MONEY,
    customer_name=STRING,
    country=STRING,
    product_category=STRING,
    product_sub_category=STRING,
    **AUDIT,
)

# `year` comes last because it is the partition column.
_SUMMARY = struct(
    product_category=STRING,
    product_sub_category=STRING,
    customer_name=STRING,
    total_profit=TOTAL,
    **AUDIT,
    year=INT,
)

SUMMARY_KEYS = ("year", "product_category", "product_sub_category", "customer_name")


@dataclass(frozen=True)
class TableSpec:
    """A managed table: its schema and its partition columns.

    `by_year_of` names a date column by whose year appended rows are put into files, so that
    a scan of some years can pass over files and row groups. A table `by_batch` is filed by the
    batch that brought a row, in a partition column of its own beside the schema. `keys` are
    what rows are merged by; such a table can be bucketed by their hash.
    """

    name: str
    schema: StructType
    partition_by: tuple[str, ...] = ()
    by_year_of: str | None = None
    by_batch: bool = True
    keys: tuple[str, ...] = ()


TABLES = MappingProxyType(
    {
        spec.name: spec
        for spec in (
            TableSpec("raw_customers", _CUSTOMER),
            TableSpec("raw_products", _PRODUCT),
            TableSpec("raw_orders", _RAW_ORDER),
            TableSpec("customers", _CUSTOMER),
            TableSpec("products", _PRODUCT),
            TableSpec("transactions", _TRANSACTION, by_year_of="order_date"),
            TableSpec("sales_summary", _SUMMARY, ("year",), by_batch=False, keys=SUMMARY_KEYS),
        )
    }
)

#: The partition column of the batch that brought a row.
BATCH = "load_batch"
#: The bucket column of a merged table: a hash of its keys in which NULL is a value.
KEY_HASH = "key_hash"
#: Tables of the engine's own, which are not listed with the others.
OWN = "engine_"

#: What each batch has added to the summary.
LEDGER = TableSpec(
    f"{OWN}summary_ledger",
    struct(year=INT, product_category=STRING, product_sub_category=STRING, customer_name=STRING,
           total_profit=TOTAL),
)

#: Clean orders of a batch whose customer or product was not known then.
PARKED = TableSpec(
    f"{OWN}parked_orders",
    struct(
        row_id=INT, order_id=STRING, order_date=DATE, ship_date=DATE, ship_mode=STRING,
        customer_id=STRING, product_id=STRING, quantity=INT, price=MONEY, discount=RATE,
        profit=MONEY,
    ),
)

#: The order in which batches were first seen.
BATCHES = TableSpec(f"{OWN}batches", struct(batch=STRING, place=INT), by_batch=False)

#: How many rows each step of a batch's run has seen.
COUNTS = TableSpec(f"{OWN}load_counts", struct(step=STRING, row_count=LongType()))


def rejected_table(raw: str) -> str:
    """The table of the rows of a raw table that failed a rule."""
    return OWN + raw.replace("raw_", "rejected_")


ENGINE_TABLES = MappingProxyType(
    {
        spec.name: spec
        for spec in (
            LEDGER, PARKED, BATCHES, COUNTS,
            *(
                TableSpec(
                    rejected_table(raw),
                    StructType([*schema.fields, StructField("failed_rules", ArrayType(STRING))]),
                )
                for raw, schema in (
                    ("raw_customers", _CUSTOMER), ("raw_products", _PRODUCT),
                    ("raw_orders", _RAW_ORDER),
                )
            ),
        )
    }
)


@dataclass(frozen=True)
class SourceSpec:
    """How to read one kind of raw file.

    Without a schema, CSV columns are all strings named by the header row, and columns of
    XLSX are inferred from all cells by a pass of its own. JSON always needs one.
    """

    name: str
    format: str
    table: str
    schema: StructType | None = None
    header: bool = True
    multi_line: bool = False
    options: dict[str, str] = field(default_factory=dict)


ORDER_FILE_SCHEMA = struct(
    **{
        "Row ID": INT,
        "Order ID": STRING,
        "Order Date": STRING,
        "Ship Date": STRING,
        "Ship Mode": STRING,
        "Customer ID": STRING,
        "Product ID": STRING,
        "Quantity": INT,
        "Price": MONEY,
        "Discount": RATE,
        "Profit": MONEY,
    }
)

CUSTOMER_FILE_SCHEMA = struct(
    **{
        "Customer ID": STRING,
        "Customer Name": STRING,
        "Email": STRING,
        "Phone": STRING,
        "Address": STRING,
        "Segment": STRING,
        "Country": STRING,
        "City": STRING,
        "State": STRING,
        "Postal Code": STRING,
        "Region": STRING,
    }
)

SOURCES = MappingProxyType(
    {
        spec.name: spec
        for spec in (
            SourceSpec("Customer.xlsx", "xlsx", "raw_customers", CUSTOMER_FILE_SCHEMA),
            SourceSpec("Product.csv", "csv", "raw_products"),
            SourceSpec("Order.json", "json", "raw_orders", ORDER_FILE_SCHEMA),
        )
    }
)
