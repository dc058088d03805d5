"""Orders joined to their dimensions.

No side is forced to broadcast: Spark does so only when its size estimate is under
`spark.sql.autoBroadcastJoinThreshold`. Beyond that both joins shuffle on their key,
and as inner joins they let AQE split the order side of a hot customer or product.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslake.functions.columns import DEFAULT_USER, date_column

#: How many batches ago a dimension row came, and whether its key is new in this batch.
PLACE, NEW_KEY = "place", "new_key"

#: Gives the rows that a second join reads from those of the first.
Between = Callable[[DataFrame], DataFrame]


def known_rows(dimension: DataFrame, key: str, place: int) -> DataFrame:
    """The rows of a stored dimension that a batch's orders are joined to.

    `dimension` has a column `place`, the rank of the batch that brought a row; only rows up to
    the batch's own `place` count. A key of the batch's own rows has all of these; another has
    its latest row, of several in one batch the greatest. `new_key` tells the keys that no
    earlier batch has. The latest row is a maximum, combined before the shuffle, so a key with
    very many versions never gathers in a task.
    """
    columns = [c for c in dimension.columns if c not in (key, PLACE)]
    own = dimension.filter(F.col(PLACE) == place).select(key, *columns)
    earlier = (
        dimension.filter(F.col(PLACE) < place).groupBy(key)
        .agg(F.max(F.struct(PLACE, *columns)).alias("latest"))
    )
    own_keys = own.select(key).distinct()
    kept = earlier.join(own_keys, key, "left_anti").select(
        key, *(F.col(f"latest.{c}").alias(c) for c in columns), F.lit(False).alias(NEW_KEY)
    )
    seen = earlier.select(key, F.lit(True).alias("seen"))
    mine = own.join(seen, key, "left").select(
        key, *columns, F.col("seen").isNull().alias(NEW_KEY)
    )
    return mine.unionByName(kept)


def newly_matched(
    parked: DataFrame, customers: DataFrame, products: DataFrame
) -> DataFrame:
    """Parked orders that this batch's new customers or products complete.

    Both dimensions come from `known_rows`. An order whose keys were both known before has been
    taken up by an earlier batch.
    """
    flags = []
    for dimension, key in ((customers, "customer_id"), (products, "product_id")):
        flags.append(dimension.groupBy(key).agg(F.max(NEW_KEY).alias(f"new_{key}")))
    return (
        parked.join(flags[0], "customer_id").join(flags[1], "product_id")
        .filter("new_customer_id OR new_product_id").select(*parked.columns)
    )


def unmatched(
    orders: DataFrame, customers: DataFrame, products: DataFrame, *, between: Between | None = None
) -> DataFrame:
    """Orders without a customer or without a product, each once; `between` as in `enrich`."""
    flagged = orders
    for dimension, key in ((customers, "customer_id"), (products, "product_id")):
        keys = dimension.select(key).distinct().withColumn(f"has_{key}", F.lit(True))
        if between and flagged is not orders:
            flagged = between(flagged)
        flagged = flagged.join(keys, key, "left")
    lacking = F.col("has_customer_id").isNull() | F.col("has_product_id").isNull()
    return flagged.filter(lacking).select(*orders.columns)


def join_customers(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with their customer's name and country; unmatched orders drop."""
    return orders.join(
        customers.select("customer_id", "customer_name", "country"), "customer_id", "inner"
    )


def join_products(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Orders with their product's category and sub-category; unmatched drop."""
    return orders.join(
        products.select("product_id", "category", "subcategory"), "product_id", "inner"
    )


def enrich(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    *,
    as_of: dt.date | None = None,
    user: str = DEFAULT_USER,
    between: Between | None = None,
) -> DataFrame:
    """The transactions projection of the two joins.

    Audit columns of the inputs are left behind and stamped once, after the joins. `between` is
    given the rows of the first join and gives those that the second one reads, such as the same
    rows written: the shuffle files of both joins are then not on the disk at the same time.
    """
    day, by = date_column(as_of), F.lit(user)
    named = join_customers(orders, customers)
    return join_products(between(named) if between else named, products).select(
        "row_id",
        "order_id",
        "order_date",
        "ship_date",
        "ship_mode",
        "quantity",
        "price",
        "discount",
        "profit",
        "customer_name",
        "country",
        F.col("category").alias("product_category"),
        F.col("subcategory").alias("product_sub_category"),
        day.alias("created_dt"),
        by.alias("created_by"),
        day.alias("updated_dt"),
        by.alias("updated_by"),
    )
