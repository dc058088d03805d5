"""DataFrame operators: joins, aggregates, reports and the upsert."""

from saleslake.operators.enrich import enrich, join_customers, join_products
from saleslake.operators.merge import merge_upsert, tag_merge
from saleslake.operators.summary import (
    profit_by_customer,
    profit_by_customer_year,
    profit_by_year,
    profit_by_year_category,
    summarize,
)

__all__ = [
    "enrich",
    "join_customers",
    "join_products",
    "merge_upsert",
    "profit_by_customer",
    "profit_by_customer_year",
    "profit_by_year",
    "profit_by_year_category",
    "summarize",
    "tag_merge",
]
