"""Profit aggregates and the report pack.

Every aggregate is a sum, which Spark combines per map task before the shuffle, so a
group holding a large share of the rows reaches the reducers as one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslake.plans.staging import stored


def summarize(transactions: DataFrame) -> DataFrame:
    """Profit by order year, category, sub-category and customer.

    Rows without a parsed order date form their own NULL-year groups.
    """
    return transactions.groupBy(
        F.year("order_date").alias("year"),
        "product_category",
        "product_sub_category",
        "customer_name",
    ).agg(F.sum("profit").alias("total_profit"))


def _report(summary: DataFrame, keys: list[str], total: str) -> DataFrame:
    return summary.groupBy(*keys).agg(F.sum("total_profit").alias(total)).orderBy(*keys)


def profit_by_year(summary: DataFrame) -> DataFrame:
    """A2, O1."""
    return _report(summary, ["year"], "total_profit_by_year")


def profit_by_year_category(summary: DataFrame) -> DataFrame:
    """A3, O2."""
    return _report(summary, ["year", "product_category"], "total_profit_by_year_and_category")


def profit_by_customer(summary: DataFrame) -> DataFrame:
    """A4, O3."""
    return _report(summary, ["customer_name"], "total_profit_by_customer")


def profit_by_customer_year(summary: DataFrame) -> DataFrame:
    """A5, O4."""
    return _report(summary, ["customer_name", "year"], "total_profit_by_customer_and_year")


def ranked(rows: DataFrame, keys: list[str], rank: str = "place") -> DataFrame:
    """The rows with their place in the order of the keys, NULL first, from 1.

    The order survives a write: rows are dealt by ranges of the keys, sorted and stored, one file
    after the other, and a row's place is its number in its range after all rows of the ranges
    before. The driver gets a count for each range; no task sees more than a range. Rows with
    equal keys have neighbouring places in any order, and lie in one range.
    """
    at = F.monotonically_increasing_id()  # the range above, the number in it in the lower bits
    held = stored(
        rows.repartitionByRange(*(F.asc_nulls_first(key) for key in keys))
        .sortWithinPartitions(*(F.asc_nulls_first(key) for key in keys))
        .select("*", F.shiftright(at, 33).alias("_range"),
                at.bitwiseAND(F.lit((1 << 33) - 1)).alias("_number")),
        "ranked",
    )
    counts = sorted(tuple(row) for row in held.groupBy("_range").count().collect())
    before, starts = 0, []
    for part, count in counts:
        starts.append((part, before))
        before += count
    offsets = rows.sparkSession.createDataFrame(starts, "_range long, _before long")
    return held.join(offsets, "_range").select(
        *rows.columns, (F.col("_before") + F.col("_number") + 1).alias(rank)
    )


REPORTS = {
    "profit_by_year": profit_by_year,
    "profit_by_year_category": profit_by_year_category,
    "profit_by_customer": profit_by_customer,
    "profit_by_customer_year": profit_by_customer_year,
}


def all_reports(summary: DataFrame) -> DataFrame:
    """The four reports as rows of one frame, from one scan of the summary (A2-A5).

    `report` names the report; a key it does not group by is NULL. The rows are in no order,
    which `REPORTS` are for.
    """
    # grouping_id has a bit for each of the three keys, set where the report lacks it
    names = {
        0b011: "profit_by_year",
        0b001: "profit_by_year_category",
        0b110: "profit_by_customer",
        0b010: "profit_by_customer_year",
    }
    keys = ("year", "product_category", "customer_name")
    sets = [[key for at, key in enumerate(keys) if not absent >> (2 - at) & 1] for absent in names]
    report = F.create_map(*(F.lit(part) for entry in names.items() for part in entry))
    return (
        summary.groupingSets([[F.col(key) for key in chosen] for chosen in sets], *keys)
        .agg(F.sum("total_profit").alias("total"), F.grouping_id().cast("int").alias("_absent"))
        .select(report[F.col("_absent")].alias("report"), *keys, "total")
    )
