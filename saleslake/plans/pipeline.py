"""From raw files to reports."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Mapping
from contextlib import ExitStack
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from saleslake.functions.columns import DEFAULT_USER, standardize_names, with_audit
from saleslake.functions.quality import (
    ACCEPTED,
    Rule,
    accepted_rows,
    judge_rows,
    rejected_rows,
    rules_for,
)
from saleslake.operators.enrich import PLACE, enrich, known_rows, newly_matched, unmatched
from saleslake.operators.merge import add
from saleslake.operators.summary import REPORTS
from saleslake.plans import catalog
from saleslake.plans.staging import observed_counts, staged
from saleslake.schemas import (
    BATCH,
    BATCHES,
    COUNTS,
    DATABASE,
    ENGINE_TABLES,
    LEDGER,
    PARKED,
    SUMMARY_KEYS,
    TABLES,
    SourceSpec,
    rejected_table,
)
from saleslake.sources import read_source

#: Buckets of a year of the summary, where the run creates it; `catalog.buckets_for` gives the number
#: for a summary that is known to be large.
BUCKETS = 8


@dataclass(frozen=True)
class SalesFiles:
    """Where the three raw inputs are, and how to read them.

    A spec may be a registered file name, or any name with a known extension.
    """

    customers: str
    products: str
    orders: str
    customer_spec: SourceSpec | str = "Customer.xlsx"
    product_spec: SourceSpec | str = "Product.csv"
    order_spec: SourceSpec | str = "Order.json"


def ingest(
    spark: SparkSession,
    spec: SourceSpec | str,
    path: str,
    *,
    as_of: dt.date | None = None,
    user: str = DEFAULT_USER,
) -> DataFrame:
    """Read one source, rename its columns and stamp it."""
    return with_audit(standardize_names(read_source(spark, spec, path)), as_of=as_of, user=user)


def _in_years(column: str, years: Iterable[int | None]) -> Column:
    """Rows whose date is in one of the years.

    One range from the first to the last year goes with the list, for a Parquet scan to skip
    row groups by; both stay in Spark's dates, which reach back to year 0.
    """
    years = set(years)
    known = sorted(year for year in years if year is not None)
    undated = F.col(column).isNull() if None in years else F.lit(False)
    if not known:
        return undated
    first = F.make_date(F.lit(known[0]), F.lit(1), F.lit(1))
    last = F.make_date(F.lit(known[-1]), F.lit(12), F.lit(31))
    # The list lets NULL through in its own words: with IS NULL in both tests, the optimizer
    # joins them into one that the scan cannot take.
    listed = F.coalesce(F.year(column).isin(known), F.lit(None in years))
    return (F.col(column).between(first, last) | undated) & listed


def _contributions(transactions: DataFrame) -> DataFrame:
    """What each batch's transactions add up to by the summary's keys."""
    return transactions.withColumn("year", F.year("order_date")).groupBy(
        BATCH, *SUMMARY_KEYS
    ).agg(F.sum("profit").alias("total_profit"))


def refresh_summary(
    spark: SparkSession,
    database: str = DATABASE,
    *,
    years: Iterable[int | None] | None = None,
) -> dict[str, int]:
    """Bring `sales_summary` in line with the whole `transactions` table (T4).

    The merge replaces totals, so each one is summed over all transactions of its key: by batch
    first, for the ledger that later batches are refreshed by, and then over the batches.
    `years` limits all tables to the order years known to have changed. NULL keys match
    each other, or a refresh would insert the NULL-year groups again every time.
    """
    catalog.create_tables(spark, database, ENGINE_TABLES.values())
    for batch in catalog.unfinished_merges(spark, "sales_summary", database):
        refresh_batch(spark, database, batch)
    transactions = spark.table(f"`{database}`.`transactions`")
    ledger = spark.table(f"`{database}`.`{LEDGER.name}`")
    if years is not None:
        years = set(years)
        transactions = transactions.filter(_in_years("order_date", years))
    sums = _contributions(transactions)
    with staged(sums, "contributions") as rows:
        counts = catalog.merge_into(
            rows.groupBy(*SUMMARY_KEYS).agg(F.sum("total_profit").alias("total_profit")),
            "sales_summary", SUMMARY_KEYS, "total_profit", database=database, partitions=years,
            null_safe=True, size=rows.count(),
        )
        if years is None:
            catalog.overwrite(rows.select(*ledger.columns), LEDGER.name, database)
            return counts
        others = ledger.filter(~F.coalesce(catalog.any_of("year", years), F.lit(False)))
        with staged(rows.select(*ledger.columns).unionByName(others), "ledger") as whole:
            catalog.overwrite(whole, LEDGER.name, database)
    return counts


def refresh_batch(spark: SparkSession, database: str, batch: str) -> dict[str, int]:
    """Bring `sales_summary` in line with one batch's transactions (T4).

    The signed difference between what the batch adds up to now and what the ledger says it has
    added before goes to the totals; no other batch's transactions are read. The difference is
    merged from staged rows under the batch's name, and these are dropped only after the ledger
    is written: a refresh that failed at any point is taken up from there, by its own repetition
    or by the next refresh of any batch, and nothing is added twice. Keys that a batch no longer
    has keep a total without it.
    """
    catalog.create_tables(spark, database, ENGINE_TABLES.values())
    for other in catalog.unfinished_merges(spark, "sales_summary", database):
        if other != batch:
            refresh_batch(spark, database, other)
    transactions = spark.table(f"`{database}`.`transactions`").filter(F.col(BATCH) == batch)
    now = _contributions(transactions).drop(BATCH)
    with staged(now, "contributions") as rows:
        before = catalog.table(spark, LEDGER.name, database, batch)
        amount = F.col("total_profit")
        signed = rows.select(*SUMMARY_KEYS, amount, F.lit(False).alias("had")).unionByName(
            before.select(*SUMMARY_KEYS, (-amount).alias("total_profit"), F.lit(True).alias("had"))
        )
        changes = (
            signed.groupBy(*SUMMARY_KEYS)
            .agg(F.sum("total_profit").alias("total_profit"), F.max("had").alias("had"))
            .filter("NOT had OR total_profit <> 0")
        )
        with staged(changes, "changes") as delta:
            # At most one row per calendar year, of which four digits make 10,000.
            years = [row[0] for row in delta.select("year").distinct().collect()]
            merge = catalog.merging(
                delta, "sales_summary", SUMMARY_KEYS, "total_profit", batch, database, years,
                {"null_safe": True, "combine": add},
            )
            with merge as counts:
                catalog.append(rows, LEDGER.name, database, batch)
    return counts


def reports(spark: SparkSession, database: str = DATABASE) -> dict[str, DataFrame]:
    """The four roll-ups of the stored summary (T5)."""
    summary = catalog.table(spark, "sales_summary", database)
    return {name: report(summary) for name, report in REPORTS.items()}


def _place(spark: SparkSession, database: str, batch: str) -> int:
    """The batch's rank among all batches by when they were first run."""
    known = {row.batch: row.place for row in catalog.table(spark, BATCHES.name, database).collect()}
    if batch not in known:
        known[batch] = max(known.values(), default=0) + 1
        row = spark.createDataFrame([(batch, known[batch])], BATCHES.schema)
        catalog.append(row, BATCHES.name, database)
    return known[batch]


def _with_place(spark: SparkSession, name: str, database: str) -> DataFrame:
    """A table's rows with the rank of their batch; rows without a ranked batch come first."""
    spec = TABLES.get(name) or ENGINE_TABLES[name]
    places = catalog.table(spark, BATCHES.name, database).withColumnRenamed("batch", BATCH)
    rows = spark.table(f"`{database}`.`{name}`").join(places, BATCH, "left")
    return rows.select(*spec.schema.names, F.coalesce(PLACE, F.lit(0)).alias(PLACE))


def run_pipeline(
    spark: SparkSession,
    files: SalesFiles,
    database: str = DATABASE,
    *,
    location: str | None = None,
    as_of: dt.date | None = None,
    user: str = DEFAULT_USER,
    rules: Mapping[str, Iterable[Rule]] | None = None,
    batch: str | None = None,
    buckets: int | None = BUCKETS,
) -> dict[str, DataFrame]:
    """Load one batch of files, refresh the summary and return the reports.

    Each file is parsed once, into its raw table, from which the batch's rows are read back to be
    cleansed and joined. `rules` replaces the rules of the raw tables it names. Rows that fail a
    rule go to a table of their own with the names of the rules, in the same pass; how many rows
    were read, kept and joined is observed while they are written. Tables are kept; dropping them
    is a separate call.

    Orders are joined to their customers and products of this batch or, where it lacks the key,
    to the latest row that an earlier batch brought. Orders without one are parked, and the first
    later batch that brings what they lack takes them up. What a batch takes up depends on
    the batches first run before it only, so it can be run again at any time.

    With a `batch` name a run can be repeated after a failure, and with other files: what it
    writes replaces what it had written under that name. A run without a name is a batch of its
    own; what it has loaded is taken away again if it fails.
    """
    catalog.create_database(spark, database, location)
    catalog.create_tables(spark, database, buckets=buckets)
    catalog.create_tables(spark, database, ENGINE_TABLES.values())
    name = batch if batch is not None else f"run-{uuid.uuid4().hex}"
    try:
        _load(spark, files, database, name, as_of, user, rules or {})
    except Exception:
        if batch is None:
            for spec in (*TABLES.values(), *ENGINE_TABLES.values()):
                if spec.by_batch:
                    catalog.drop_batch(spark, spec.name, name, database)
        raise
    refresh_batch(spark, database, name)
    return reports(spark, database)


def _load(
    spark: SparkSession, files: SalesFiles, database: str, batch: str, as_of: dt.date | None,
    user: str, rules: Mapping[str, Iterable[Rule]],
) -> None:
    """A batch's raw, clean and joined rows."""
    place = _place(spark, database, batch)
    counts: dict[str, Observation] = {}
    with ExitStack() as kept:
        with ExitStack() as stages, ExitStack() as judgements:
            clean = {}
            for spec, path, name in (
                (files.customer_spec, files.customers, "customers"),
                (files.product_spec, files.products, "products"),
                (files.order_spec, files.orders, "orders"),
            ):
                raw = f"raw_{name}"
                read = ingest(spark, spec, path, as_of=as_of, user=user)
                catalog.append(read, raw, database, batch)
                rows = catalog.table(spark, raw, database, batch)
                judged = judge_rows(rows, rules_for(raw, rules.get(raw)))
                counts[name] = Observation()
                counted = judged.observe(
                    counts[name], F.count(F.lit(1)).alias("read"),
                    F.count_if(ACCEPTED).alias("kept"),
                )
                stage = judgements.enter_context(
                    staged(counted, f"judged-{name}", [ACCEPTED])
                )
                catalog.append(rejected_rows(stage), rejected_table(raw), database, batch)
                clean[name] = accepted_rows(stage)
            for name in ("customers", "products"):
                catalog.append(clean[name], name, database, batch)
            customers = stages.enter_context(staged(known_rows(
                _with_place(spark, "customers", database).select(
                    "customer_id", "customer_name", "country", PLACE
                ), "customer_id", place,
            ), "known-customers"))
            products = stages.enter_context(staged(known_rows(
                _with_place(spark, "products", database).select(
                    "product_id", "category", "subcategory", PLACE
                ), "product_id", place,
            ), "known-products"))
            columns = PARKED.schema.names
            own = clean["orders"].select(*columns)
            # Rows are written after each join: no more than one shuffle of all orders is on the
            # disk at a time, and what a step has read goes before the next one's.
            with ExitStack() as step:
                parked = unmatched(
                    own, customers, products,
                    between=lambda rows: step.enter_context(staged(rows, "flagged-orders")),
                )
                catalog.append(parked, PARKED.name, database, batch)
            earlier = _with_place(spark, PARKED.name, database).filter(F.col(PLACE) < place)
            late = newly_matched(earlier.select(*columns), customers, products)

            def named(rows: DataFrame) -> DataFrame:
                held = stages.enter_context(staged(rows, "named-orders"))
                judgements.close()
                return held

            sales = enrich(
                own.unionByName(late), customers, products, as_of=as_of, user=user, between=named
            )
            counts["transactions"] = Observation()
            joined = kept.enter_context(staged(
                sales.observe(counts["transactions"], F.count(F.lit(1)).alias("joined")), "joined"
            ))
        catalog.append(joined, "transactions", database, batch)
    seen = [
        (f"{name}_{step}", value)
        for name, observed in counts.items()
        for step, value in observed_counts(
            observed, *(("joined",) if name == "transactions" else ("read", "kept"))
        ).items()
    ]
    rows = spark.createDataFrame(seen, COUNTS.schema)
    catalog.append(rows.coalesce(1), COUNTS.name, database, batch)
