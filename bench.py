"""Time the queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

All queries run once to warm up, then each up to $BENCH_RUNS times, fewer when it has
taken $BENCH_QUERY_SECONDS; the median is reported.
Results go to the `noop` sink, so all rows and columns are computed.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

from saleslake.queries import queries
from saleslake.session import build_session

HEADLINE = (
    "sales_summary",
    "profit_by_year",
    "profit_by_year_category",
    "profit_by_customer",
    "profit_by_customer_year",
    "orders_with_customers",
    "transactions",
    "conform_types",
    "orders_valid_ids",
    "orders_clean",
    "customers_clean",
    "products_clean",
    "merge_summary_null_safe",
    "merge_table",
    "csv_scan",
    "json_scan",
    "csv_mixed_headers",
    "json_broken_records",
    "orders_rejected",
    "row_counts",
    "append_batches",
    "xlsx_scan",
    "report_pack",
    "full_run",
)


def timed(spark, query, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    budget = float(os.environ.get("BENCH_QUERY_SECONDS", "30"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = {name: queries()[name] for name in names}
    for query in chosen.values():
        timed(spark, query, sf_dir)
    seconds, counted = {}, {}
    for name, query in chosen.items():
        times: list[float] = []
        while len(times) < runs and sum(times) < budget:
            times.append(timed(spark, query, sf_dir))
        seconds[name] = round(statistics.median(times), 3)
        counted[name] = len(times)
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_median_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
                "cpus": int(cpus),
                "runs": runs,
                "runs_of_each": counted,
            }
        )
    )


if __name__ == "__main__":
    main()
