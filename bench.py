"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR   folder of the input tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated query names instead of the headline ones
"""

from __future__ import annotations

import json
import os
import statistics
import time

from subsmart.plans.registry import QUERIES
from subsmart.session import local_session

HEADLINE = [
    "fact_financials",
    "fact_financials_open",
    "fact_financials_per_subscription",
    "fact_product_usage",
    "fact_product_usage_users",
    "fact_object_counts",
    "financials_days_active",
    "financials_churn",
    "scd2_first_load",
    "scd2_changed_rows",
    "scd2_version_chain",
    "scd2_second_batch",
    "replace_object_counts",
    "replace_product_usage",
    "replace_financials",
    "dq_report",
]
RUNS = 3


def run(spark, name: str, folder: str) -> float:
    """Seconds to plan and fully compute a query; nothing is collected."""
    begin = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench")
    run(spark, "fact_product_usage", folder)  # starts executors and compiles the first stages
    first, median = {}, {}
    for name in names:
        times = [run(spark, name, folder) for _ in range(RUNS)]
        first[name], median[name] = round(times[0], 3), round(statistics.median(times), 3)
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(median.values()), 3),
                "unit": "sec",
                "queries": median,
                "first_run": first,
                "sf": os.path.basename(folder).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
