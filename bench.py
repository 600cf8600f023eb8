"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) is the data folder, BENCH_CPUS (default 8) the number
of threads. Each query runs once to warm up and then BENCH_RUNS (default 2) times; the median
counts. Names given as arguments replace the headline list; ``all`` runs every query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from labwh.demo import all_queries
from labwh.demo.tables import Tables

HEADLINE = [
    "attendance_pairs",
    "latest_order_per_customer",
    "customer_order_history_rank",
    "project_flags",
    "project_wide_detail",
    "company_business_area",
    "registered_vs_business_daily",
    "bank_area_month",
    "bank_rank",
    "project_bank_rank",
    "salary_area_vs_last_month",
    "build_day_share",
    "status_day",
    "device_activity_flags",
    "swipe_in_validity",
    "resume_detail",
    "salary_detail_rank",
    "company_month_shift",
    "company_locality_split",
    "platform_totals",
    "active_headcount_month",
    "project_month_income",
    "latest_up_to_month",
    "cumulative_metrics_12m",
    "sum_once_per_owner",
    "six_rule_statistics",
    "month_cache_merge",
    "json_log_counts",
    "report_project_day",
    "report_salary_batches",
    "report_rule_scores",
    "report_platform_totals_month",
    "report_project_detail",
    "report_monthly_metrics",
    "report_onjob_share",
    "report_salary_total",
    "report_project_bank_rank",
]


def main(names: list[str]) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("labwh-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    if names == ["all"]:
        names = list(queries)
    seconds: dict[str, float] = {}
    for name in names or HEADLINE:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            # The no-op sink computes every row and column without collecting them.
            queries[name](Tables(spark, folder)).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]) if runs else taken[0], 3)
    print(
        json.dumps(
            {
                "metric": "labwh_headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
