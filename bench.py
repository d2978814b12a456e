"""Benchmark: run the headline queries and print one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default HEADLINE). Each query is executed in
full with the ``noop`` sink (no collect to the driver); the time of each
query is its wall-clock seconds, ``value`` is their sum.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "funnel_group_facilities", "funnel_by_year_month", "funnel_budget_group", "funnel_all_months",
    "rolling_12m_totals", "monthly_period_l12m", "monthly_applications",
    "application_facts", "paid_facts", "budget_facts", "ecof_facts",
    "application_summary_all", "paid_summary",
    "upsert_applications", "upsert_paids", "replace_slice", "json_applications",
    "lender_conversion_all", "notifications_all", "reconcile_summary",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from ledgerlens.plans.catalog import QUERIES
    from ledgerlens.session import get_session
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n in QUERIES]
    spark = get_session(f"local[{cpus}]", app="ledgerlens-bench", shuffle_partitions=cpus * 2,
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    # warm-up: JVM, parquet footers, codegen caches
    QUERIES["moment_l12m"][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for n in names:
        t0 = time.perf_counter()
        QUERIES[n][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
