"""Time the headline queries and print one JSON line.

Reads the test tables at $BENCH_SF_DIR on local[$BENCH_CPUS]. Every query is worked out in
full into the no-op sink, so neither column pruning nor the transfer to Python
distorts its time.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from entity360.registry import run  # noqa: E402

HEADLINE = (
    "bridge_source",
    "dim_company",
    "deal_events",
    "startup_project_events",
    "membership_events",
    "services_project_events",
    "engagement_ledger",
    "membership_status",
    "membership_status_future",
    "current_membership",
    "membership_history",
    "engagement_counts",
    "engagement_timeline",
    "typed_engagements",
    "company_mart",
    "qa_multi_id_groups",
    "qa_ledger_null_rates",
    "reconcile_mismatches",
    "reconcile_summary",
    "smoke_status_distribution",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("entity360-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    run("bridge_source", spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.perf_counter()
        run(name, spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
