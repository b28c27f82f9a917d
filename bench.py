"""Time the registered queries on one machine and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from vacancylake.plans import queries as registry  # noqa: E402
from vacancylake.session import local_session  # noqa: E402

#: Headline queries: one or more of every operator family.
HEADLINE = [
    "listings_per_host",
    "canonicalize_url",
    "parse_loose_date",
    "flatten_greenhouse",
    "flatten_workday",
    "extract_listings",
    "count_selector_matches",
    "classify_challenge",
    "to_records",
    "dedupe",
    "duplicates",
    "upsert_jobs",
    "reconcile_threshold",
    "jobs_with_company",
    "apply_translations",
    "dashboard_stats",
    "company_stats",
    "run_totals",
    "classify_extraction",
    "detect_zero_jobs",
    "detect_timeout_pattern",
    "drift_zero_matches",
    "pacing_audit",
    "recent_attempts",
    "paginate",
    "export_rows",
    "application_sheet",
    "stream_zero_jobs",
    "stream_upsert",
    "extract_known_sources",
    "snapshot_listings",
    "snapshot_attempts",
    "monitoring_alerts",
    "csv_export",
    "stream_selector_drift",
]


def run(spark, folder: str, name: str) -> None:
    df = registry.runnable(registry.QUERIES[name])(spark, folder)
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    names = sys.argv[1:] or HEADLINE
    partitions = 8 if cores == "*" else max(4, int(cores))
    spark = local_session("vacancylake-bench", cores=cores, partitions=partitions)
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/orders.parquet").count()
    timings: dict[str, float] = {}
    for name in names:
        laps = []
        for _ in range(repeats + 1):
            start = time.perf_counter()
            run(spark, folder, name)
            laps.append(time.perf_counter() - start)
        warm = sorted(laps[1:])
        timings[name] = round(warm[len(warm) // 2], 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
