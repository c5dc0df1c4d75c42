"""Headline queries, timed end to end: build the plan, run it, drop the rows.

One JSON line on stdout. BENCH_SF_DIR and BENCH_CPUS choose data and cores.
Every query runs once to warm up the JVM and is then timed.
"""

from __future__ import annotations

import json
import os
import sys
import time

from claimgauge.plans.registered import registered
from claimgauge.session import local_session

HEADLINE = (
    "completeness_summary",
    "validity_summary",
    "monthly_reconciliation",
    "dropoff_by_month",
    "dropoff_by_period",
    "mismatch_reason",
    "normalization_recovery",
    "top_dropped_claims",
    "unmatched_members",
    "unmatched_member_months",
    "enrollment_footprint",
    "nearby_enrollment",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores, shuffle_partitions=cores)
    queries, seconds = registered(), {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
