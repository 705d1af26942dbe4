"""Wall seconds of the headline queries; prints one JSON line.

BENCH_SF_DIR names the data folder and BENCH_CPUS the local cores. Each query is
planned and run in full, with its rows thrown away at the end; the best of
BENCH_RUNS runs counts. One untimed query warms the JVM up.
"""

from __future__ import annotations

import json
import os
import re
import time

from loanlake.plans.catalog import run_query
from loanlake.session import local_session

HEADLINE = [
    "clean_applications",
    "clean_repayments",
    "clean_credit",
    "dim_applicants",
    "dim_employment",
    "dim_contact_info",
    "dim_next_of_kin",
    "fact_loans",
    "repayments_summary",
    "loan_performance_mart",
    "report_default_by_band",
    "report_repaid_by_income",
    "report_monthly_applications",
    "dq_staging_suite",
    "legacy_employment",
]


def seconds(spark, name: str, folder: str) -> float:
    started = time.perf_counter()
    run_query(name, spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    seconds(spark, HEADLINE[0], folder)
    times = {
        name: round(min(seconds(spark, name, folder) for _ in range(runs)), 3)
        for name in HEADLINE
    }
    scale = re.search(r"sf([\d.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "total wall time of headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
