"""Time the headline queries and print one JSON line.

BENCH_SF_DIR  folder with the tables (default /root/testdata/sf0.1)
BENCH_CPUS    cores of the local session (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from rosterweave.session import spark_session  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINE = [
    "payroll_latest", "benefits_current", "benefits_history", "clean_reports", "pass1_resolved",
    "pass2_resolved", "fuzzy_pairs", "ghosts", "dq_report", "salary_distribution",
    "enrollment_rate", "golden_employees",
]


def seconds(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = spark_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": cpus,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds(spark, "namespace_ids", folder)  # starts the session and the Python gateway
    times = {name: seconds(spark, name, folder) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "record_integration_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
