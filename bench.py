"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data (default sf0.1), ``BENCH_CPUS`` the local cores,
``BENCH_QUERIES`` another choice (comma-separated, or ``all``) and ``BENCH_RUNS``
the runs per query, of which the fastest counts. Results go to Spark's noop sink, so
every row and column is computed and none is collected.
"""

from __future__ import annotations

import json
import os
import re
import time

from tablebridge.registered import QUERIES
from tablebridge.session import local_session

HEADLINE = (
    "conform_newcol",
    "conform_cast",
    "conform_nested",
    "align_documents",
    "type_profile",
    "schema_report",
    "shape_groups",
    "normalise_typed",
    "normalise_sql",
    "homogenise_arrays",
    "quarantine_rows",
    "bulk_payloads",
    "scan_documents",
    "migrate_documents",
    "migrate_table",
    "reconcile",
    "stream_migrate",
)

# Input table of the queries whose rows per second are reported.
RATED = {
    "conform_newcol": "events",
    "align_documents": "events",
    "bulk_payloads": "events",
    "migrate_documents": "events",
    "migrate_table": "orders",
    "reconcile": "lineitem",
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    asked = os.environ.get("BENCH_QUERIES", "")
    chosen = list(QUERIES) if asked == "all" else [name for name in asked.split(",") if name] or list(HEADLINE)
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, memory="12g")

    def seconds(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    times = {name: round(min(seconds(name) for _ in range(runs)), 3) for name in chosen}
    rates = {
        name: round(spark.read.parquet(f"{sf_dir}/{table}.parquet").count() / times[name])
        for name, table in RATED.items()
        if name in times
    }
    found = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": f"total seconds of {len(times)} queries, fastest of {runs} runs each",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "rows_per_sec": rates,
                "sf": float(found.group(1)) if found else None,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
