"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

The driver's tables are read as they are: single files with one row group, which one task reads.
With BENCH_COPY=1 they are first copied (untimed) into a file per core, as a cluster's table would have.
Each query is executed in full with the ``noop`` sink (no collect to the
driver) after one warm-up pass over the input tables and one untimed run of
the flagship query (JVM warm-up); each query reports the best of
$BENCH_REPS runs (default 2; this VM's timings vary by about 30 %). Prints ONE
JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fleetspark.plans import catalog  # noqa: E402
from fleetspark.session import build_session  # noqa: E402

HEADLINE = [
    "bucket_avg_label", "dew_point", "series_long", "bucket_wide", "latest_value", "latest_staleness",
    "state_intervals", "gap_segments", "device_overview", "recent_updates", "update_decisions",
    "rollout_coverage", "route_counts", "ingest_measurements", "update_attempts", "backfill",
    "flatten_power", "alert_power", "fleet_metrics", "upsert_devices_status",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", app="fleetspark-bench", shuffle_partitions=max(8, cpus * 2))
    scale, copied = re.search(r"sf([0-9.]+)", sf_dir), os.environ.get("BENCH_COPY") == "1"
    copy = tempfile.mkdtemp(prefix="fleetspark-bench-") if copied else sf_dir
    for t in ("events", "lineitem", "orders", "customer"):
        if copied:
            spark.read.parquet(f"{sf_dir}/{t}.parquet").repartition(cpus).write.parquet(f"{copy}/{t}.parquet")
        spark.read.parquet(f"{copy}/{t}.parquet").write.format("noop").mode("overwrite").save()
    sf_dir = copy
    # JVM warm-up (class loading, JIT): one untimed run of the flagship query
    catalog.run("bucket_avg_label", spark, sf_dir).write.format("noop").mode("overwrite").save()
    reps = int(os.environ.get("BENCH_REPS", "2"))
    times = {}
    for n in names:
        best = None
        for _ in range(reps):
            t0 = time.perf_counter()
            catalog.run(n, spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[n] = round(best, 3)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(scale.group(1)) if scale else None, "cpus": cpus,
                      "reps": reps, "copied": copied}))


if __name__ == "__main__":
    main()
