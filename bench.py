"""Benchmark: every registered query on $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS]. Each query runs to completion through the ``noop`` sink (full plan,
no rows pulled to the driver): one warm-up run, then the median of $BENCH_REPS runs.
Prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bramble.session import get_spark  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    only = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k]
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=cpus,
                      extra={"spark.driver.memory": "16g", "spark.sql.ui.retainedExecutions": "20",
                             "spark.ui.retainedJobs": "50", "spark.ui.retainedStages": "50"})
    spark.sparkContext.setLogLevel("ERROR")
    from bramble.plans.registry import QUERIES

    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name, q in QUERIES.items():
        if only and name not in only:
            continue
        runs = []
        try:
            for i in range(reps + 1):
                t0 = time.perf_counter()
                q(spark, sf_dir).write.format("noop").mode("overwrite").save()
                if i:  # first run warms up
                    runs.append(time.perf_counter() - t0)
            times[name] = round(statistics.median(runs), 4)
        except Exception as e:  # noqa: BLE001 - report and go on, the JSON line must be printed
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "sum of per-query median seconds", "value": round(sum(times.values()), 3),
           "unit": "sec", "queries": times, "sf": sf, "cpus": cpus, "reps": reps}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
