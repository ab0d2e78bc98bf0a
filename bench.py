"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (no driver collect).
Prints one JSON line: {"metric", "value", "unit", "queries", "sf"}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "snapshots",                 # B1-B12: derivation + as-of snapshots (no shuffle after the journey join)
    "snapshots_events_path",     # B8 events path: fixed-size pivot + co-partitioned join
    "quality_report",            # C1-C13
    "split_manifest",            # D1 exact-quota split without a global rank
    "oof_route_median",          # F8 median leave-fold-out encoder
    "oof_route_rate",            # F8 mean leave-fold-out encoder (no replication)
    "oof_typical",               # F9
    "median_impute",             # F12
    "baseline_regression_metrics",  # G0-G2 + J1 grouping sets
    "risk_metrics",              # J2-J4 incl. two-phase average precision
    "calibration_table",         # J5
    "eda_delay_histogram",       # K12
    "recommendations",           # L5
    "eta_predictions",           # H1-H9: four GBT fits + scoring
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from milepost.session import build_session
    from milepost.plans.queries import REGISTRY

    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    names = [n for n in HEADLINE if n in REGISTRY]
    # warm-up: JVM, codegen caches and parquet footers
    REGISTRY["snapshot_trigger"].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    timings = {}
    for name in names:
        t0 = time.perf_counter()
        REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
