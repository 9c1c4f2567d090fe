"""Benchmark the headline queries; print one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query is executed in full through the ``noop`` sink (no collect), after
a warm-up pass over sf0.001 so JVM start-up and JIT are not charged to the
first timed query. Each query runs BENCH_RUNS times (default 2); ``queries``
holds the best run, ``first_run`` the first.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from obsflow.plans.catalog import QUERIES  # noqa: E402
from obsflow.session import build_session  # noqa: E402

HEADLINE = [
    "batch_hours",  # full job: dedup, joins, rules, staged write, gated publish, roll-up
    "dedup_latest",
    "enrich_context",
    "capacity_anomalies",
    "site_hour_rollup",
    "zone_hour_rollup",
    "quality_gate",
    "keyed_merge",
    "time_text_parse",
    "context_csv_roundtrip",
]


RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus * 2, extra={"spark.driver.memory": "8g"})
    # JIT warm-up on the smallest data set, so start-up is not charged to the
    # first timed query.
    warm = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):
        for name in HEADLINE:
            QUERIES[name](spark, warm).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    first: dict[str, float] = {}
    for name in HEADLINE:
        runs = []
        for _ in range(RUNS):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(round(time.perf_counter() - t0, 3))
        first[name], times[name] = runs[0], min(runs)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
        "runs": RUNS,
        "first_run": first,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
