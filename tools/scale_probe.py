"""Time the batch job on a larger fact table derived from the driver's events.

Usage: python tools/scale_probe.py [sf_dir] [copies] [hot]

The observations are ``copies`` copies of the sf_dir events, each shifted by
a whole number of 30-day periods, so keys stay distinct and the rows spread
over many months (and output partitions). With ``hot=1`` a third of all
rows are reassigned to one site, the skew the job must absorb. Prints one
JSON line: rows, seconds, rows per second, published counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from obsflow.plans import catalog, roles  # noqa: E402
from obsflow.plans.batch_job import run_batch  # noqa: E402
from obsflow.session import build_session, new_work_path  # noqa: E402


def main() -> None:
    d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 20
    hot = len(sys.argv) > 3 and sys.argv[3] == "1"
    spark = build_session(shuffle_partitions=32, extra={"spark.driver.memory": "8g"})
    base = roles.observations(spark, d)
    # Each row is repeated once per copy (explode, no join), shifted by
    # 30-day periods so the copies are distinct observations.
    obs = base.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    obs = obs.withColumn("obs_ts", F.timestamp_add("DAY", F.col("copy") * 30, F.col("obs_ts")))
    obs = obs.withColumn("event_id", F.col("event_id") * copies + F.col("copy"))
    if hot:
        # The first third of the copies all report as one site.
        obs = obs.withColumn("site_id", F.when(F.col("copy") < copies // 3, F.lit(1)).otherwise(F.col("site_id")))
    # A real input is many files read in parallel; the derived table comes
    # from one single-row-group file, so spread it the way a scan would.
    obs = obs.drop("copy").repartition(32)
    n = obs.count()
    t0 = time.perf_counter()
    res = run_batch(
        spark, obs, roles.sites(spark, d), roles.context(spark, d), new_work_path(spark, "scale"),
        catalog.DRIVER_SETTINGS, roles.zone_overrides(spark, d),
    )
    dt = time.perf_counter() - t0
    m = res.metrics
    print(json.dumps({
        "rows": n, "hot_site": hot, "seconds": round(dt, 2), "rows_per_sec": round(n / dt),
        "n_final": m["n_final"], "n_orphans": m["n_orphans"], "published": res.published,
        "verified": (res.verification or {}).get("ok"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
