"""Write PLANS.md: formatted physical plans of the key queries.

Usage: python tools/plans_report.py [sf_dir]

For each query: the operator tree and the scan nodes' details (pushed
filters, read schema), as planned with AQE on before execution.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from obsflow.plans import catalog, roles  # noqa: E402
from obsflow.plans.batch_job import _lookups, build_rows, latest_published, row_columns, run_batch  # noqa: E402
from obsflow.session import build_session, new_work_path  # noqa: E402
from obsflow.sinks import bucketed  # noqa: E402
from obsflow.streaming.jobs import landing_table  # noqa: E402


def formatted(df) -> str:
    qe = df._jdf.queryExecution()
    return df.sparkSession._jvm.PythonSQLUtils.explainString(qe, "formatted")


def trim(plan: str) -> str:
    """Tree, plus the details of scans and exchanges only."""
    parts = plan.split("\n\n")
    tree = parts[0]
    keep = [p for p in parts[1:] if p.lstrip().startswith("(") and ("Scan " in p.split("\n")[0] or "Exchange" in p.split("\n")[0])]
    return "\n\n".join([tree, *keep])


def main() -> None:
    d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session()
    s = catalog.DRIVER_SETTINGS
    args = (roles.observations(spark, d), roles.sites(spark, d), roles.context(spark, d))
    ovr = roles.zone_overrides(spark, d)
    # As the job does it: both small sides are written first and read back.
    dims = _lookups(spark, *args[1:], s, ovr, new_work_path(spark, "plans"))
    staged = build_rows(args[0], *dims, s).select(*row_columns(s), "disposition")
    keyed = build_rows(roles.observation_base(spark, d), *dims, dataclasses.replace(s, dedup_input=False))
    landing = roles.observation_base(spark, d).drop("event_id").withColumn("obs_date", F.to_date("obs_ts"))
    table = landing_table(f"{new_work_path(spark, 'plans')}/landing", landing.schema, buckets=8)
    bucketed.merge(spark, table, landing, [r[0] for r in landing.select("obs_date").distinct().collect()])
    some = landing.filter(F.col("obs_date").between("2024-01-10", "2024-01-12"))
    out = new_work_path(spark, "plans")
    run_batch(spark, args[0], *args[1:], out, s, ovr)
    items = [
        ("Batch job, staged rows (one dedup shuffle, joins of the written lookups)", staged),
        ("Batch job, keyed input (no dedup shuffle)", keyed.select(*row_columns(s), "disposition")),
        ("Merge into the bucketed landing table (no Exchange on the stored side)", bucketed.merged(spark, table, some, [dt.date(2024, 1, n) for n in (10, 11, 12)])),
        ("Resume point (newest month only)", latest_published(spark, out, s)),
        ("raw_variant (paths of the VARIANT are read, not the value)", catalog.QUERIES["raw_variant"](spark, d)),
        ("site_day_scan (clustered files, pushed filters)", catalog.QUERIES["site_day_scan"](spark, d)),
        ("context_csv_lines (no whole texts)", catalog.QUERIES["context_csv_lines"](spark, d)),
        ("site_hour_rollup", catalog.QUERIES["site_hour_rollup"](spark, d)),
        ("keyed_merge", catalog.QUERIES["keyed_merge"](spark, d)),
        ("date_range_scan (pushdown and pruning)", catalog.QUERIES["date_range_scan"](spark, d)),
        ("backfill_plan (scalar subquery, no cross join)", catalog.QUERIES["backfill_plan"](spark, d)),
    ]
    out = ["# PLANS", "", f"Physical plans on `{d}` (AQE on, before execution), from `tools/plans_report.py`.", ""]
    for title, df in items:
        out += [f"## {title}", "", "```", trim(formatted(df)).strip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
