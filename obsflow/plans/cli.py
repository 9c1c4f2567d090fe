"""Run the batch job from a JSON config: ``spark-submit obsflow/plans/cli.py --config job.json``.

The session is the cluster's (``getOrCreate``): its configuration, object
store options and ``spark.checkpoint.dir`` come from spark-submit. Example:

    {
      "observations": {"kind": "landed", "format": "mongodb",
                       "options": {"database": "lake", "collection": "observations"}},
      "sites": {"pages": "s3a://raw/sites/pages/"},
      "context": {"kind": "landed", "format": "mongodb",
                  "options": {"database": "lake", "collection": "context"}},
      "overrides": [[4242, "North Quay"]],
      "out": "s3a://analytics/observations",
      "time_zone": "Europe/Paris",
      "time_range": ["2026-08-27", "2026-09-02"],
      "layout": "reference",
      "orphan_on": "site_name",
      "enforce_gate": true,
      "dedup_input": true
    }

``dedup_input: false`` when the observations come from the keyed landing
table (the streaming landing merge), which holds one row per key.
``"mode": "incremental"`` (with optional ``start``/``end`` dates) resumes
from the published table instead of taking ``time_range``.

``kind`` of observations: ``landed`` (station_id, horodate text, ...),
``raw_items`` (feed items with nested counts), ``raw_lines`` (text files with one
item a line: the received line is the column ``raw``, undeclared fields included;
list it in ``extra_columns`` to publish it; lines that are no item are quarantined
with it) or ``canonical``. Context: ``landed`` (commune, datetime instant,
measures), ``csv_archive`` (raw CSV files of any size; needs ``zones``: a table of
zone, lat, lon; unreadable rows are counted and kept below ``context_rejects`` of
``out``) or ``canonical``.
Dates are local dates of ``time_zone``. ``measures``, ``extra_columns`` and
``temperature_col`` choose the context figures and observation columns carried
along; ``gate_rules`` lists the rules that block publication (by default all;
``[]`` counts everything and blocks nothing). ``keep_staging`` keeps the staged
rows for the diagnostics. ``snapshots`` publishes behind one pointer,
``cluster_by`` orders the rows of a month, ``require_observations`` fails a run that
reads nothing, ``range_date_is`` (``landing`` or ``utc``) says what
``range_date_col`` holds.
Prints the metrics and verdict as one JSON line; exit code 2 when the gate
refused publication; an error, and nothing published, when a count is wrong.
"""

from __future__ import annotations

import argparse
import dataclasses
import json
import sys
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from obsflow.operators.reshape import context_from_landed, flatten_items, from_landed, items_from_lines
from obsflow.operators.rules import GATE_RULES
from obsflow.plans.batch_job import BatchSettings, run_batch, run_incremental
from obsflow.schemas import LANDED_OBSERVATION, RAW_OBSERVATION_ITEM, SITE_RECORD
from obsflow.sources.context_csv import accept_context, context_from_lines, read_lines
from obsflow.session import new_work_path
from obsflow.sources.pages import read_sites
from obsflow.sources.store import load_table


def _load(spark: SparkSession, spec: Mapping, schema=None) -> DataFrame:
    return load_table(spark, spec.get("format", "parquet"), schema, spec.get("path"), spec.get("options"))


def observations(spark: SparkSession, spec: Mapping) -> DataFrame:
    kind = spec.get("kind", "landed")
    if kind == "landed":
        return from_landed(_load(spark, spec, LANDED_OBSERVATION))
    if kind == "raw_items":
        return flatten_items(_load(spark, spec, RAW_OBSERVATION_ITEM), keep_raw=False)
    if kind == "raw_lines":
        return flatten_items(items_from_lines(spark.read.text(spec["path"])))
    if kind == "canonical":
        return _load(spark, spec)
    raise ValueError(f"unknown observations kind {kind!r}")


def sites(spark: SparkSession, spec: Mapping) -> DataFrame:
    if "pages" in spec:
        return read_sites(spark, spec["pages"])
    from obsflow.operators.reshape import sites_from_records

    return sites_from_records(_load(spark, spec, SITE_RECORD))


def context(spark: SparkSession, spec: Mapping, tz: str) -> DataFrame:
    kind = spec.get("kind", "landed")
    if kind == "landed":
        return context_from_landed(_load(spark, spec))
    if kind == "csv_archive":
        zones = _load(spark, spec["zones"]) if "zones" in spec else None
        return context_from_lines(read_lines(spark, spec["path"]), tz, zones)
    if kind == "canonical":
        return _load(spark, spec)
    raise ValueError(f"unknown context kind {kind!r}")


def settings_from(cfg: Mapping) -> BatchSettings:
    keys = (
        "time_zone",
        "slot_minutes",
        "orphan_on",
        "enforce_gate",
        "publish_mode",
        "layout",
        "dedup_input",
        "on_duplicate",
        "keep_staging",
        "range_date_col",
        "range_date_is",
        "require_observations",
        "snapshots",
        "temperature_col",
    )
    kw = {k: cfg[k] for k in keys if k in cfg}
    if "dedup_order" in cfg:
        kw["dedup_order"] = tuple(cfg["dedup_order"])
    if "time_range" in cfg:
        kw["time_range"] = tuple(cfg["time_range"])
    for k in ("measures", "extra_columns", "cluster_by"):
        if k in cfg:
            kw[k] = tuple(cfg[k])
    if "gate_rules" in cfg:  # the names of the rules that block; the others are only counted
        known = {r.name: r for r in GATE_RULES}
        unknown = [n for n in cfg["gate_rules"] if n not in known]
        if unknown:
            raise ValueError(f"unknown gate rules {unknown}; known: {sorted(known)}")
        kw["gate_rules"] = tuple(dataclasses.replace(r, blocking=r.name in cfg["gate_rules"]) for r in GATE_RULES)
    return BatchSettings(**kw)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--config", required=True)
    args = ap.parse_args(argv)
    with open(args.config, encoding="utf-8") as f:
        cfg = json.load(f)
    spark = spark or SparkSession.builder.getOrCreate()
    s = settings_from(cfg)
    overrides = None
    if cfg.get("overrides"):
        overrides = spark.createDataFrame([tuple(p) for p in cfg["overrides"]], "site_id bigint, zone string")
    series, figures = context(spark, cfg["context"], s.time_zone), {}
    if "row_ok" in series.columns:
        run = new_work_path(spark, "context").rsplit("/", 1)[-1]
        series, figures = accept_context(spark, series, f"{cfg['out'].rstrip('/')}/context_rejects/run_id={run}")
    args = (
        spark,
        observations(spark, cfg["observations"]),
        sites(spark, cfg["sites"]),
        series,
        cfg["out"],
        s,
        overrides,
    )
    if cfg.get("mode", "batch") == "incremental":
        res = run_incremental(*args, start=cfg.get("start"), end=cfg.get("end"))
    else:
        res = run_batch(*args)
    res.metrics |= figures
    print(json.dumps(res.as_dict(), default=str))
    return 0 if res.published or not s.enforce_gate else 2


if __name__ == "__main__":
    sys.exit(main())
