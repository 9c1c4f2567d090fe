"""The full batch job as one plan (ENR6), published behind a gate.

Shape of the work, whatever the data size:

1. the site lookup and the context series are reduced to one row per key and
   written once; the joins read these small tables, whose true size lets Spark
   choose between broadcast and shuffle;
2. one scan of the observations (the date range pushed to Parquet);
3. one shuffle for the deduplication, with partial aggregation before it;
4. rules, rate and calendar columns as projections in the same stage;
5. one staged write, partitioned by (disposition, year, month), which also
   measures every figure of the quality reports through ``observe``;
6. the rejected rows, with reasons, are kept as ``rejects/run_id=...``;
7. if the gate passes, the new rows of the touched months and their hourly
   roll-up are written aside, counted, and put in place together: by renames, or
   (``snapshots``) by one new pointer file that readers resolve. An error before
   that leaves the published tables as they were.

The staged table is a written table in the shared folder: it cuts the
lineage, so a lost executor after step 5 costs no recomputation from the
sources, and the 20 re-reads of the reference collapse into this one pass.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from obsflow.functions.time import local_day_bounds
from obsflow.operators.dedup import dedup_latest
from obsflow.operators.enrich import (
    attach_context,
    attach_sites,
    context_lookup,
    site_lookup,
    with_fill_rate,
    with_local_calendar,
    with_slot,
)
from obsflow.operators.incremental import in_date_range, newest_partition
from obsflow.operators.joins import require_unique
from obsflow.operators.quality import gate_verdict
from obsflow.operators.rollup import SITE_HOUR_KEYS, hourly_rollup
from obsflow.operators.rules import CONSISTENCY_RULES, GATE_RULES, Rule, rule_counts
from obsflow.plans.layouts import HOUR_NAMES, QUALITY_NAMES, ROW_NAMES, publish_as, read_as_library
from obsflow.session import new_work_path
from obsflow.sinks import versions
from obsflow.sinks.parquet import (
    partition_folders,
    remove_folder,
    swap_folders,
    table_exists,
    write_empty,
    write_partitioned,
)

OK, ANOMALY, ORPHAN, KEY_NULL = "ok", "anomaly", "orphan", "key_null"

DEFAULT_MEASURES = (
    "temperature_2m_c",
    "apparent_temperature_c",
    "relative_humidity_2m_pct",
    "precipitation_mm",
    "rain_mm",
    "wind_speed_10m_kmh",
    "weather_code",
)


@dataclass(frozen=True)
class BatchSettings:
    time_zone: str = "Europe/Paris"
    slot_minutes: int = 15
    measures: Sequence[str] = DEFAULT_MEASURES
    temperature_col: str = "temperature_2m_c"
    orphan_on: str = "site_key"
    dedup_order: Sequence[str] = ()
    # False when the observations come from the keyed landing table (one
    # row per key by construction): the fact side is then never shuffled
    # before the staged write.
    dedup_input: bool = True
    consistency_rules: Sequence[Rule] = CONSISTENCY_RULES
    gate_rules: Sequence[Rule] = GATE_RULES
    enforce_gate: bool = True
    # Repeated dimension/context keys: "dedup" (greatest record) or "raise" (m17).
    on_duplicate: str = "dedup"
    # Inclusive range of local dates [start, end]; pushed to both inputs' scans.
    time_range: tuple[str, str] | None = None
    # Partition column of the observations that holds a date, if there is one:
    # the range then prunes folders too. "landing": the date of arrival (bounds
    # below only); "utc": the UTC date of the observation, as the landing merge
    # keeps it (bounds both sides, checked).
    range_date_col: str | None = "obs_date"
    range_date_is: str = "landing"
    # "replace": the run owns everything it covers: the whole table, or with a
    # range the rows in it; rows outside the range stay.
    # "merge": the run owns the keys it read: accepted ones are upserted, and
    # ones that are rejected now leave the table.
    publish_mode: str = "replace"
    # A run that reads no observation raises before it publishes. Without this,
    # "replace" leaves the table, or the range, empty: the run owns it.
    require_observations: bool = False
    # False: year/month folders below rows and hours, swapped in by renames.
    # True: folders of the run's own behind one pointer (``sinks.versions``); read
    # such tables with ``published_table``.
    snapshots: bool = False
    # Columns by which the published rows lie in order inside a month, so that a
    # filter on them skips row groups; () leaves them as they were staged.
    cluster_by: Sequence[str] = ()
    # Keep the staged rows after a successful publication (the diagnostics of
    # ``reports.run_reports`` read them). They are a full copy of the run.
    keep_staging: bool = False
    # "neutral": library column names; "reference": the reference's
    # published names (station_id, horodate_ts, ..., partitions annee/mois).
    layout: str = "neutral"
    extra_columns: Sequence[str] = field(default_factory=tuple)


def row_columns(settings: BatchSettings) -> list[str]:
    return [
        "site_id",
        "site_name",
        "zone",
        "lat",
        "lon",
        "obs_ts",
        "slot_ts",
        "status",
        "capacity",
        "available",
        "free",
        *settings.measures,
        *settings.extra_columns,
        "fill_rate",
        "obs_local",
        "year",
        "month",
        "day",
        "hour",
    ]


def _append_quality(spark: SparkSession, path: str, run_id: str, metrics: dict, verdict: dict, s: BatchSettings) -> None:
    """One row per run: the gate figures after the filters and the verdict (DQ6).

    Built from the observed metrics (a handful of numbers on the driver),
    appended so the table keeps the history of runs.
    """
    names = [r.name for r in s.gate_rules]
    fields = ["run_id string", "n_rows bigint", *[f"{n} bigint" for n in names], "passed boolean", "failed_rules string"]
    values = (
        run_id,
        int(metrics["n_final"]),
        *[int(metrics.get(f"final_{n}", 0) or 0) for n in names],
        bool(verdict["passed"]),
        ",".join(verdict["failed_rules"]),
    )
    row = spark.createDataFrame([values], ", ".join(fields))
    if s.layout == "reference":
        row = publish_as(row, QUALITY_NAMES)
    row.write.mode("append").parquet(path)


def published_table(spark: SparkSession, out_dir: str, table: str, months: Sequence[tuple[int, int]] | None = None, parts: Sequence[str] = ("year", "month")) -> DataFrame:
    """A published table (``rows`` or ``hours``), whichever way it is published.

    With ``months`` (a handful of literals) other months are neither listed nor
    read.
    """
    at = versions.snapshot(spark, out_dir)
    if at is not None:
        folders = None if months is None else ["/".join(f"{p}={v}" for p, v in zip(parts, ym, strict=True)) for ym in months]
        return versions.read_table(spark, out_dir, table, at, folders)
    df = spark.read.parquet(f"{out_dir.rstrip('/')}/{table}")
    if months is None:
        return df
    wanted = F.lit(False)
    for ym in months:
        wanted = wanted | ((F.col(parts[0]) == ym[0]) & (F.col(parts[1]) == ym[1]))
    return df.filter(wanted)


def published_rows(spark: SparkSession, rows_path: str, months: Sequence[tuple[int, int]], names: dict) -> DataFrame:
    """Published rows of the given months, in library names."""
    parts = [names.get(c, c) for c in ("year", "month")]
    return read_as_library(published_table(spark, rows_path.rsplit("/", 1)[0], "rows", months, parts), names)


def published_months(spark: SparkSession, out_dir: str, names: dict) -> list[tuple[int, int]]:
    """Months that have a folder, in order; found by listing folders."""
    parts = [names.get(c, c) for c in ("year", "month")]
    at = versions.snapshot(spark, out_dir)
    found = at.tables["rows"].folders if at is not None else partition_folders(spark, f"{out_dir.rstrip('/')}/rows", parts)
    values = [[v.split("=", 1)[1] for v in f.split("/")] for f in found]
    return sorted((int(y), int(m)) for y, m in values if y.isdigit() and m.isdigit())


def range_months(time_range: tuple[str, str]) -> list[tuple[int, int]]:
    """Local months that an inclusive range of local dates touches."""
    (y, m), (y1, m1) = (tuple(map(int, str(d).split("-")[:2])) for d in time_range)
    out = []
    while (y, m) <= (y1, m1):
        out.append((y, m))
        y, m = (y, m + 1) if m < 12 else (y + 1, 1)
    return out


def _layout(s: BatchSettings) -> tuple[dict, dict]:
    if s.layout == "reference":
        return dict(ROW_NAMES), dict(HOUR_NAMES)
    if s.layout == "neutral":
        return {}, {}
    raise ValueError(f"layout must be 'neutral' or 'reference', not {s.layout!r}")


def build_rows(
    obs: DataFrame,
    sites: DataFrame,
    context: DataFrame,
    settings: BatchSettings = BatchSettings(),
    overrides: DataFrame | None = None,
) -> DataFrame:
    """Every observation, deduplicated, enriched and given a disposition.

    ``disposition`` is ok / anomaly / orphan / key_null and ``reasons`` lists
    the rules broken, so accepted and quarantined rows come from one plan.
    Rows with a NULL key part are kept (only exact copies of each other
    collapse) and quarantined rather than merged by a NULL key.
    """
    s = settings
    if s.time_range:
        date_col = s.range_date_col if s.range_date_col in obs.columns else None
        obs = in_date_range(obs, *s.time_range, s.time_zone, "obs_ts", date_col, date_is=s.range_date_is)
        context = in_date_range(context, *s.time_range, s.time_zone, "ctx_ts", widen=f"{s.slot_minutes} minutes")
    if s.dedup_input:
        keyed = F.col("site_id").isNotNull() & F.col("obs_ts").isNotNull()
        others = [c for c in obs.columns if c not in ("site_id", "obs_ts")]
        obs = obs.withColumn("__nk", F.when(~keyed, F.to_json(F.struct(*others))))
        dedup = dedup_latest(obs, ["site_id", "obs_ts", "__nk"], s.dedup_order).drop("__nk")
    else:
        dedup = obs

    df = attach_sites(dedup, sites, overrides, s.orphan_on, s.on_duplicate)
    df = with_slot(df, "obs_ts", "slot_ts", s.slot_minutes)
    df = attach_context(df, context, s.measures, on_duplicate=s.on_duplicate)
    df = with_fill_rate(df)
    df = with_local_calendar(df, s.time_zone)

    keyed = F.col("site_id").isNotNull() & F.col("obs_ts").isNotNull()
    rule_names = [F.when(r.flag(), F.lit(r.name)) for r in s.consistency_rules]
    reasons = F.array_compact(
        F.array(F.when(~keyed, F.lit("key_part_null")), F.when(F.col("is_orphan"), F.lit("orphan")), *rule_names)
    )
    broken = F.lit(False)
    for r in s.consistency_rules:
        broken = broken | r.flag()
    disposition = (
        F.when(~keyed, F.lit(KEY_NULL))
        .when(F.col("is_orphan"), F.lit(ORPHAN))
        .when(broken, F.lit(ANOMALY))
        .otherwise(F.lit(OK))
    )
    return df.withColumns({"reasons": reasons, "disposition": disposition})


def observed_figures(settings: BatchSettings) -> list[Column]:
    """Every figure of the reports, as aggregates over the staged rows."""
    disp = F.col("disposition")
    matched = disp.isin(OK, ANOMALY)
    ok = disp == OK
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(disp == KEY_NULL).alias("n_key_null"),
        F.count_if(matched).alias("n_matched"),
        F.count_if(disp == ORPHAN).alias("n_orphans"),
        F.count_if(disp == ANOMALY).alias("n_anomalies"),
        F.count_if(ok).alias("n_final"),
        F.count_if(ok & ~F.col("has_context")).alias("n_final_without_context"),
        *rule_counts(settings.consistency_rules, prefix="anomaly_", where=matched),
        # Gate measured after the filters (as the reference) and before them (m15).
        *rule_counts(settings.gate_rules, prefix="final_", where=ok),
        *rule_counts(settings.gate_rules, prefix="matched_", where=matched),
    ]


@dataclass
class BatchResult:
    metrics: dict
    verdict: dict
    published: bool
    staging_path: str
    rows_path: str
    hours_path: str
    rejects_path: str = ""
    verification: dict | None = None

    def as_dict(self) -> dict:
        return self.__dict__.copy()


def _lookups(spark: SparkSession, sites: DataFrame, context: DataFrame, s: BatchSettings, overrides: DataFrame | None, work: str):
    """Both small sides reduced to one row per key and written once."""
    if s.on_duplicate == "raise":
        require_unique(sites, ["site_id"], "site dimension")
        require_unique(context, ["zone", "ctx_ts"], "context series")
    if s.time_range:
        context = in_date_range(context, *s.time_range, s.time_zone, "ctx_ts", widen=f"{s.slot_minutes} minutes")
    out = []
    for name, df in (("sites", site_lookup(sites, overrides)), ("context", context_lookup(context, s.measures))):
        df.write.parquet(f"{work}/{name}")
        out.append(spark.read.schema(df.schema).parquet(f"{work}/{name}"))
    return out


def _survivors(current: DataFrame, staged: DataFrame, s: BatchSettings) -> DataFrame:
    """Published rows that the run does not own."""
    if s.publish_mode == "replace":
        lo, hi = local_day_bounds(*s.time_range, s.time_zone)
        return current.filter(~((F.col("obs_ts") >= lo) & (F.col("obs_ts") < hi)))
    # Every key that was read again, accepted or not, replaces what was there.
    again = staged.filter(F.col("disposition") != KEY_NULL).select("site_id", "obs_ts")
    return current.join(again, ["site_id", "obs_ts"], "left_anti")


def run_batch(
    spark: SparkSession,
    obs: DataFrame,
    sites: DataFrame,
    context: DataFrame,
    out_dir: str,
    settings: BatchSettings = BatchSettings(),
    overrides: DataFrame | None = None,
) -> BatchResult:
    """Stage (one pass over the sources), measure, gate, publish, roll up.

    A run owns what it says (``publish_mode``): if nothing is accepted, the table,
    the range or the keys it read are empty afterwards. Nothing is published if
    there is no table yet and nothing was accepted, or if a merge read no key. The
    quality row and the rejected rows are written in any case. A wrong count raises
    before the published tables are touched.
    """
    s = settings
    if s.publish_mode not in ("replace", "merge"):
        raise ValueError(f"publish_mode must be 'replace' or 'merge', not {s.publish_mode!r}")
    out_dir = out_dir.rstrip("/")
    work = new_work_path(spark, "batch")
    site_dim, series = _lookups(spark, sites, context, s, overrides, work)
    rows = build_rows(obs, site_dim, series, s)
    figures = Observation(f"obsflow_figures_{uuid.uuid4().hex[:8]}")
    staging = f"{work}/staging"
    staged = rows.select(*row_columns(s), "has_context", "is_orphan", "reasons", "disposition")
    write_partitioned(staged, staging, ["disposition", "year", "month"], observe=(figures, observed_figures(s)))
    metrics = dict(figures.get)
    # Read back with the declared schema: an empty table has no file to infer it from.
    staged = spark.read.schema(staged.schema).parquet(staging)
    # Cross-check against the durable staged table (a footer-only count). On
    # a mismatch the figures are recomputed exactly from the staged rows.
    if staged.count() != metrics.get("n_rows"):
        metrics = staged.agg(*observed_figures(s)).first().asDict()
        metrics["recomputed"] = True
    verdict = gate_verdict(metrics, s.gate_rules, prefix="final_")

    run_id = work.rsplit("/", 1)[-1]
    rows_path, hours_path = f"{out_dir}/rows", f"{out_dir}/hours"
    rejects_path = f"{out_dir}/rejects/run_id={run_id}"
    result = BatchResult(metrics, verdict, False, staging, rows_path, hours_path, rejects_path)
    # The quality table gets its row whether or not the gate lets the data
    # through, and the rejected rows are kept with their reasons (DQ5).
    _append_quality(spark, f"{out_dir}/quality", run_id, metrics, verdict, s)
    staged.filter(F.col("disposition") != OK).write.parquet(rejects_path)
    if s.enforce_gate and not verdict["passed"]:
        return result
    if s.require_observations and not metrics["n_rows"]:
        raise RuntimeError("no observation was read; nothing was published")
    if _publish(spark, staged, metrics, out_dir, run_id, s, result):
        result.published = True
        if not s.keep_staging:
            remove_folder(spark, work)
    return result


def _publish(spark: SparkSession, staged: DataFrame, metrics: dict, out_dir: str, run_id: str, s: BatchSettings, result: BatchResult) -> bool:
    """Write the new rows and hours aside and switch to them; False if there is
    nothing to publish."""
    row_names, hour_names = _layout(s)
    parts = [row_names.get(c, c) for c in ("year", "month")]
    accepted = staged.filter(F.col("disposition") == OK).select(*row_columns(s))
    before = versions.snapshot(spark, out_dir)
    exists = before is not None or table_exists(spark, result.rows_path)
    if exists and s.snapshots != (before is not None):
        raise ValueError(f"{out_dir} is published {'by' if before else 'without'} snapshots; keep to one way")
    present = published_months(spark, out_dir, row_names) if exists else []
    if not exists and not metrics["n_final"]:
        return False
    if s.publish_mode == "replace":
        months = range_months(s.time_range) if s.time_range else None
    else:  # one row per month read: a handful
        keyed = staged.filter((F.col("disposition") != KEY_NULL) & F.col("year").isNotNull())
        months = sorted((r["year"], r["month"]) for r in keyed.select("year", "month").distinct().collect())
        if not months:
            return False
    # Nothing of the present table stays: then it is replaced whole.
    whole = months is None or not set(present) - set(months)
    if months is None or not present:
        new, kept = accepted, 0
    else:
        survivors = _survivors(published_rows(spark, result.rows_path, months, row_names), staged, s).select(*row_columns(s))
        kept = survivors.count()
        new = survivors.unionByName(accepted)

    aside = f"{out_dir}/_publish-{run_id}"
    paths = {t: versions.new_version_path(out_dir, t, run_id) if s.snapshots else f"{aside}/{t}" for t in ("rows", "hours")}
    named = publish_as(new, row_names)
    # Staged and published files are already grouped by month: no shuffle.
    cluster = [row_names.get(c, c) for c in s.cluster_by]
    write_partitioned(named, paths["rows"], parts, rebalance=False, cluster_by=cluster)
    written = spark.read.schema(named.schema).parquet(paths["rows"])
    expected, n = kept + metrics["n_final"], written.count()
    result.verification = {"expected": expected, "read_back": n, "ok": n == expected}
    if n != expected:
        for path in (*paths.values(), aside):
            remove_folder(spark, path)
        raise RuntimeError(f"{n} rows were written for publication, {expected} were expected; nothing was published")
    hours = publish_as(hourly_rollup(read_as_library(written, row_names), SITE_HOUR_KEYS, s.temperature_col), hour_names)
    write_partitioned(hours, paths["hours"], parts)

    folders = None if whole else ["/".join(f"{p}={v}" for p, v in zip(parts, ym, strict=True)) for ym in months]
    if s.snapshots:
        versions.switch(spark, out_dir, before, run_id, {"rows": named.schema, "hours": hours.schema}, parts, folders)
        return True
    if whole:
        if not n:
            for table, df in (("rows", named), ("hours", hours)):
                write_empty(df, paths[table])
        moves = [(paths["rows"], result.rows_path), (paths["hours"], result.hours_path)]
    else:
        moves = []
        for table in ("rows", "hours"):
            for f in folders:
                new_folder = f"{paths[table]}/{f}"
                moves.append((new_folder if table_exists(spark, new_folder) else None, f"{out_dir}/{table}/{f}"))
    swap_folders(spark, moves, f"{out_dir}/_before-{run_id}")
    remove_folder(spark, aside)
    return True


def latest_published(spark: SparkSession, out_dir: str, settings: BatchSettings = BatchSettings()) -> DataFrame:
    """Published times (``obs_ts``) of the newest month that holds a row: enough
    for the latest one, and only that month is read."""
    row_names, _ = _layout(settings)
    if versions.snapshot(spark, out_dir) is None and not table_exists(spark, f"{out_dir.rstrip('/')}/rows"):
        return spark.createDataFrame([], "obs_ts timestamp_ntz")
    months = [{"year": y, "month": m} for y, m in published_months(spark, out_dir, row_names)]
    rows = read_as_library(published_table(spark, out_dir, "rows"), row_names)
    return newest_partition(rows, "obs_ts", months).select("obs_ts")


def run_incremental(
    spark: SparkSession,
    obs: DataFrame,
    sites: DataFrame,
    context: DataFrame,
    out_dir: str,
    settings: BatchSettings = BatchSettings(),
    overrides: DataFrame | None = None,
    start: str | None = None,
    end: str | None = None,
    today=None,
    lookback_days: int = 7,
) -> BatchResult:
    """Load from where the published table stops (INC1 + INC4).

    All dates are local dates of the business zone. The start is the explicit
    date, else the date of the latest published observation, else ``today - lookback_days``; the end is the
    explicit date, else today. The run covers [start, end] (pushed to both
    inputs' scans) and is published with the keyed merge, so the day it
    resumes on, already partly loaded, is reloaded idempotently.
    """
    import dataclasses

    from obsflow.operators.incremental import resume_point

    stored = latest_published(spark, out_dir, settings)
    rng = resume_point(
        stored, "obs_ts", start=start, end=end, today=today, tz=settings.time_zone, lookback_days=lookback_days
    ).first()
    s = dataclasses.replace(
        settings, time_range=(rng.start_date.isoformat(), rng.end_date.isoformat()), publish_mode="merge"
    )
    result = run_batch(spark, obs, sites, context, out_dir, s, overrides)
    result.metrics["resume"] = {"start": rng.start_date.isoformat(), "end": rng.end_date.isoformat(), "source": rng.start_source}
    return result
