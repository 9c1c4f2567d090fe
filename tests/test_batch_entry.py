"""ENR6 end to end, the driver entry points, and plan shape."""

import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from obsflow.plans import catalog, roles
from obsflow.plans.batch_job import BatchSettings, _lookups, build_rows, run_batch, run_incremental

T = dt.datetime
SMOKE = "/root/testdata/sf0.001"

OBS = "site_id bigint, obs_ts timestamp_ntz, status string, capacity int, available int, free int"
SITES = "site_id bigint, site_name string, zone string, lat double, lon double"
CTX = "zone string, ctx_ts timestamp_ntz, temperature_2m_c double"


def _inputs(spark):
    obs = spark.createDataFrame(
        [
            (1, T(2024, 1, 1, 10, 5), "OPEN", 10, 4, 6),
            (1, T(2024, 1, 1, 10, 5), "OPEN", 10, 4, 6),  # duplicate
            (1, T(2024, 1, 1, 10, 20), "OPEN", 10, 6, 4),
            (2, T(2024, 1, 1, 10, 5), "OPEN", 10, 12, 0),  # anomaly
            (9, T(2024, 1, 1, 10, 5), "OPEN", 10, 1, 9),  # orphan
            (1, None, "OPEN", 10, 1, 9),  # unparsed time
            (1, None, "CLOSED", 10, 1, 9),  # another one: must not merge with the first
        ],
        OBS,
    )
    sites = spark.createDataFrame([(1, "A", "Z1", 45.0, 4.0), (2, "B", "Z1", 45.0, 4.0)], SITES)
    ctx = spark.createDataFrame([("Z1", T(2024, 1, 1, 10, 0), 4.25), ("Z1", T(2024, 1, 1, 10, 15), 5.0)], CTX)
    return obs, sites, ctx


SETTINGS = BatchSettings(measures=("temperature_2m_c",))


def test_build_rows_dispositions_and_invariants(spark):
    obs, sites, ctx = _inputs(spark)
    rows = build_rows(obs, sites, ctx, SETTINGS)
    got = {d: n for d, n in rows.groupBy("disposition").count().collect()}
    assert got == {"ok": 2, "anomaly": 1, "orphan": 1, "key_null": 2}


def test_run_batch_publishes_and_rolls_up(spark, tmp_dir):
    obs, sites, ctx = _inputs(spark)
    res = run_batch(spark, obs, sites, ctx, tmp_dir, SETTINGS)
    m = res.metrics
    assert m["n_rows"] == 6 and m["n_matched"] == 3 and m["n_orphans"] == 1 and m["n_key_null"] == 2
    assert m["n_final"] == m["n_matched"] - m["n_anomalies"] == 2
    assert m["matched_fill_rate_out_of_range"] == 1 and m["final_fill_rate_out_of_range"] == 0  # m15
    assert res.published and res.verification["ok"]
    hours = spark.read.parquet(res.hours_path).collect()
    assert len(hours) == 1 and hours[0].n_obs == 2 and hours[0].avg_temperature == 4.63
    assert hours[0].hour == 11  # local hour in Paris
    q = spark.read.parquet(f"{tmp_dir}/quality").collect()
    assert len(q) == 1 and q[0].n_rows == 2 and q[0].passed and q[0].time_null == 0


def test_gate_refuses_publication(spark, tmp_dir):
    obs, sites, ctx = _inputs(spark)
    sites = sites.withColumn("zone", F.lit(None).cast("string"))
    res = run_batch(spark, obs, sites, ctx, tmp_dir, SETTINGS)  # zone_null blocks by default
    assert not res.published and "zone_null" in res.verdict["failed_rules"]
    q = spark.read.parquet(f"{tmp_dir}/quality").first()
    assert q.passed is False and "zone_null" in q.failed_rules  # recorded even when refused
    with pytest.raises(Exception):
        spark.read.parquet(res.rows_path).count()


def test_merge_publish_is_idempotent(spark, tmp_dir):
    obs, sites, ctx = _inputs(spark)
    s = BatchSettings(measures=("temperature_2m_c",), publish_mode="merge")
    run_batch(spark, obs, sites, ctx, tmp_dir, s)
    first = sorted(map(tuple, spark.read.parquet(f"{tmp_dir}/rows").collect()))
    run_batch(spark, obs, sites, ctx, tmp_dir, s)
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_dir}/rows").collect())) == first


def test_entry_runs_on_smoke_data(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_plan_single_dedup_exchange_and_broadcast_dimension(spark, tmp_dir):
    # The job joins its written lookups, whose size Spark knows.
    dims = _lookups(
        spark,
        roles.sites(spark, SMOKE),
        roles.context(spark, SMOKE),
        catalog.DRIVER_SETTINGS,
        roles.zone_overrides(spark, SMOKE),
        tmp_dir,
    )
    rows = build_rows(roles.observations(spark, SMOKE), *dims, catalog.DRIVER_SETTINGS)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = plan.splitlines()
    assert sum("BroadcastHashJoin" in ln and "LeftOuter" in ln for ln in lines) == 2
    assert "SortMergeJoin" not in plan and "SinglePartition" not in plan
    assert sum("FileScan" in ln for ln in lines) == 4  # events in both landing batches, and the two lookups
    assert "partial_max" in plan
    # One exchange on the observation key (the dedup); the facts are never
    # shuffled again (the other site_id exchange is the dimension's own).
    import re

    assert len(re.findall(r"hashpartitioning\(site_id#\d+L?, obs_ts", plan)) == 1


def test_shuffle_joins_equal_broadcast_joins(spark):
    args = (
        roles.observations(spark, SMOKE),
        roles.sites(spark, SMOKE),
        roles.context(spark, SMOKE),
    )
    ovr = roles.zone_overrides(spark, SMOKE)
    cols = ["site_id", "obs_ts", "zone", "is_orphan", "temperature_2m_c", "has_context", "disposition"]
    want = sorted(map(tuple, build_rows(*args, catalog.DRIVER_SETTINGS, ovr).select(*cols).collect()), key=repr)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = build_rows(*args, catalog.DRIVER_SETTINGS, ovr).select(*cols)
        plan = shuffled._jdf.queryExecution().executedPlan().toString()
        got = sorted(map(tuple, shuffled.collect()), key=repr)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    left_joins = [ln for ln in plan.splitlines() if "LeftOuter" in ln]
    assert left_joins and all("SortMergeJoin" in ln for ln in left_joins)
    assert "SinglePartition" not in plan
    assert got == want


def test_keyed_input_skips_the_fact_shuffle(spark):
    import dataclasses
    import re

    s = dataclasses.replace(catalog.DRIVER_SETTINGS, dedup_input=False)
    base = roles.observation_base(spark, SMOKE)
    rows = build_rows(base, roles.sites(spark, SMOKE), roles.context(spark, SMOKE), s, roles.zone_overrides(spark, SMOKE))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert not re.findall(r"hashpartitioning\(site_id#\d+L?, obs_ts", plan)
    assert rows.count() == base.count()


def test_cluster_conf_sizes_for_100_tb():
    from obsflow.session import cluster_conf

    conf = cluster_conf(100 * 1024**4)
    assert int(conf["spark.sql.shuffle.partitions"]) == 200 * 1024
    assert conf["spark.sql.adaptive.enabled"] == "true"


def test_overcounted_metrics_are_recomputed_from_staged_rows(spark, tmp_dir, monkeypatch):
    from pyspark.sql import Observation

    from obsflow.plans import batch_job

    class Doubled(Observation):
        """Simulates a stage re-run that counted some partitions twice."""

        @property
        def get(self):
            return {k: 2 * v for k, v in super().get.items()}

    monkeypatch.setattr(batch_job, "Observation", Doubled)
    obs, sites, ctx = _inputs(spark)
    res = run_batch(spark, obs, sites, ctx, tmp_dir, SETTINGS)
    assert res.metrics.get("recomputed") is True
    assert res.metrics["n_rows"] == 6 and res.metrics["n_final"] == 2 and res.verification["ok"]


def test_run_reports_from_staged_table(spark, tmp_dir):
    from obsflow.plans.reports import quarantine, run_reports

    obs, sites, ctx = _inputs(spark)
    res = run_batch(spark, obs, sites, ctx, tmp_dir, dataclasses.replace(SETTINGS, keep_staging=True))
    reps = run_reports(spark, res, ctx)
    jq = reps["join_quality"].first()
    assert (jq.n_rows, jq.n_matched, jq.n_orphans) == (6, 3, 1)
    assert reps["rate_out_of_range"].count() == 1
    reasons = {r.reason: r["count"] for r in reps["quarantine_by_reason"].collect()}
    assert reasons == {"key_part_null": 2, "orphan": 1, "available_above_capacity": 1}
    assert reps["site_hour_top"].count() == 1 and reps["zones_without_context"].count() == 0
    assert quarantine(spark, res).count() == 4


def test_published_months_are_pruned(spark, tmp_dir):
    from obsflow.plans.batch_job import published_rows, range_months

    rows = spark.range(240).select(
        (F.col("id") % 2 + 2023).cast("int").alias("year"), (F.col("id") % 12 + 1).cast("int").alias("month"), "id"
    )
    rows.write.partitionBy("year", "month").parquet(f"{tmp_dir}/rows")
    df = published_rows(spark, f"{tmp_dir}/rows", [(2024, 4)], {})
    assert df.count() == 20  # ids 3, 15, ..., 231: year 2024, month 4
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan or "PartitionFilters: [((year" in plan or "(month#" in plan
    assert range_months(("2023-11-30", "2024-02-01")) == [(2023, 11), (2023, 12), (2024, 1), (2024, 2)]


def test_run_incremental_resumes_and_reloads_idempotently(spark, tmp_dir):
    import datetime as dt

    from obsflow.plans.batch_job import run_incremental

    obs = spark.createDataFrame(
        [
            (1, T(2024, 1, 1, 10, 5), "OPEN", 10, 4, 6),
            (1, T(2024, 1, 2, 10, 5), "OPEN", 10, 5, 5),
            (1, T(2024, 1, 3, 10, 5), "OPEN", 10, 6, 4),
        ],
        OBS,
    )
    import dataclasses

    _, sites, ctx = _inputs(spark)
    # The fixture's context covers one day only: coverage must not block here.
    s = dataclasses.replace(SETTINGS, gate_rules=catalog.DRIVER_GATE_RULES)
    # First load: an explicit window covering the first two days.
    first = run_incremental(spark, obs, sites, ctx, tmp_dir, s, start="2024-01-01", end="2024-01-02")
    assert first.published
    assert first.metrics["resume"]["source"] == "explicit" and first.metrics["n_final"] == 2
    # Next load resumes from the latest stored (local) date and reloads it.
    second = run_incremental(spark, obs, sites, ctx, tmp_dir, s, today=dt.date(2024, 1, 3))
    assert second.metrics["resume"] == {"start": "2024-01-02", "end": "2024-01-03", "source": "stored"}
    rows = spark.read.parquet(f"{tmp_dir}/rows").collect()
    assert sorted(r.obs_ts.day for r in rows) == [1, 2, 3]  # day 2 reloaded, not doubled
    third = run_incremental(spark, obs, sites, ctx, tmp_dir, s, today=dt.date(2024, 1, 3))
    assert third.published and len(spark.read.parquet(f"{tmp_dir}/rows").collect()) == 3


def test_reference_layout_with_merge_publish_is_idempotent(spark, tmp_dir):
    import dataclasses

    obs, sites, ctx = _inputs(spark)
    s = dataclasses.replace(SETTINGS, layout="reference", publish_mode="merge")
    run_batch(spark, obs, sites, ctx, tmp_dir, s)
    first = sorted(map(tuple, spark.read.parquet(f"{tmp_dir}/rows").collect()), key=repr)
    res = run_batch(spark, obs, sites, ctx, tmp_dir, s)
    rows = spark.read.parquet(f"{tmp_dir}/rows")
    assert {"station_id", "horodate_ts", "annee", "mois"} <= set(rows.columns)
    assert sorted(map(tuple, rows.collect()), key=repr) == first and res.published
    assert {"nb_observations", "annee"} <= set(spark.read.parquet(f"{tmp_dir}/hours").columns)


# Publishing over several months: equal to a recompute from scratch.

KEEP = dataclasses.replace(SETTINGS, gate_rules=catalog.DRIVER_GATE_RULES)


def _obs(spark, rows):
    return spark.createDataFrame([(site, ts, "OPEN", 10, n, max(10 - n, 0)) for site, ts, n in rows], OBS)


def _published(spark, out):
    return sorted((r.site_id, r.obs_ts, r.available) for r in spark.read.parquet(f"{out}/rows").collect())


def _hours(spark, out):
    return sorted((r.site_id, r.month, r.day, r.hour, r.n_obs) for r in spark.read.parquet(f"{out}/hours").collect())


def test_range_replace_keeps_rows_outside_the_range(spark, tmp_dir):
    _, sites, ctx = _inputs(spark)
    rows = [(1, T(2024, 7, d, 10), 4) for d in (3, 20)] + [(1, T(2024, 8, d, 10), 4) for d in (1, 15)] + [(1, T(2024, 7, 31, 23), 5)]
    run_batch(spark, _obs(spark, rows), sites, ctx, tmp_dir, KEEP)
    later = [r for r in rows if r[1] != T(2024, 7, 20, 10)] + [(1, T(2024, 7, 21, 9), 6)]
    s = dataclasses.replace(KEEP, time_range=("2024-07-15", "2024-07-31"))
    assert run_batch(spark, _obs(spark, later), sites, ctx, tmp_dir, s).published
    assert [(a, b, n) for a, b, n in _published(spark, tmp_dir)] == sorted((a, b, n) for a, b, n in later)
    run_batch(spark, _obs(spark, later), sites, ctx, f"{tmp_dir}/scratch", KEEP)
    assert _hours(spark, tmp_dir) == _hours(spark, f"{tmp_dir}/scratch")


def test_range_replace_takes_out_what_vanished(spark, tmp_dir):
    _, sites, ctx = _inputs(spark)
    rows = [(1, T(2024, 7, 3, 10), 4), (1, T(2024, 8, 3, 10), 4)]
    run_batch(spark, _obs(spark, rows), sites, ctx, tmp_dir, KEEP)
    s = dataclasses.replace(KEEP, time_range=("2024-08-01", "2024-08-31"))
    only_bad = _obs(spark, [(1, T(2024, 8, 3, 10), 50)])
    assert run_batch(spark, only_bad, sites, ctx, tmp_dir, s).published
    assert _published(spark, tmp_dir) == [(1, T(2024, 7, 3, 10), 4)] and {h[1] for h in _hours(spark, tmp_dir)} == {7}


def test_full_replace_drops_vanished_months(spark, tmp_dir):
    _, sites, ctx = _inputs(spark)
    run_batch(spark, _obs(spark, [(1, T(2024, 7, 3, 10), 4), (1, T(2024, 8, 3, 10), 4)]), sites, ctx, tmp_dir, KEEP)
    run_batch(spark, _obs(spark, [(1, T(2024, 7, 3, 10), 4)]), sites, ctx, tmp_dir, KEEP)
    assert _published(spark, tmp_dir) == [(1, T(2024, 7, 3, 10), 4)] and len(_hours(spark, tmp_dir)) == 1


def test_merge_takes_out_keys_that_are_rejected_now(spark, tmp_dir):
    _, sites, ctx = _inputs(spark)
    merge = dataclasses.replace(KEEP, publish_mode="merge")
    run_batch(spark, _obs(spark, [(1, T(2024, 7, 3, 10), 5), (1, T(2024, 7, 4, 10), 5)]), sites, ctx, tmp_dir, merge)
    res = run_batch(spark, _obs(spark, [(1, T(2024, 7, 3, 10), 50), (9, T(2024, 7, 4, 10), 5)]), sites, ctx, tmp_dir, merge)
    assert res.published and res.metrics["n_anomalies"] == 1
    assert _published(spark, tmp_dir) == [(1, T(2024, 7, 4, 10), 5)] and len(_hours(spark, tmp_dir)) == 1


@pytest.mark.parametrize("zone", ["Europe/Paris", "America/New_York"])
def test_two_loads_equal_one(spark, tmp_dir, zone):
    _, sites, ctx = _inputs(spark)
    s = dataclasses.replace(KEEP, time_zone=zone)
    hours = [(8, 20), (9, 3, 59), (9, 4, 1), (9, 22, 30), (9, 23, 15), (9, 23, 45), (10, 0, 15), (10, 5)]
    rows = [(1, T(2024, 7, *h), 4) for h in hours]
    for cut in (4, 6):
        out = f"{tmp_dir}/{zone.split('/')[1]}-{cut}"
        run_incremental(spark, _obs(spark, rows[:cut]), sites, ctx, out, s, start="2024-07-08", end="2024-07-11")
        run_incremental(spark, _obs(spark, rows), sites, ctx, out, s, today=dt.date(2024, 7, 11))
        assert _published(spark, out) == sorted(rows)


def test_empty_and_all_rejected_runs(spark, tmp_dir):
    _, sites, ctx = _inputs(spark)
    for n, rows in enumerate(([], [(1, T(2024, 7, 3, 10), 50)])):
        for mode in ("replace", "merge"):
            out = f"{tmp_dir}/{mode}-{n}"
            s = dataclasses.replace(KEEP, publish_mode=mode)
            res = run_batch(spark, _obs(spark, rows), sites, ctx, out, s)
            assert not res.published and res.metrics["n_final"] == 0
            assert spark.read.parquet(f"{out}/quality").count() == 1 and spark.read.parquet(res.rejects_path).count() == len(rows)


@pytest.mark.parametrize("snapshots", [False, True])
def test_a_run_owns_what_it_says(spark, tmp_dir, snapshots):
    """With nothing accepted, what the run owns is empty afterwards."""
    from obsflow.plans.batch_job import published_table

    _, sites, ctx = _inputs(spark)
    keep = dataclasses.replace(KEEP, snapshots=snapshots)
    july, august = (1, T(2024, 7, 3, 10), 4), (1, T(2024, 8, 3, 10), 4)

    def published(out):
        return sorted((r.site_id, r.obs_ts, r.available) for r in published_table(spark, out, "rows").collect())

    for k, rejected in enumerate(([], [(1, T(2024, 7, 3, 10), 50)])):
        out = f"{tmp_dir}/full-{k}"
        run_batch(spark, _obs(spark, [july, august]), sites, ctx, out, keep)
        columns = set(published_table(spark, out, "rows").columns)
        assert run_batch(spark, _obs(spark, rejected), sites, ctx, out, keep).published
        assert published(out) == [] and published_table(spark, out, "hours").count() == 0
        assert set(published_table(spark, out, "rows").columns) == columns
        # the emptied table takes later runs of any kind
        for mode in ({}, {"time_range": ("2024-07-01", "2024-07-31")}, {"publish_mode": "merge"}):
            run_batch(spark, _obs(spark, []), sites, ctx, out, keep)
            run_batch(spark, _obs(spark, [july]), sites, ctx, out, dataclasses.replace(keep, **mode))
            assert published(out) == [july]

        out = f"{tmp_dir}/range-{k}"
        run_batch(spark, _obs(spark, [july, august]), sites, ctx, out, keep)
        in_july = dataclasses.replace(keep, time_range=("2024-07-01", "2024-07-31"))
        assert run_batch(spark, _obs(spark, [*rejected, august]), sites, ctx, out, in_july).published
        assert published(out) == [august]
        in_august = dataclasses.replace(keep, time_range=("2024-08-01", "2024-08-31"))
        run_batch(spark, _obs(spark, []), sites, ctx, out, in_august)
        assert published(out) == []

    strict = dataclasses.replace(keep, require_observations=True)
    run_batch(spark, _obs(spark, [july]), sites, ctx, f"{tmp_dir}/strict", strict)
    with pytest.raises(RuntimeError, match="no observation"):
        run_batch(spark, _obs(spark, []), sites, ctx, f"{tmp_dir}/strict", strict)
    assert published(f"{tmp_dir}/strict") == [july]


def test_readers_see_old_or_new(spark, tmp_dir):
    from obsflow.plans.batch_job import published_table
    from obsflow.sinks import versions

    _, sites, ctx = _inputs(spark)
    s = dataclasses.replace(KEEP, snapshots=True)
    july, august = (1, T(2024, 7, 3, 10), 4), (1, T(2024, 8, 3, 10), 4)
    run_batch(spark, _obs(spark, [july, august]), sites, ctx, tmp_dir, s)
    first = versions.snapshot(spark, tmp_dir)
    old = published_table(spark, tmp_dir, "rows")  # resolved before the next run
    in_july = dataclasses.replace(s, time_range=("2024-07-01", "2024-07-31"))
    run_batch(spark, _obs(spark, [(1, T(2024, 7, 4, 10), 9)]), sites, ctx, tmp_dir, in_july)
    assert sorted(r.available for r in old.collect()) == [4, 4]
    second = versions.snapshot(spark, tmp_dir)
    assert second.number == first.number + 1
    # the month outside the range still lies where the first run put it
    assert second.tables["rows"].folders["year=2024/month=8"] == first.tables["rows"].folders["year=2024/month=8"]
    assert sorted((r.month, r.available) for r in published_table(spark, tmp_dir, "rows").collect()) == [(7, 9), (8, 4)]
    assert sorted((r.month, r.n_obs) for r in published_table(spark, tmp_dir, "hours").collect()) == [(7, 1), (8, 1)]

    # a run that began from an older snapshot cannot publish over a newer one
    with pytest.raises(Exception, match="already exists|AlreadyExists"):
        versions.switch(spark, tmp_dir, first, "late", {}, ["year", "month"], None)
    assert versions.snapshot(spark, tmp_dir) == second

    run_batch(spark, _obs(spark, [july]), sites, ctx, tmp_dir, s)
    gone = versions.expire(spark, tmp_dir, keep=1)
    assert len(gone) == 4 and versions.snapshot(spark, tmp_dir).number == 3
    assert [r.month for r in published_table(spark, tmp_dir, "rows").collect()] == [7]
    with pytest.raises(ValueError, match="keep to one way"):
        run_batch(spark, _obs(spark, [july]), sites, ctx, tmp_dir, KEEP)


def test_failure_before_the_switch_changes_nothing(spark, tmp_dir, monkeypatch):
    from obsflow.plans.batch_job import published_table
    from obsflow.sinks import versions

    _, sites, ctx = _inputs(spark)
    s = dataclasses.replace(KEEP, snapshots=True)
    run_batch(spark, _obs(spark, [(1, T(2024, 7, 3, 10), 4)]), sites, ctx, tmp_dir, s)

    def fail(*args):
        raise OSError("lost")

    monkeypatch.setattr(versions, "create_file", fail)
    with pytest.raises(OSError, match="lost"):
        run_batch(spark, _obs(spark, [(1, T(2024, 7, 5, 10), 8)]), sites, ctx, tmp_dir, s)
    monkeypatch.undo()
    assert [r.available for r in published_table(spark, tmp_dir, "rows").collect()] == [4]
    run_batch(spark, _obs(spark, [(1, T(2024, 7, 6, 10), 6)]), sites, ctx, tmp_dir, s)
    assert [r.available for r in published_table(spark, tmp_dir, "rows").collect()] == [6]


def test_resume_reads_the_newest_month_only(spark, tmp_dir):
    import os

    from obsflow.plans.batch_job import latest_published, published_rows

    _, sites, ctx = _inputs(spark)
    rows = [(1, T(2023, 12, 30, 10), 4), (1, T(2024, 2, 3, 10), 4), (1, T(2024, 10, 3, 9), 4)]
    for snapshots in (False, True):
        out = f"{tmp_dir}/{snapshots}"
        s = dataclasses.replace(KEEP, snapshots=snapshots)
        assert latest_published(spark, out, s).collect() == []
        run_batch(spark, _obs(spark, rows), sites, ctx, out, s)
        latest = latest_published(spark, out, s)
        assert [r.obs_ts for r in latest.collect()] == [T(2024, 10, 3, 9)]
        plan = latest._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: []" not in plan and "2024" in plan and "10" in plan
    # a folder without rows is passed over
    folder = f"{tmp_dir}/False/rows/year=2025/month=1".removeprefix("file:")
    os.makedirs(folder)
    published_rows(spark, f"{tmp_dir}/False/rows", [(2024, 2)], {}).drop("year", "month").limit(0).coalesce(1).write.mode("overwrite").parquet(folder)
    assert [r.obs_ts for r in latest_published(spark, f"{tmp_dir}/False", KEEP).collect()] == [T(2024, 10, 3, 9)]
    res = run_incremental(spark, _obs(spark, rows), sites, ctx, f"{tmp_dir}/False", KEEP, end="2024-10-31")
    assert res.metrics["resume"]["start"] == "2024-10-03" and res.metrics["n_rows"] == 1


def test_clustered_publication_skips_row_groups(spark, tmp_dir):
    import glob

    import pyarrow.parquet as pq

    from obsflow.sinks.parquet import write_partitioned

    _, sites, ctx = _inputs(spark)
    rows = spark.range(20_000).selectExpr("id % 500 as site_id", "timestamp_ntz'2024-07-01 00:00:00' + make_dt_interval(0, 0, cast(id as int)) as obs_ts", "7 as month")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else the few rows make one file
    try:
        for name, cluster in (("plain", ()), ("clustered", ("site_id", "obs_ts"))):
            write_partitioned(rows.repartition(8), f"{tmp_dir}/{name}", ["month"], rebalance=False, cluster_by=cluster)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    wanted = (F.col("site_id") == 77) & (F.col("obs_ts") < F.lit("2024-07-05").cast("timestamp_ntz"))
    read = {}
    for name in ("plain", "clustered"):
        df = spark.read.parquet(f"{tmp_dir}/{name}").filter(wanted)
        n = df.count()
        read[name] = [pq.ParquetFile(f).metadata.row_group(0).column(0).statistics for f in glob.glob(f"{tmp_dir}/{name}/month=7/*.parquet")]
        read[name] = sum(s.min <= 77 <= s.max for s in read[name]), len(read[name]), n
    assert read["plain"][0] == read["plain"][1] and read["plain"][2] == read["clustered"][2] > 0
    assert read["clustered"][1] >= 4 and read["clustered"][0] <= 2
    s = dataclasses.replace(KEEP, cluster_by=("site_id", "obs_ts"))
    run_batch(spark, _obs(spark, [(1, T(2024, 7, 3, 10), 4), (1, T(2024, 7, 4, 10), 4)]), sites, ctx, f"{tmp_dir}/job", s)
    assert len(_published(spark, f"{tmp_dir}/job")) == 2


def test_landing_date_prunes_below_only(spark, tmp_dir):
    from obsflow.operators.incremental import in_date_range

    rows = [
        (1, T(2024, 3, 5, 10), dt.date(2024, 3, 20)),  # fetched again 15 days later
        (2, T(2024, 3, 5, 23, 30), dt.date(2024, 3, 5)),  # 6 March in Paris
        (3, T(2024, 3, 4, 23, 30), dt.date(2024, 3, 4)),  # 5 March in Paris, the UTC day before
        (4, T(2024, 3, 9, 10), dt.date(2024, 3, 9)),
    ]
    df = spark.createDataFrame(rows, "site_id bigint, obs_ts timestamp_ntz, obs_date date")
    df.write.partitionBy("obs_date").parquet(tmp_dir + "/landed")
    landed = spark.read.parquet(tmp_dir + "/landed")
    got = in_date_range(landed, "2024-03-05", "2024-03-05", "Europe/Paris", date_col="obs_date")
    assert sorted(r.site_id for r in got.collect()) == [1, 3]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "2024-03-04" in plan.split("PartitionFilters")[1].split("]")[0]
    # a table said to hold the observation's own UTC date is checked
    good = in_date_range(landed.filter("site_id > 1"), "2024-03-05", "2024-03-05", "Europe/Paris", date_col="obs_date", date_is="utc")
    assert [r.site_id for r in good.collect()] == [3]
    wrong = spark.createDataFrame([(1, T(2024, 3, 5, 10), dt.date(2024, 3, 4))], landed.schema)
    with pytest.raises(Exception, match="is not the UTC date"):
        in_date_range(wrong, "2024-03-05", "2024-03-05", "Europe/Paris", date_col="obs_date", date_is="utc").collect()


def test_wrong_count_and_failed_swap_change_nothing(spark, tmp_dir, monkeypatch):
    from obsflow.plans import batch_job
    from obsflow.sinks import parquet

    _, sites, ctx = _inputs(spark)
    good = [(1, T(2024, 7, 3, 10), 4)]
    run_batch(spark, _obs(spark, good), sites, ctx, tmp_dir, KEEP)
    before = _hours(spark, tmp_dir)
    write = batch_job.write_partitioned

    def short(df, path, *args, **kw):
        write(df.limit(1) if path.endswith("/rows") else df, path, *args, **kw)

    monkeypatch.setattr(batch_job, "write_partitioned", short)
    with pytest.raises(RuntimeError, match="nothing was published"):
        run_batch(spark, _obs(spark, good + [(1, T(2024, 7, 5, 10), 4)]), sites, ctx, tmp_dir, KEEP)
    assert _published(spark, tmp_dir) == good and _hours(spark, tmp_dir) == before
    with pytest.raises(Exception):  # the kind depends on the file system
        parquet.swap_folders(spark, [(None, f"{tmp_dir}/rows"), (f"{tmp_dir}/missing", f"{tmp_dir}/hours")], f"{tmp_dir}/_aside")
    assert _published(spark, tmp_dir) == good and _hours(spark, tmp_dir) == before


def test_staging_is_removed_and_rejects_stay(spark, tmp_dir):
    from obsflow.sinks.parquet import table_exists

    obs, sites, ctx = _inputs(spark)
    res = run_batch(spark, obs, sites, ctx, tmp_dir, SETTINGS)
    assert res.published and not table_exists(spark, res.staging_path)
    rejects = spark.read.parquet(f"{tmp_dir}/rejects")
    assert rejects.count() == 4 and all(r.reasons and r.run_id for r in rejects.collect())


def test_runs_of_one_query_share_the_context(spark, tmp_dir, monkeypatch):
    from types import SimpleNamespace

    at = T(2024, 1, 5, 10, 0)
    tables = {
        "region": [(0, "EUROPE")],
        "nation": [(0, "FRANCE", 0)],
        "customer": [(1, "a", 0, 1.0, "AUTOMOBILE")],
        "supplier": [(1, "s", 0, 1.0)],
        "events": [(1, at, 1, "view", 3.0, '{"k": 5}')],
    }
    for name, rows in tables.items():
        spark.createDataFrame(rows, roles.DRIVER_SCHEMAS[name]).write.parquet(f"{tmp_dir}/{name}.parquet")
    seen = []

    def run(spark, obs, sites, context, out, *more):
        seen.append((context.inputFiles(), [tuple(r) for r in context.collect()], [r.site_id for r in sites.collect()]))
        spark.range(1).write.mode("overwrite").parquet(f"{out}/rows")
        return SimpleNamespace(published=True)

    monkeypatch.setattr(catalog, "run_batch", run)
    catalog.QUERIES["batch_replace_empty"](spark, tmp_dir)
    assert len(seen) == 4
    want = [tuple(r) for r in roles.context(spark, tmp_dir).collect()]
    for files, context, sites in seen:
        assert files == seen[0][0] and not any("events.parquet" in f for f in files)
        assert context == want and len(want) == 1 and sites == [1]
