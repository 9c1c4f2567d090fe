"""AGG7, JON1-JON3, FN12, FLT1, ENR2-ENR4 (traps m2-m5, m16, m17)."""

import datetime as dt

from pyspark.sql import functions as F

from obsflow.operators.dedup import dedup_any, dedup_latest
from obsflow.operators.enrich import (
    attach_context,
    attach_sites,
    split_orphans,
    with_fill_rate,
    with_slot,
    zones_without_context,
)
from obsflow.operators.joins import duplicate_keys, many_to_one_join
from obsflow.operators.reshape import from_landed

T = dt.datetime
OBS = "site_id bigint, obs_ts timestamp_ntz, status string, capacity int, available int, free int, batch int"
SITES = "site_id bigint, site_name string, zone string, lat double, lon double"


def test_agg7_latest_wins_and_ties_are_deterministic(spark):
    rows = [
        (1, T(2024, 1, 1, 10), "OPEN", 10, 3, 7, 1),
        (1, T(2024, 1, 1, 10), "OPEN", 10, 5, 5, 2),  # later batch wins
        (2, T(2024, 1, 1, 10), "OPEN", 10, 1, 9, 1),
        (2, T(2024, 1, 1, 10), "CLOSED", 10, 1, 9, 1),  # equal order key: greatest row
        (3, T(2024, 1, 1, 10), "OPEN", 10, 1, 9, 1),
        (3, T(2024, 1, 1, 10), "OPEN", 10, 1, 9, 1),  # exact copy
    ]
    df = spark.createDataFrame(rows, OBS)
    out = {r.site_id: r for r in dedup_latest(df, ["site_id", "obs_ts"], ["batch"]).collect()}
    assert len(out) == 3
    assert out[1].available == 5 and out[1].batch == 2
    assert out[2].status == "OPEN"
    # Same answer whatever the input partitioning.
    again = {r.site_id: r for r in dedup_latest(df.repartition(3), ["site_id", "obs_ts"], ["batch"]).collect()}
    assert again == out
    assert dedup_latest(df, ["site_id", "obs_ts"]).columns == df.columns


def test_agg7_parsed_instant_dedups_two_offsets(spark):
    landed = spark.createDataFrame(
        [
            ("2024-09-01 14:00:00+02:00", 7, "OPEN", 10, 4, 6, None),
            ("2024-09-01 12:00:00Z", 7, "OPEN", 10, 4, 6, None),
        ],
        "horodate string, station_id bigint, status string, capacity int, bikes_available int, "
        "stands_available int, raw string",
    )
    obs = from_landed(landed)
    # The raw-text key counts the instant twice (m2); the parsed key once.
    assert dedup_any(obs, ["site_id", "obs_text"]).count() == 2
    assert dedup_latest(obs, ["site_id", "obs_ts"]).count() == 1


def test_agg7_hot_key_collapses_before_shuffle(spark):
    df = spark.range(0, 20000).select(
        F.lit(1).cast("bigint").alias("site_id"), F.lit(T(2024, 1, 1)).alias("obs_ts"), (F.col("id") % 3).alias("v")
    )
    out = dedup_latest(df, ["site_id", "obs_ts"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan
    assert out.collect()[0].v == 2


def _sites(spark):
    return spark.createDataFrame(
        [
            (1, "Alpha", "Zone A", 45.0, 4.0),
            (2, None, "Zone A", 45.1, 4.1),  # known site, null name (m3)
            (3, "Gamma", None, 45.2, 4.2),  # null zone, overridden (m4)
            (4, "Delta", None, 45.3, 4.3),  # null zone, no override (m5)
            (5, "Echo", "Zone B", 45.4, 4.4),
            (5, "Echo", "Zone B", 45.4, 4.4),  # duplicated key (m17)
        ],
        SITES,
    )


def _obs(spark):
    rows = [(s, T(2024, 1, 1, 10, 5), "OPEN", 10, 5, 5, 1) for s in (1, 2, 3, 4, 5, 9)]
    return spark.createDataFrame(rows, OBS)


def test_jon1_orphans_by_key_and_by_name(spark):
    ovr = spark.createDataFrame([(3, "Zone C"), (9, "Zone Z"), (1, "Ignored")], "site_id bigint, zone string")
    by_key = attach_sites(_obs(spark), _sites(spark), ovr)
    assert by_key.count() == 6  # duplicated dimension key does not fan out
    flags = {r.site_id: r for r in by_key.collect()}
    assert [s for s, r in flags.items() if r.is_orphan] == [9]
    assert flags[3].zone == "Zone C"  # override used because zone is NULL
    assert flags[1].zone == "Zone A"  # override ignored when zone is set
    assert flags[4].zone is None
    assert flags[9].zone == "Zone Z"  # unknown site keeps the override, stays orphan
    by_name = attach_sites(_obs(spark), _sites(spark), ovr, orphan_on="site_name")
    assert sorted(r.site_id for r in by_name.collect() if r.is_orphan) == [2, 9]
    matched, orphans = split_orphans(by_key)
    assert matched.count() + orphans.count() == by_key.count()


def test_jon2_context_match_null_zone_and_null_measure(spark):
    sites = _sites(spark)
    df = with_slot(split_orphans(attach_sites(_obs(spark), sites))[0])
    ctx = spark.createDataFrame(
        [
            ("Zone A", T(2024, 1, 1, 10, 0), 12.5),
            ("Zone B", T(2024, 1, 1, 10, 0), None),  # matched, measure NULL (m16)
            ("Zone B", T(2024, 1, 1, 10, 0), 3.0),  # duplicate context key (m17)
            (None, T(2024, 1, 1, 10, 0), 99.0),  # NULL zone never matches (m5)
        ],
        "zone string, ctx_ts timestamp_ntz, temperature_2m_c double",
    )
    out = {r.site_id: r for r in attach_context(df, ctx, ["temperature_2m_c"]).collect()}
    assert len(out) == 5
    assert out[1].has_context and out[1].temperature_2m_c == 12.5
    assert out[5].has_context and out[5].temperature_2m_c == 3.0  # greatest of the duplicates
    assert not out[4].has_context and out[4].temperature_2m_c is None
    missing = {r.zone for r in zones_without_context(df, ctx).collect()}
    assert missing == {None}


def test_enr3_fill_rate_guarded(spark):
    df = spark.createDataFrame(
        [(1, 10, 5), (2, 0, 0), (3, None, 1), (4, 3, 1), (5, 32, 1)], "id int, capacity int, available int"
    )
    got = {r.id: r.fill_rate for r in with_fill_rate(df).collect()}
    assert got == {1: 50.0, 2: None, 3: None, 4: 33.33, 5: 3.13}


def _jobs(spark):
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))


def test_joins_run_no_job_while_they_are_built(spark):
    obs, sites = _obs(spark), _sites(spark)
    before = _jobs(spark)
    joined = attach_sites(obs, sites)
    assert _jobs(spark) == before
    assert "SinglePartition" not in joined._jdf.queryExecution().executedPlan().toString()


def test_hot_key_gives_the_same_rows_by_either_join(spark):
    facts = spark.range(3000).selectExpr("if(id % 3 = 0, 7, id) AS k", "id AS v")  # one key holds a third
    side = spark.range(0, 3000, 2).selectExpr("id AS k", "id * 10 AS w")
    want = sorted(map(tuple, many_to_one_join(facts, side, ["k"], ["k"]).collect()), key=str)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = many_to_one_join(facts, side, ["k"], ["k"])
        assert "BroadcastHashJoin" not in shuffled._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, shuffled.collect()), key=str) == want and len(want) == 3000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_latest_fetch_wins(spark):
    ctx = spark.createDataFrame(
        [("Z", T(2024, 7, 1, 10, 0), 30.0, "20240701T000000Z"), ("Z", T(2024, 7, 1, 10, 0), 21.5, "20240801T000000Z")],
        "zone string, ctx_ts timestamp_ntz, temperature_2m_c double, ingested_at string",
    )
    obs = spark.createDataFrame([(1, "Z", T(2024, 7, 1, 10, 0))], "site_id bigint, zone string, slot_ts timestamp_ntz")
    row = attach_context(obs, ctx, ["temperature_2m_c"]).first()
    assert row.temperature_2m_c == 21.5 and "ingested_at" not in row
    sites = spark.createDataFrame(
        [(1, "Zeta", "Z9", 1.0, 1.0, "20240101"), (1, "Alpha", "Z1", 2.0, 2.0, "20240201")],
        "site_id bigint, site_name string, zone string, lat double, lon double, ingested_at string",
    )
    for ovr in (None, spark.createDataFrame([(1, "X")], "site_id bigint, zone string")):
        got = attach_sites(obs.drop("zone"), sites, ovr).first()
        assert (got.site_name, got.zone) == ("Alpha", "Z1")


def test_duplicate_keys_report(spark):
    assert [r.site_id for r in duplicate_keys(_sites(spark), ["site_id"]).collect()] == [5]


def test_m17_strict_mode_refuses_duplicate_keys(spark):
    import pytest

    with pytest.raises(ValueError, match="site dimension: duplicate keys"):
        attach_sites(_obs(spark), _sites(spark), on_duplicate="raise")
    unique_sites = _sites(spark).dropDuplicates(["site_id"])
    assert attach_sites(_obs(spark), unique_sites, on_duplicate="raise").count() == 6
    ctx = spark.createDataFrame(
        [("Zone A", T(2024, 1, 1, 10, 0), 1.0), ("Zone A", T(2024, 1, 1, 10, 0), 2.0)],
        "zone string, ctx_ts timestamp_ntz, temperature_2m_c double",
    )
    with pytest.raises(ValueError, match="context series"):
        attach_context(with_slot(_obs(spark)), ctx, ["temperature_2m_c"], on_duplicate="raise")
