
import dataclasses
import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from obsflow.functions.time import slot_start
from obsflow.operators.rollup import hourly_rollup
from obsflow.operators.rules import CONSISTENCY_RULES, split_by_rules
from obsflow.plans import catalog, roles
from obsflow.plans.batch_job import build_rows

SMOKE = "/root/testdata/sf0.001"


def _rows(spark, s=catalog.DRIVER_SETTINGS):
    return build_rows(
        roles.observations(spark, SMOKE),
        roles.sites(spark, SMOKE),
        roles.context(spark, SMOKE),
        s,
        roles.zone_overrides(spark, SMOKE),
    )


def test_whole_plan_is_independent_of_session_zone(spark):
    cols = ["site_id", "obs_ts", "slot_ts", "obs_local", "year", "month", "day", "hour", "disposition", "has_context"]
    utc = sorted(map(tuple, _rows(spark).select(*cols).collect()), key=repr)
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        paris = sorted(map(tuple, _rows(spark).select(*cols).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert utc == paris


def test_rollup_counts_sum_to_rows_and_dispositions_partition_input(spark):
    rows = _rows(spark)
    ok = rows.filter(F.col("disposition") == "ok")
    total = hourly_rollup(ok).agg(F.sum("n_obs")).first()[0]
    assert total == ok.count()
    n_in = roles.observations(spark, SMOKE).select("site_id", "obs_ts").distinct().count()
    assert rows.count() == n_in


def test_time_range_reaches_the_parquet_scan(spark):
    s = dataclasses.replace(catalog.DRIVER_SETTINGS, time_range=("2024-01-05", "2024-01-07"))
    rows = _rows(spark, s)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    scans = [ln for ln in plan.splitlines() if "events.parquet" in ln or "PushedFilters" in ln]
    # Local dates in Paris: an hour before the UTC dates.
    assert any("GreaterThanOrEqual(ts,2024-01-04T23:00" in ln for ln in scans)
    assert any("LessThan(ts,2024-01-07T23:00" in ln for ln in scans)
    got = rows.agg(F.min("obs_ts"), F.max("obs_ts")).first()
    assert got[0] >= dt.datetime(2024, 1, 4, 23) and got[1] < dt.datetime(2024, 1, 7, 23)


def test_range_bounds_a_date_partition_too(spark, tmp_dir):
    from obsflow.operators.incremental import in_date_range

    days = spark.range(0, 24 * 40).selectExpr("timestamp_ntz'2024-03-01' + make_dt_interval(0, id) AS obs_ts")
    days.withColumn("obs_date", F.to_date("obs_ts")).write.partitionBy("obs_date").parquet(tmp_dir)
    df = in_date_range(spark.read.parquet(tmp_dir), "2024-03-30", "2024-03-31", "Europe/Paris", date_col="obs_date")
    got = df.agg(F.count(F.lit(1)), F.min("obs_ts"), F.max("obs_ts")).first()
    # the clocks go forward on the 31st: 47 hours
    assert tuple(got) == (47, dt.datetime(2024, 3, 29, 23), dt.datetime(2024, 3, 31, 21))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(obs_date" in plan


_TS = st.datetimes(min_value=dt.datetime(1900, 1, 1), max_value=dt.datetime(2100, 1, 1))


@settings(max_examples=5, deadline=None)
@given(st.lists(_TS, min_size=1, max_size=200), st.sampled_from([1, 5, 15, 60]))
def test_slot_contains_its_time(spark, stamps, minutes):
    df = spark.createDataFrame([(t,) for t in stamps], "ts timestamp_ntz")
    for r in df.select("ts", slot_start("ts", minutes).alias("s")).collect():
        assert r.s <= r.ts < r.s + dt.timedelta(minutes=minutes)
        assert (r.s.hour * 60 + r.s.minute) % minutes == 0 and r.s.second == 0 and r.s.microsecond == 0


_CELL = st.one_of(st.none(), st.integers(min_value=-3, max_value=30))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(_CELL, _CELL), min_size=1, max_size=100))
def test_rule_split_partitions_any_input(spark, pairs):
    df = spark.createDataFrame([(i, c, a) for i, (c, a) in enumerate(pairs)], "id int, capacity int, available int")
    kept, broken = split_by_rules(df, CONSISTENCY_RULES)
    k = {r.id for r in kept.collect()}
    b = {r.id for r in broken.collect()}
    assert not (k & b) and len(k) + len(b) == len(pairs)
    for i, (c, a) in enumerate(pairs):
        valid = c is not None and a is not None and c > 0 and 0 <= a <= c
        assert (i in k) == valid


_KEY = st.integers(min_value=0, max_value=6)
_VAL = st.one_of(st.none(), st.integers(min_value=0, max_value=3))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(_KEY, _VAL, _VAL), min_size=1, max_size=60), st.integers(min_value=1, max_value=5))
def test_dedup_one_row_per_key_whatever_the_partitioning(spark, rows, parts):
    from obsflow.operators.dedup import dedup_latest

    df = spark.createDataFrame(rows, "k int, o int, v int")
    out = dedup_latest(df, ["k"], ["o"]).collect()
    assert sorted(r.k for r in out) == sorted({r[0] for r in rows})
    shuffled = dedup_latest(df.repartition(parts).sortWithinPartitions(F.rand(7)), ["k"], ["o"]).collect()
    assert sorted(map(tuple, out), key=repr) == sorted(map(tuple, shuffled), key=repr)
    for r in out:  # the survivor is the greatest (o, v) of its key
        group = [(o, v) for k, o, v in rows if k == r.k]
        key = lambda t: (t[0] is not None, t[0] or 0, t[1] is not None, t[1] or 0)
        assert (r.o, r.v) == max(group, key=key)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(_KEY, _VAL), max_size=20), st.lists(st.tuples(_KEY, _VAL), min_size=1, max_size=20))
def test_merge_is_idempotent_and_keeps_every_key(spark, stored, batch):
    from obsflow.operators.merge import keyed_merge

    existing = spark.createDataFrame(list({k: (k, v) for k, v in stored}.values()), "k int, v int")
    incoming = spark.createDataFrame(batch, "k int, v int")
    once = keyed_merge(existing, incoming, ["k"]).drop("change")
    twice = keyed_merge(once, incoming, ["k"])
    assert {r.change for r in twice.collect()} <= {"unchanged", "kept"}
    assert sorted(r.k for r in once.collect()) == sorted({k for k, _ in stored} | {k for k, _ in batch})
