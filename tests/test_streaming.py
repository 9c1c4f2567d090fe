"""STR1 (landing merge through foreachBatch) and STR2 (watermark dedup + site join)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from obsflow.streaming.jobs import dedup_enrich_stream, landing_stream

T = dt.datetime


def _items(spark, rows):
    import json

    docs = []
    for ts, site, status, cap, bikes, stands in rows:
        ms = None if cap is None else {"capacity": cap, "availabilities": {"bikes": bikes, "stands": stands}}
        docs.append((json.dumps({"horodate": ts, "number": site, "status": status, "main_stands": ms}),))
    return spark.createDataFrame(docs, "value string")


def test_str1_each_drop_merged_once_and_replay_is_idempotent(spark, tmp_dir):
    src, table, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/table", f"{tmp_dir}/ckpt"
    _items(
        spark,
        [
            ("2024-01-01 10:00:00+01:00", 1, "OPEN", 10, 4, 6),
            ("2024-01-01 09:00:00Z", 1, "OPEN", 10, 4, 6),  # same key: one row
            ("2024-01-01 10:15:00+01:00", 2, "OPEN", 10, 1, 9),
            ("bad time", 3, "OPEN", 10, 1, 9),  # no key: quarantined, not merged
        ],
    ).write.mode("append").text(src)
    landing_stream(spark, src, table, ckpt).awaitTermination()
    first = {(r.site_id, r.obs_ts): r for r in spark.read.parquet(table).collect()}
    assert set(first) == {(1, T(2024, 1, 1, 9, 0)), (2, T(2024, 1, 1, 9, 15))}
    bad = spark.read.parquet(table + "_quarantine").collect()
    assert [(r.site_id, r.obs_text) for r in bad] == [(3, "bad time")]  # kept, not dropped

    # A later drop revises one key and adds another; the checkpoint skips the first drop.
    _items(
        spark,
        [("2024-01-01 10:15:00+01:00", 2, "CLOSED", 10, 0, 10), ("2024-01-02 08:00:00Z", 4, "OPEN", 5, 5, 0)],
    ).write.mode("append").text(src)
    landing_stream(spark, src, table, ckpt).awaitTermination()
    second = {(r.site_id, r.obs_ts): r for r in spark.read.parquet(table).collect()}
    assert len(second) == 3
    assert second[(2, T(2024, 1, 1, 9, 15))].status == "CLOSED"
    assert sorted(r.obs_date for r in spark.read.parquet(table).select("obs_date").distinct().collect()) == [
        dt.date(2024, 1, 1),
        dt.date(2024, 1, 2),
    ]

    # Nothing new: a rerun changes nothing.
    landing_stream(spark, src, table, ckpt).awaitTermination()
    again = {(r.site_id, r.obs_ts): tuple(r) for r in spark.read.parquet(table).collect()}
    assert again == {k: tuple(v) for k, v in second.items()}


def test_str2_watermark_dedup_then_site_join(spark, tmp_dir):
    src, out, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    schema = "site_id bigint, obs_ts timestamp_ntz, status string"
    spark.createDataFrame(
        [
            (1, T(2024, 1, 1, 9), "OPEN"),
            (1, T(2024, 1, 1, 9), "OPEN"),
            (2, T(2024, 1, 1, 9), "OPEN"),
            (9, T(2024, 1, 1, 9), "OPEN"),
            (2, None, "OPEN"),  # no time: passes through, not lost
        ],
        schema,
    ).write.mode("append").parquet(src)
    sites = spark.createDataFrame([(1, "A", "Z", 45.0, 4.0), (2, "B", None, 45.0, 4.0)], "site_id bigint, site_name string, zone string, lat double, lon double")
    stream = spark.readStream.schema(schema).parquet(src)
    q = (
        dedup_enrich_stream(stream, sites, watermark="1 day")
        .writeStream.format("parquet")
        .option("checkpointLocation", ckpt)
        .trigger(availableNow=True)
        .start(out)
    )
    q.awaitTermination()
    got = {r.site_id: r for r in spark.read.parquet(out).filter("obs_ts IS NOT NULL").collect()}
    assert set(got) == {1, 2, 9}
    assert spark.read.parquet(out).filter("obs_ts IS NULL").count() == 1
    assert got[9].is_orphan and not got[1].is_orphan and got[1].zone == "Z"
    assert spark.read.parquet(out).filter(F.col("site_id") == 1).count() == 1


def test_str1_a_batch_without_a_readable_row(spark, tmp_dir):
    src, table, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/table", f"{tmp_dir}/ckpt"
    lines = ["{not json", '{"number": 5, "horodate": "??", "extra": 1}']
    spark.createDataFrame([(x,) for x in lines], "value string").write.mode("append").text(src)
    landing_stream(spark, src, table, ckpt).awaitTermination()
    assert sorted(r.raw for r in spark.read.parquet(table + "_quarantine").collect()) == sorted(lines)
    # the stream goes on with the next file
    _items(spark, [("2024-01-02 08:00:00Z", 4, "OPEN", 5, 5, 0)]).write.mode("append").text(src)
    landing_stream(spark, src, table, ckpt).awaitTermination()
    assert [r.site_id for r in spark.read.parquet(table).collect()] == [4]


def test_partition_must_follow_from_the_key(spark, tmp_dir):
    from obsflow.streaming.jobs import merge_into_table

    df = spark.createDataFrame([(1, T(2024, 1, 1), dt.date(2024, 1, 2))], "site_id bigint, obs_ts timestamp_ntz, obs_date date")
    with pytest.raises(ValueError, match="may not change its partition"):
        merge_into_table(spark, df, f"{tmp_dir}/t")


def test_str2_late_rows_are_counted(spark, tmp_dir):
    import time

    from obsflow.streaming.jobs import LateRows

    src, out, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    schema = "site_id bigint, obs_ts timestamp_ntz"
    sites = spark.createDataFrame([(1, "A", "Z", 1.0, 1.0)], "site_id bigint, site_name string, zone string, lat double, lon double")
    late = LateRows()
    spark.streams.addListener(late)
    try:
        for rows in ([(1, T(2024, 1, 1, 10)), (1, T(2024, 1, 1, 10))], [(1, T(2024, 1, 1, 14))], [(1, T(2024, 1, 1, 9)), (1, T(2024, 1, 1, 15))]):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
            stream = dedup_enrich_stream(spark.readStream.schema(schema).parquet(src), sites, watermark="1 hour")
            q = stream.writeStream.format("parquet").option("checkpointLocation", ckpt).trigger(availableNow=True).start(out)
            q.awaitTermination()
        for _ in range(50):
            if late.dropped.get(str(q.id)):
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(late)
    # read: 5 rows = 3 kept + 1 copy + 1 late
    assert spark.read.parquet(out).count() == 3 and late.dropped[str(q.id)] == 1


SITE = "site_id bigint, site_name string, zone string, lat double, lon double"


def test_str2_late_rows_are_kept_and_a_restart_goes_on(spark, tmp_dir):
    from obsflow.streaming.late import LateTables, dedup_enrich_keep_late, epochs, late_rows, merge_late

    schema = spark.createDataFrame([], "site_id bigint, obs_ts timestamp_ntz, status string").schema
    sites = spark.createDataFrame([(1, "A", "Z", 1.0, 1.0)], SITE)
    tables = LateTables(f"{tmp_dir}/stream")
    drops = [
        [(1, T(2024, 1, 1, 10), "a"), (1, T(2024, 1, 1, 10), "a"), (1, T(2024, 1, 1, 8), "a")],  # nothing is late in a first batch
        [(1, T(2024, 1, 1, 14), "b"), (1, T(2024, 1, 1, 10), "b")],  # a copy within the delay
        [(1, T(2024, 1, 1, 13), "c"), (1, T(2024, 1, 1, 12, 59), "c"), (1, T(2024, 1, 1, 13, 1), "c"), (1, None, "c"), (9, T(2024, 1, 1, 15), "c")],
        [(1, T(2024, 1, 1, 10), "d"), (1, T(2024, 1, 1, 14, 30), "d"), (9, T(2024, 1, 1, 15), "d")],
    ]
    for rows in drops:  # each a new start of the query on the same folders
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/src")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_dir}/src")
        dedup_enrich_keep_late(stream, sites, tables.base, "1 HOUR").awaitTermination()
    counts = [(r.n_read, r.n_kept, r.n_copies, r.n_late) for r in epochs(spark, tables).orderBy("epoch_id").collect()]
    assert counts == [(3, 2, 1, 0), (2, 1, 1, 0), (5, 3, 0, 2), (3, 1, 1, 1)]
    late = sorted((r.obs_ts, r.status, r.epoch_id, r.late_watermark) for r in late_rows(spark, tables, schema).collect())
    assert late == [
        (T(2024, 1, 1, 10), "d", 3, T(2024, 1, 1, 14)),
        (T(2024, 1, 1, 12, 59), "c", 2, T(2024, 1, 1, 13)),
        (T(2024, 1, 1, 13), "c", 2, T(2024, 1, 1, 13)),
    ]
    kept = spark.read.parquet(tables.out)
    whole = merge_late(kept, late_rows(spark, tables, schema), sites)
    assert whole.filter("obs_ts is not null").count() == len({(r[0], r[1]) for rows in drops for r in rows if r[1]})


def test_str2_a_replayed_batch_writes_the_same(spark, tmp_dir):
    from obsflow.streaming.late import LateTables, _one_batch, epochs

    schema = "site_id bigint, obs_ts timestamp_ntz"
    sites = spark.createDataFrame([(1, "A", "Z", 1.0, 1.0)], SITE)
    tables = LateTables(tmp_dir)
    batches = [[(1, T(2024, 1, 1, 10))], [(1, T(2024, 1, 1, 10)), (1, T(2024, 1, 1, 12))], [(1, T(2024, 1, 1, 8)), (1, T(2024, 1, 1, 12))]]
    for n in (0, 1, 1, 2, 1, 2):  # replays, even of a batch before the last
        _one_batch(spark.createDataFrame(batches[n], schema), n, tables, "1 HOUR", ["site_id", "obs_ts"], "obs_ts", sites, None)
    counts = [(r.n_read, r.n_kept, r.n_copies, r.n_late) for r in epochs(spark, tables).orderBy("epoch_id").collect()]
    assert counts == [(1, 1, 0, 0), (2, 1, 1, 0), (2, 0, 1, 1)]
    assert spark.read.parquet(tables.out).count() == 2 and spark.read.parquet(tables.late).count() == 1


def _landed(spark, table):
    return sorted((r.site_id, r.obs_ts, r.status) for r in spark.read.parquet(table).collect())


@pytest.mark.parametrize("buckets", [None, 4])
def test_str1_counts_of_each_batch(spark, tmp_dir, buckets):
    """Inserted, updated, unchanged and kept rows, whichever the layout."""
    src, table, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/table", f"{tmp_dir}/ckpt"
    drops = [
        [("2024-01-01 10:00:00Z", 1, "OPEN", 9, 4, 5), ("2024-01-01 11:00:00Z", 1, "OPEN", 9, 4, 5), ("2024-01-02 10:00:00Z", 2, "OPEN", 9, 4, 5)],
        [("2024-01-01 10:00:00Z", 1, "SHUT", 9, 4, 5), ("2024-01-01 11:00:00Z", 1, "OPEN", 9, 4, 5), ("2024-01-03 10:00:00Z", 3, "OPEN", 9, 4, 5)],
        [("bad", 1, "OPEN", 9, 4, 5)],
        [("2024-01-02 23:00:00Z", 4, "OPEN", 9, 4, 5)],
    ]
    for rows in drops:
        _items(spark, rows).coalesce(1).write.mode("append").text(src)
        landing_stream(spark, src, table, ckpt, buckets=buckets).awaitTermination()
    counts = spark.read.parquet(table + "_counts").orderBy("epoch_id").collect()
    got = [(r.n_inserted, r.n_updated, r.n_unchanged, r.n_kept, r.n_rows) for r in counts]
    assert got == [(3, 0, 0, 0, 3), (1, 1, 1, 0, 3), (0, 0, 0, 0, 0), (1, 0, 0, 1, 2)]
    assert _landed(spark, table) == [
        (1, T(2024, 1, 1, 10), "SHUT"), (1, T(2024, 1, 1, 11), "OPEN"), (2, T(2024, 1, 2, 10), "OPEN"), (3, T(2024, 1, 3, 10), "OPEN"), (4, T(2024, 1, 2, 23), "OPEN")
    ]


@pytest.mark.parametrize("buckets", [None, 4])
def test_counts_stay_when_a_batch_is_replayed(spark, tmp_dir, monkeypatch, buckets):
    from obsflow.sinks import bucketed
    from obsflow.streaming import jobs

    src, table, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/table", f"{tmp_dir}/ckpt"
    _items(spark, [("2024-01-01 10:00:00Z", 1, "OPEN", 9, 4, 5)]).write.text(src)
    real, where = (jobs.remove_folder, jobs) if buckets is None else (bucketed.swap_folders, bucketed)
    for cut in ("before", "after"):  # the batch fails around the change of the table, and is replayed

        def fail(spark, what, *args, cut=cut):
            if cut == "after" or buckets is None:
                real(spark, what, *args)
            if buckets is not None or "merge-stage" in what:
                raise OSError("lost")

        monkeypatch.setattr(where, "remove_folder" if buckets is None else "swap_folders", fail)
        with pytest.raises(Exception, match="lost"):
            landing_stream(spark, src, table, ckpt, buckets=buckets).awaitTermination()
        monkeypatch.undo()
    landing_stream(spark, src, table, ckpt, buckets=buckets).awaitTermination()
    r = spark.read.parquet(table + "_counts").first()
    assert (r.n_inserted, r.n_updated, r.n_unchanged, r.n_kept, r.n_rows) == (1, 0, 0, 0, 1)
    assert _landed(spark, table) == [(1, T(2024, 1, 1, 10), "OPEN")]


def test_bucketed_merge_does_not_shuffle_stored_rows(spark, tmp_dir):
    import re

    from obsflow.operators.dedup import dedup_latest
    from obsflow.sinks import bucketed
    from obsflow.streaming.jobs import landing_table, merge_into_table

    rows = spark.range(3000).selectExpr("id % 50 as site_id", "timestamp_ntz'2024-01-01' + make_dt_interval(cast(id % 3 as int), 0, cast(id as int)) as obs_ts", "id as v")
    rows = rows.withColumn("obs_date", F.to_date("obs_ts"))
    table = f"{tmp_dir}/table"
    assert merge_into_table(spark, rows, table, buckets=4)["n_inserted"] == 3000
    again = rows.filter("v % 2 = 0").withColumn("v", -F.col("v"))
    t = landing_table(table, rows.schema, buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dates = [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
        plan = bucketed.merged(spark, t, dedup_latest(again, t.keys), dates)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    stored = plan.split("FullOuter")[1].split("FileScan")[0]
    assert "Exchange" not in stored and "Bucketed: true" in plan and "PartitionFilters: []" not in plan
    assert re.search(r"SelectedBucketsCount: 4 out of 4", plan)
    counts = merge_into_table(spark, again, table, buckets=4)
    assert (counts["n_updated"], counts["n_unchanged"], counts["n_kept"]) == (1499, 1, 1500)
    got = bucketed.open_table(spark, t)
    assert got.count() == 3000 and got.agg(F.sum("v")).first()[0] == sum(v if v % 2 else -v for v in range(3000))
    # the definition is made anew where the catalog does not have it
    spark.sql(f"DROP TABLE {t.name}")
    assert bucketed.open_table(spark, t).count() == 3000
    with pytest.raises(ValueError, match="laid out as"):
        bucketed.open_table(spark, landing_table(table, rows.schema, buckets=8))
    merge_into_table(spark, rows, f"{tmp_dir}/plain")
    with pytest.raises(ValueError, match="not bucketed"):
        bucketed.open_table(spark, landing_table(f"{tmp_dir}/plain", rows.schema, buckets=4))
