"""Registered queries over the driver tables, one per inventory item.

Each query is ``(spark, sf_dir) -> DataFrame`` built from the library's
operators on the role frames of ``plans.roles``; ``ORACLE_SQL`` holds the
equivalent DuckDB SQL with the same output column names. Every query reads
whole tables; a limit appears only where it is the feature (top-k, latest).
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.functions.text import geo_point
from obsflow.functions.time import date_of_text, ingest_stamp, local_to_utc, parse_instant, slot_start
from obsflow.operators import quality, rollup
from obsflow.operators.dedup import dedup_any, dedup_latest
from obsflow.operators.enrich import (
    attach_context,
    attach_sites,
    context_lookup,
    site_lookup,
    split_orphans,
    with_fill_rate,
    with_local_calendar,
    with_slot,
    zones_without_context,
)
from obsflow.operators.incremental import backfill_plan, in_date_range, resume_point, weekly_windows
from obsflow.operators.merge import keyed_merge, merge_counts
from obsflow.operators.reshape import (
    explode_records,
    flatten_items,
    items_from_lines,
    non_empty_pages,
    sites_from_records,
)
from obsflow.operators.rules import (
    CONSISTENCY_RULES,
    RATE_RULES,
    Rule,
    quarantine_null_keys,
    split_by_rules,
    with_reasons,
)
from obsflow.plans import roles
from obsflow.plans.batch_job import BatchSettings, latest_published, published_table, run_batch, run_incremental
from obsflow.schemas import RAW_OBSERVATION_ITEM
from obsflow.session import new_work_path
from obsflow.sinks.archive import write_context_archive, write_page_snapshot
from obsflow.sinks.parquet import preview, read_back, write_partitioned
from obsflow.sources.context_csv import (
    accept_context,
    context_from_lines,
    context_from_texts,
    read_lines,
    read_texts,
    split_text,
    typed_measures,
)
from obsflow.sources.pages import read_sites

TZ = roles.TIME_ZONE
MEASURES = roles.CONTEXT_ROLE_MEASURES
OBS_KEYS = ["site_id", "obs_ts"]

# Gate for the driver mapping: zone and context coverage are partial by
# construction of the roles, so those two figures are reported, not blocking.
DRIVER_GATE_RULES: tuple[Rule, ...] = (
    Rule("time_null", lambda: F.col("obs_ts").isNull()),
    Rule("site_name_null", lambda: F.col("site_name").isNull()),
    Rule("zone_null", lambda: F.col("zone").isNull(), blocking=False),
    Rule("capacity_non_positive", lambda: F.col("capacity") <= 0),
    Rule("available_negative", lambda: F.col("available") < 0),
    Rule("context_null", lambda: F.col("temperature_2m_c").isNull(), blocking=False),
    Rule("fill_rate_out_of_range", lambda: (F.col("fill_rate") < 0) | (F.col("fill_rate") > 100)),
)

DRIVER_SETTINGS = BatchSettings(
    time_zone=TZ,
    measures=MEASURES,
    dedup_order=("batch",),
    gate_rules=DRIVER_GATE_RULES,
    extra_columns=(),
)


# --- shared building blocks ------------------------------------------------


def dedup(spark: SparkSession, d: str) -> DataFrame:
    return dedup_latest(roles.observations(spark, d), OBS_KEYS, ["batch"])


def enriched(spark: SparkSession, d: str) -> DataFrame:
    return attach_sites(dedup(spark, d), roles.sites(spark, d), roles.zone_overrides(spark, d))


def matched(spark: SparkSession, d: str) -> DataFrame:
    return split_orphans(enriched(spark, d))[0].drop("is_orphan")


def matched_sites_only(spark: SparkSession, d: str) -> DataFrame:
    """Matched observations without the dedup: for questions about which
    sites and zones occur, which copies cannot change (no fact shuffle)."""
    obs = roles.observations(spark, d)
    return split_orphans(attach_sites(obs, roles.sites(spark, d), roles.zone_overrides(spark, d)))[0]


def joined(spark: SparkSession, d: str) -> DataFrame:
    return attach_context(with_slot(matched(spark, d)), roles.context(spark, d), MEASURES)


def final_all(spark: SparkSession, d: str) -> DataFrame:
    """Matched rows with context, rate and calendar, before the rule filter."""
    return with_local_calendar(with_fill_rate(joined(spark, d)), TZ)


def final(spark: SparkSession, d: str) -> DataFrame:
    return split_by_rules(final_all(spark, d), CONSISTENCY_RULES)[0]


def obs_text(ts: str = "ts") -> F.Column:
    """Observation time text in several landed forms, one per event type."""
    base = F.date_format(F.col(ts), "yyyy-MM-dd HH:mm:ss")
    return (
        F.when(F.col("event_type") == "view", F.concat(base, F.lit("+00:00")))
        .when(
            F.col("event_type") == "click",
            F.concat(F.date_format(F.col(ts) + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd HH:mm:ss"), F.lit("+02:00")),
        )
        .when(F.col("event_type") == "error", F.concat(base, F.lit("Z")))
        .when(F.col("event_type") == "purchase", F.concat(F.date_format(F.col(ts), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00")))
        .otherwise(base)
    )


def _parsed_events(spark: SparkSession, d: str) -> DataFrame:
    ev = roles.table(spark, d, "events")
    t = ev.select("event_id", F.col("user_id").alias("site_id"), obs_text().alias("obs_text"))
    return t.withColumn("obs_ts", parse_instant("obs_text"))


# --- queries ---------------------------------------------------------------


def q_dedup_latest(spark, d):
    """AGG7, m2: one row per (site, instant), latest landing batch wins."""
    return dedup(spark, d)


def q_dedup_plain_count(spark, d):
    """AGG7: the reference's plain dropDuplicates, counted."""
    return dedup_any(roles.observations(spark, d), OBS_KEYS).agg(F.count(F.lit(1)).alias("n_rows"))


def q_enrich_site_left(spark, d):
    """JON1, PRJ2, PRJ3, ENR1: left join to the site dimension, orphans flagged."""
    return enriched(spark, d)


def q_orphan_split(spark, d):
    """FLT1: the orphan side of the split."""
    return split_orphans(enriched(spark, d))[1].drop("is_orphan")


def q_join_quality(spark, d):
    """DQ1: rows read, matched, orphaned."""
    return quality.join_quality(enriched(spark, d))


def q_zone_override(spark, d):
    """FN10-FN12, FLT6: zone taken from the override only where NULL."""
    lk = site_lookup(roles.sites(spark, d), roles.zone_overrides(spark, d))
    return lk.select(
        "site_id", "site_name", "zone", F.coalesce(F.col("__in_dimension"), F.lit(False)).alias("in_dimension")
    )


def q_slot_15min(spark, d):
    """FN2-FN5: 15-minute slot of each observation."""
    return dedup(spark, d).select("site_id", "obs_ts", slot_start("obs_ts", 15).alias("slot_ts"))


def q_enrich_context(spark, d):
    """JON2, ENR2: left join on (zone, slot) to the context series."""
    return joined(spark, d)


def q_context_match_report(spark, d):
    """DQ4, m16: rows, rows without a context match, rows with a NULL measure."""
    return quality.context_match_report(joined(spark, d), "temperature_2m_c")


def q_zones_without_context(spark, d):
    """JON3, AGG4, DQ2: fact zones absent from the context."""
    return zones_without_context(matched_sites_only(spark, d), roles.context(spark, d))


def q_zone_coverage(spark, d):
    """DQ2: distinct fact zones and how many lack context."""
    return quality.zone_coverage(matched_sites_only(spark, d), roles.context(spark, d))


def q_null_zone_sites(spark, d):
    """FLT5, AGG5, DQ3: distinct sites whose zone is NULL."""
    return quality.null_attribute_sites(matched_sites_only(spark, d), "zone")


def q_null_zone_counts(spark, d):
    """AGG6, DQ3, m12: rows and distinct sites with a NULL zone."""
    return quality.null_attribute_report(matched(spark, d), "zone")


def q_capacity_anomalies(spark, d):
    """FLT2, DQ5: rows breaking the consistency rules, with reasons."""
    _, broken = split_by_rules(joined(spark, d), CONSISTENCY_RULES)
    out = with_reasons(broken, CONSISTENCY_RULES)
    return out.select("site_id", "obs_ts", "capacity", "available", "free", F.array_join("reasons", ",").alias("reasons"))


def q_capacity_valid(spark, d):
    """FLT3: the exact complement of the anomalies."""
    kept, _ = split_by_rules(joined(spark, d), CONSISTENCY_RULES)
    return kept.select("site_id", "obs_ts", "status", "capacity", "available", "free")


def q_fill_rate(spark, d):
    """FN8, FN9, ENR3: guarded percentage, 2 decimals."""
    return final(spark, d).select("site_id", "obs_ts", "capacity", "available", "fill_rate")


def q_rate_out_of_range(spark, d):
    """FLT4, DQ7: rows whose rate is outside 0-100."""
    # Measured before the consistency filter, where the rule can fire (m15).
    _, broken = split_by_rules(final_all(spark, d), RATE_RULES)
    return broken.select("site_id", "site_name", "obs_ts", "capacity", "available", "free", "fill_rate")


def q_local_calendar(spark, d):
    """FN6, FN7, ENR4: local wall clock and calendar fields."""
    return final(spark, d).select("site_id", "obs_ts", "obs_local", "year", "month", "day", "hour")


def q_quality_gate(spark, d):
    """AGG1, DQ6: gate figures after the filters, with the verdict."""
    return quality.quality_gate(final(spark, d), DRIVER_GATE_RULES)


def q_quality_gate_matched(spark, d):
    """DQ6, m15: the same figures before the filters."""
    return quality.quality_gate(final_all(spark, d), DRIVER_GATE_RULES)


def q_reconciliation(spark, d):
    """DQ8, AGG3: read = matched + orphans, final = matched - anomalies."""
    from obsflow.plans.batch_job import build_rows

    rows = build_rows(
        roles.observations(spark, d),
        roles.sites(spark, d),
        roles.context(spark, d),
        DRIVER_SETTINGS,
        roles.zone_overrides(spark, d),
    )
    disp = F.col("disposition")
    counts = rows.agg(
        F.count(F.lit(1)).alias("n_read"),
        F.count_if(disp.isin("ok", "anomaly")).alias("n_matched"),
        F.count_if(disp == "orphan").alias("n_orphans"),
        F.count_if(disp == "anomaly").alias("n_anomalies"),
        F.count_if(disp == "ok").alias("n_final"),
    )
    c = F.col
    return counts.select("*", *quality.reconciliation(c("n_read"), c("n_matched"), c("n_orphans"), c("n_anomalies"), c("n_final")))


def q_site_hour_rollup(spark, d):
    """AGG2, ENR5: site x local hour roll-up."""
    return rollup.hourly_rollup(final(spark, d))


def q_site_hour_top20(spark, d):
    """SRT1: first 20 groups of the roll-up (a top-k report)."""
    return rollup.top_n(rollup.hourly_rollup(final(spark, d)), ["site_id", "year", "month", "day", "hour"], 20)


def q_zone_hour_rollup(spark, d):
    """AGG2: the roll-up at zone x local hour."""
    return rollup.hourly_rollup(final(spark, d), rollup.ZONE_HOUR_KEYS)


def q_latest_observation(spark, d):
    """SRT3: the latest observation (top 1)."""
    return rollup.latest_row(dedup(spark, d), "obs_ts", ["site_id"])


def q_latest_time(spark, d):
    """AGG8: the latest observation time."""
    # Dedup cannot change the set of times: no shuffle of the facts needed.
    return rollup.latest_time(roles.observations(spark, d))


def q_resume_point(spark, d):
    """INC1, m21: next load's start and end dates."""
    return resume_point(roles.observations(spark, d), "obs_ts", end="2024-02-15", tz=TZ)


def q_date_range_scan(spark, d):
    """FLT7: inclusive date-range scan, pushed to Parquet."""
    base = in_date_range(roles.observation_base(spark, d), "2024-01-05", "2024-01-08")
    return base.select("site_id", "obs_ts", "status")


def _obs_range(spark, d) -> DataFrame:
    # Min and max time are the same before and after dedup: partial aggregate only.
    return roles.observations(spark, d).agg(
        F.to_date(F.min("obs_ts")).alias("start_date"), F.to_date(F.max("obs_ts")).alias("end_date")
    )


def q_weekly_windows(spark, d):
    """INC2, m22: 7-day windows over the observed range."""
    return weekly_windows(_obs_range(spark, d))


def q_backfill_plan(spark, d):
    """INC3, JON4: every zone x every window."""
    zones = roles.sites(spark, d).select("zone").where(F.col("zone").isNotNull()).distinct()
    return backfill_plan(zones, _obs_range(spark, d))


def q_keyed_merge(spark, d):
    """SNK3, INC4, m20: upsert of a reload window with change labels."""
    return keyed_merge(roles.stored_orders(spark, d), roles.reloaded_orders(spark, d), ["o_orderkey"])


def q_merge_counts(spark, d):
    """SNK3: inserted / updated / unchanged / kept counts."""
    return merge_counts(q_keyed_merge(spark, d))


def q_time_text_parse(spark, d):
    """FN1, m1: time text in several landed forms, parsed strictly."""
    return _parsed_events(spark, d)


def q_key_quarantine(spark, d):
    """FLT9, m19: rows whose key has a NULL part."""
    _, rejected = quarantine_null_keys(_parsed_events(spark, d), OBS_KEYS)
    return rejected.select("event_id", "site_id", "obs_text")


def _site_pages(spark, d) -> DataFrame:
    """Site dimension as API pages of at most 100 records (bounded groups)."""
    s = roles.sites(spark, d)
    rec = F.struct(
        F.col("site_id").alias("idstation"),
        F.col("site_name").alias("nom"),
        F.col("zone").alias("commune"),
        "lat",
        "lon",
        F.col("lon").cast("int").alias("nbbornettes"),
    )
    page = F.floor(F.col("site_id") / 100).alias("page_no")
    return s.groupBy(page).agg(F.collect_list(rec).alias("values"))


def q_pages_explode(spark, d):
    """PRJ1, FN21, FLT8: pages of records exploded back to sites."""
    return sites_from_records(explode_records(non_empty_pages(_site_pages(spark, d))))


def q_pages_roundtrip(spark, d):
    """SNK5, SRC1, SRC7: page snapshots written and the latest read back."""
    path = new_work_path(spark, "site-pages")
    pages = _site_pages(spark, d)
    # An older snapshot without the zone fix, then the current one.
    stale = pages.select(F.transform("values", lambda r: r.withField("commune", F.lit(None).cast("string"))).alias("values"))
    write_page_snapshot(stale, path, "20240101T000000000000Z")
    write_page_snapshot(pages.select("values"), path, "20240201T000000000000Z")
    return read_sites(spark, path)


def _raw_items(spark, d) -> DataFrame:
    return _raw_items_from(roles.observation_base(spark, d)).drop("batch")


def _raw_items_from(ob: DataFrame) -> DataFrame:
    item = F.struct(
        F.concat(F.date_format("obs_ts", "yyyy-MM-dd HH:mm:ss"), F.lit("+00:00")).alias("horodate"),
        F.col("site_id").alias("number"),
        F.col("status"),
        F.struct(
            F.col("capacity"),
            F.struct(F.col("available").alias("bikes"), F.col("free").alias("stands")).alias("availabilities"),
        ).alias("main_stands"),
    )
    batch = F.col("batch") if "batch" in ob.columns else F.lit(1)
    return ob.select("event_id", F.to_json(item).alias("raw"), batch.alias("batch"))


def q_raw_payload(spark, d):
    """PRJ6, FN20: the whole feed item kept as JSON."""
    return _raw_items(spark, d)


def q_nested_flatten(spark, d):
    """PRJ5, m18: nested feed items flattened."""
    items = _raw_items(spark, d).select("event_id", F.from_json("raw", RAW_OBSERVATION_ITEM).alias("item"))
    flat = flatten_items(items.select("item.*"), keep_raw=False)
    return flat


def q_geo_point(spark, d):
    """PRJ7: GeoJSON point, longitude first."""
    s = roles.sites(spark, d)
    return s.select("site_id", F.to_json(geo_point("lon", "lat")).alias("location"))


def _context_texts(spark, d, ctx: DataFrame | None = None) -> DataFrame:
    """Context rows rendered as provider CSV texts, one per zone and local week."""
    from obsflow.schemas import CONTEXT_CSV_COLUMNS

    ctx = roles.context(spark, d) if ctx is None else ctx
    local = F.convert_timezone(F.lit("UTC"), F.lit(TZ), F.col("ctx_ts"))
    cells = [F.date_format(local, "yyyy-MM-dd'T'HH:mm")]
    for _, name, _ in CONTEXT_CSV_COLUMNS[1:]:
        cells.append(F.coalesce(F.col(name).cast("string"), F.lit("")) if name in MEASURES else F.lit(""))
    line = F.concat_ws(",", *cells)
    header = ",".join(h for h, _, _ in CONTEXT_CSV_COLUMNS)
    # One text per zone and local week (at most 7 x 96 lines: a bounded group).
    week = F.to_date(F.date_trunc("week", local)).alias("start")
    grouped = ctx.groupBy("zone", week).agg(F.sort_array(F.collect_list(F.struct(local.alias("t"), line.alias("l")))).alias("ls"))
    text = F.concat_ws(
        "\n",
        F.lit("latitude,longitude,elevation"),
        F.lit("0.0,0.0,0.0"),
        F.lit(""),
        F.lit(header),
        F.array_join(F.transform("ls", lambda s: s["l"]), "\n"),
    )
    return grouped.select("zone", "start", F.date_add("start", 6).alias("end"), F.concat(text, F.lit("\n")).alias("value"))


def q_typed_cells(spark, d):
    """SRC5, PRJ8, FN14, FN17: CSV texts parsed by header name."""
    texts = _context_texts(spark, d)
    rows = split_text(texts).withColumns(typed_measures("cells"))
    from obsflow.functions.time import parse_local_text

    rows = rows.withColumn("ctx_ts", parse_local_text("ctx_time_text", TZ))
    return rows.select("zone", "ctx_ts", *MEASURES)


def _zones(spark, d) -> DataFrame:
    return roles.table(spark, d, "nation").select(
        F.col("n_name").alias("zone"), F.col("n_nationkey").cast("double").alias("lat"), F.lit(0.0).alias("lon")
    )


def q_context_csv_roundtrip(spark, d):
    """SNK6, SRC6, FN18, m24: CSV archive written and read back by path."""
    path = new_work_path(spark, "context-archive")
    write_context_archive(_context_texts(spark, d), path, "20240201T000000000000Z")
    zones = _zones(spark, d)
    ctx = context_from_texts(read_texts(spark, path), TZ, zones)
    return ctx.select("zone", "ctx_ts", *MEASURES, "row_ok")


def q_local_to_instant(spark, d):
    """FN13, m9: local wall clock to UTC."""
    ev = roles.table(spark, d, "events")
    return ev.select("event_id", F.col("ts").alias("local_ts"), local_to_utc("ts", TZ).alias("utc_ts"))


def q_partitioned_roundtrip(spark, d):
    """SNK1, SRC3, SNK8: partitioned write, pruned read-back."""
    path = new_work_path(spark, "rows")
    write_partitioned(final(spark, d), path, ["year", "month"])
    return read_back(spark, path, F.col("month") == 1)


def _batch(spark, d):
    out = new_work_path(spark, "batch")
    res = run_batch(
        spark,
        roles.observations(spark, d),
        roles.sites(spark, d),
        roles.context(spark, d),
        out,
        DRIVER_SETTINGS,
        roles.zone_overrides(spark, d),
    )
    if not res.published:
        raise RuntimeError(f"gate refused publication: {res.verdict}")
    return res


def q_batch_rows(spark, d):
    """ENR6, SNK1: the published row grain of the whole job."""
    return spark.read.parquet(_batch(spark, d).rows_path)


def q_batch_hours(spark, d):
    """ENR6, SNK2: the published hour grain of the whole job."""
    return spark.read.parquet(_batch(spark, d).hours_path)


def q_batch_quality(spark, d):
    """DQ6: the job's quality-table row."""
    res = _batch(spark, d)
    return spark.read.parquet(res.rows_path.rsplit("/", 1)[0] + "/quality").drop("run_id")


def q_stream_landing_merge(spark, d):
    """STR1: raw items land in two drops; each run merges only new files."""
    from obsflow.streaming.jobs import await_available_now, landing_stream

    base = new_work_path(spark, "stream-landing")
    src, table_path, ckpt = f"{base}/source", f"{base}/table", f"{base}/checkpoint"
    items = _raw_items_from(roles.observations(spark, d))
    items.filter(F.col("batch") == 1).select(F.col("raw").alias("value")).write.mode("append").text(src)
    await_available_now(landing_stream(spark, src, table_path, ckpt))
    # The re-fetched window arrives later; the checkpoint skips the first drop.
    items.filter(F.col("batch") == 2).select(F.col("raw").alias("value")).write.mode("append").text(src)
    await_available_now(landing_stream(spark, src, table_path, ckpt))
    return spark.read.parquet(table_path)


def q_stream_dedup_enrich(spark, d):
    """STR2: watermark dedup of a file stream, then the stream-static site join."""
    from obsflow.streaming.jobs import await_available_now, dedup_enrich_stream

    base = new_work_path(spark, "stream-dedup")
    src, out, ckpt = f"{base}/source", f"{base}/out", f"{base}/checkpoint"
    obs = roles.observations(spark, d)
    obs.filter(F.col("batch") == 1).write.mode("append").parquet(src)
    obs.filter(F.col("batch") == 2).write.mode("append").parquet(src)
    stream = spark.readStream.schema(obs.schema).parquet(src).drop("event_id", "batch")
    lookup_sites = roles.sites(spark, d)
    enriched_stream = dedup_enrich_stream(
        stream, lookup_sites, watermark="40 days", overrides=roles.zone_overrides(spark, d)
    )
    q = (
        enriched_stream.writeStream.format("parquet")
        .option("checkpointLocation", ckpt)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(out)
    )
    await_available_now(q)
    return spark.read.parquet(out)


def q_store_load(spark, d):
    """SRC2/SRC4: the format-neutral loader with a declared schema and options."""
    from obsflow.sources.store import load_table

    path = f"{d.rstrip('/')}/events.parquet"
    ev = load_table(spark, "parquet", roles.DRIVER_SCHEMAS["events"], path, {"mergeSchema": "false"})
    return ev.select("event_id", "user_id", "ts", "event_type")


def q_landed_concat(spark, d):
    """PRJ10: two landing drops with different columns, concatenated by name."""
    from obsflow.operators.reshape import concat_frames

    obs = roles.observations(spark, d)
    first = obs.filter(F.col("batch") == 1).drop("free")  # an older drop without the column
    again = obs.filter(F.col("batch") == 2)
    return concat_frames([first, again])


def q_append_roundtrip(spark, d):
    """SNK4: keyless appends accumulate; read back whole."""
    from obsflow.sinks.parquet import append

    path = new_work_path(spark, "append")
    base = roles.observation_base(spark, d)
    append(base.withColumn("drop_no", F.lit(1)), path)
    append(base.withColumn("drop_no", F.lit(2)), path)
    return spark.read.parquet(path)


def _written_sides(spark, d):
    """The sites and the context, each written once: several runs read them and
    none works out the context from the events again."""
    base = new_work_path(spark, "batch-sides")
    out = []
    for name, df in (("sites", roles.sites(spark, d)), ("context", roles.context(spark, d))):
        df.write.parquet(f"{base}/{name}")
        out.append(spark.read.schema(df.schema).parquet(f"{base}/{name}"))
    return out


def _two_runs(spark, d, first, second, settings, sides=None):
    """Publish ``first`` with the driver settings, then ``second`` with
    ``settings`` into the same folder; the folder. ``sides``: the sites and the
    context, if they are written already."""
    out = new_work_path(spark, "batch-two")
    others = (*(sides or _written_sides(spark, d)), out)
    run_batch(spark, first, *others, DRIVER_SETTINGS, roles.zone_overrides(spark, d))
    res = run_batch(spark, second, *others, settings, roles.zone_overrides(spark, d))
    if not res.published:
        raise RuntimeError(f"gate refused publication: {res.verdict}")
    return out


FULL_REPLACE_BEFORE = "2024-05-20 00:00:00"
RANGE_REPLACED = ("2024-03-15", "2024-04-20")
INCREMENTAL_CUT = "2024-04-09 22:30:00"
CORRECTED_STATUS = "view"


def q_batch_full_replace(spark, d):
    """SNK1, ENR6: a full run replaces the whole table; vanished months go."""
    obs = roles.spread_observations(spark, d)
    again = obs.filter(F.col("obs_ts") < F.lit(FULL_REPLACE_BEFORE).cast("timestamp_ntz"))
    return spark.read.parquet(_two_runs(spark, d, obs, again, DRIVER_SETTINGS) + "/rows")


def q_batch_full_replace_hours(spark, d):
    """SNK2, ENR6: the roll-up after a full replacement."""
    obs = roles.spread_observations(spark, d)
    again = obs.filter(F.col("obs_ts") < F.lit(FULL_REPLACE_BEFORE).cast("timestamp_ntz"))
    return spark.read.parquet(_two_runs(spark, d, obs, again, DRIVER_SETTINGS) + "/hours")


def q_batch_range_replace(spark, d):
    """SNK1, INC4: a run over local dates replaces these and keeps the others."""
    obs = roles.spread_observations(spark, d)
    revised = obs.withColumn("status", F.lit("revised"))
    settings = dataclasses.replace(DRIVER_SETTINGS, time_range=RANGE_REPLACED)
    return spark.read.parquet(_two_runs(spark, d, obs, revised, settings) + "/rows")


def q_batch_merge_correction(spark, d):
    """INC4: keys that are read again and rejected leave the published table."""
    obs = roles.spread_observations(spark, d)
    wrong = obs.filter(F.col("status") == CORRECTED_STATUS).withColumn("available", F.col("capacity") + 1)
    settings = dataclasses.replace(DRIVER_SETTINGS, publish_mode="merge")
    return spark.read.parquet(_two_runs(spark, d, obs, wrong, settings) + "/rows")


def q_batch_incremental(spark, d):
    """INC1, INC4: two loads, cut late on a summer evening, equal one."""
    obs = roles.spread_observations(spark, d)
    early = obs.filter(F.col("obs_ts") < F.lit(INCREMENTAL_CUT).cast("timestamp_ntz"))
    out = new_work_path(spark, "batch-incremental")
    args = (roles.sites(spark, d), roles.context(spark, d), out, DRIVER_SETTINGS, roles.zone_overrides(spark, d))
    run_incremental(spark, early, *args, start="2023-12-31", end="2024-12-31")
    run_incremental(spark, obs, *args, end="2024-12-31")
    return spark.read.parquet(out + "/rows")


def q_batch_rejects(spark, d):
    """DQ5: the durable table of rejected rows with their reasons."""
    rejects = spark.read.parquet(_batch(spark, d).rejects_path)
    return rejects.select("site_id", "obs_ts", "disposition", F.array_join("reasons", ",").alias("reasons"))


def q_context_csv_refetch(spark, d):
    """SRC6, INC4: of two fetches of a slot the later one wins, though it is lower."""
    path = new_work_path(spark, "context-refetch")
    ctx = roles.context(spark, d)
    warmer = ctx.withColumn("temperature_2m_c", F.col("temperature_2m_c") + 10)
    write_context_archive(_context_texts(spark, d, warmer), path, "20240201T000000000000Z")
    write_context_archive(_context_texts(spark, d, ctx), path, "20240301T000000000000Z")
    zones = _zones(spark, d)
    return context_lookup(context_from_texts(read_texts(spark, path), TZ, zones), MEASURES)


def _event_lines(spark, d) -> DataFrame:
    """Feed lines with a field the schema does not declare; errors are no JSON."""
    ev = roles.table(spark, d, "events")
    good = F.concat(
        F.lit('{"horodate":"'),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        F.lit('+00:00","number":'),
        F.col("user_id").cast("string"),
        F.lit(',"note":{"event":'),
        F.col("event_id").cast("string"),
        F.lit("}}"),
    )
    bad = F.concat(F.lit("not json "), F.col("event_id").cast("string"))
    return ev.select(F.when(F.col("event_type") == "error", bad).otherwise(good).alias("value"))


def q_raw_lines(spark, d):
    """PRJ6: the received line is kept whole, undeclared fields and bad lines included."""
    return flatten_items(items_from_lines(_event_lines(spark, d))).select("site_id", "obs_ts", "raw")


def q_stream_landing_quarantine(spark, d):
    """STR1: unreadable lines of the landing stream, as received."""
    from obsflow.streaming.jobs import await_available_now, landing_stream

    base = new_work_path(spark, "stream-quarantine")
    _event_lines(spark, d).write.text(f"{base}/source")
    await_available_now(landing_stream(spark, f"{base}/source", f"{base}/table", f"{base}/checkpoint"))
    return spark.read.parquet(f"{base}/table_quarantine").select("raw")


LATE_BEFORE = "2024-01-20 00:00:00"
LATE_AGAIN = "2024-01-30 12:00:00"


def _late_stream(spark, d):
    """Recent rows first, whose watermark makes the older ones late; then the last
    hours once more. Each drop is a new start of the stream on the same folders."""
    from obsflow.streaming.jobs import await_available_now
    from obsflow.streaming.late import LateTables, dedup_enrich_keep_late

    base = new_work_path(spark, "stream-late")
    obs = roles.observation_base(spark, d).drop("event_id")
    tables, sites = LateTables(f"{base}/tables"), roles.sites(spark, d)
    late = F.col("obs_ts") < F.lit(LATE_BEFORE).cast("timestamp_ntz")
    again = F.col("obs_ts") >= F.lit(LATE_AGAIN).cast("timestamp_ntz")
    for part in (obs.filter(~late), obs.filter(late), obs.filter(again)):
        part.write.mode("append").parquet(f"{base}/source")
        stream = spark.readStream.schema(obs.schema).parquet(f"{base}/source")
        await_available_now(dedup_enrich_keep_late(stream, sites, tables.base, "1 DAY"))
    return tables, obs


def q_stream_late_rows(spark, d):
    """STR2: rows later than the watermark, as received, with batch and watermark."""
    from obsflow.streaming.late import late_rows

    tables, obs = _late_stream(spark, d)
    return late_rows(spark, tables, obs.schema)


def q_stream_late_counts(spark, d):
    """STR2: the durable figures of each batch: read = kept + copies + late."""
    from obsflow.streaming.late import epochs

    tables, _ = _late_stream(spark, d)
    return epochs(spark, tables)


LANDED_UNTIL = "2024-01-12 00:00:00"
RELANDED_FROM = "2024-01-10 12:00:00"
REVISED_STATUS = "error"


def _two_drops(spark, d) -> tuple[DataFrame, DataFrame]:
    """Observations up to a date, and those from an earlier date on with one status
    revised: new, changed, equal and untouched rows."""
    base = roles.observation_base(spark, d).drop("event_id")
    first = base.filter(F.col("obs_ts") < F.lit(LANDED_UNTIL).cast("timestamp_ntz"))
    second = base.filter(F.col("obs_ts") >= F.lit(RELANDED_FROM).cast("timestamp_ntz"))
    revised = F.when(F.col("status") == REVISED_STATUS, F.lit("revised")).otherwise(F.col("status"))
    return first, second.withColumn("status", revised)


def q_stream_landing_counts(spark, d):
    """STR1, SNK3: inserted, updated, unchanged and kept rows of each batch."""
    from obsflow.streaming.jobs import await_available_now, landing_stream

    base = new_work_path(spark, "stream-counts")
    for drop in _two_drops(spark, d):
        items = _raw_items_from(drop.withColumn("event_id", F.lit(0)))
        items.select(F.col("raw").alias("value")).write.mode("append").text(f"{base}/source")
        await_available_now(landing_stream(spark, f"{base}/source", f"{base}/table", f"{base}/checkpoint", buckets=8))
    return spark.read.parquet(f"{base}/table_counts")


def q_keyed_merge_bucketed(spark, d):
    """SNK3, INC4: merges into a table bucketed by key; stored rows are not shuffled."""
    from obsflow.streaming.jobs import merge_into_table

    path = f"{new_work_path(spark, 'bucketed')}/table"
    for drop in _two_drops(spark, d):
        merge_into_table(spark, drop.withColumn("obs_date", F.to_date("obs_ts")), path, buckets=8)
    return spark.read.parquet(path)


def q_batch_snapshot_range(spark, d):
    """SNK1, SNK2, SNK8: a range replaced behind one pointer; a reader that came
    before the run still reads what it saw."""
    obs = roles.spread_observations(spark, d)
    out = new_work_path(spark, "batch-snapshots")
    args = (roles.sites(spark, d), roles.context(spark, d), out)
    first = dataclasses.replace(DRIVER_SETTINGS, snapshots=True)
    run_batch(spark, obs, *args, first, roles.zone_overrides(spark, d))
    before = published_table(spark, out, "rows")
    second = dataclasses.replace(first, time_range=RANGE_REPLACED)
    run_batch(spark, obs.withColumn("status", F.lit("revised")), *args, second, roles.zone_overrides(spark, d))
    after = published_table(spark, out, "rows")
    return before.withColumn("seen", F.lit("before")).unionByName(after.withColumn("seen", F.lit("after")))


def q_batch_snapshot_hours(spark, d):
    """SNK2: the roll-up behind the same pointer, after a range was replaced by nothing."""
    obs = roles.spread_observations(spark, d)
    out = new_work_path(spark, "batch-snapshots")
    args = (roles.sites(spark, d), roles.context(spark, d), out)
    first = dataclasses.replace(DRIVER_SETTINGS, snapshots=True)
    run_batch(spark, obs, *args, first, roles.zone_overrides(spark, d))
    second = dataclasses.replace(first, time_range=RANGE_REPLACED)
    run_batch(spark, obs.filter("false"), *args, second, roles.zone_overrides(spark, d))
    return published_table(spark, out, "hours")


def q_batch_replace_empty(spark, d):
    """SNK1, ENR6: with nothing accepted, the range, or the whole table, is empty."""
    obs = roles.spread_observations(spark, d)
    rejected = obs.withColumn("capacity", F.lit(0))
    in_range = dataclasses.replace(DRIVER_SETTINGS, time_range=RANGE_REPLACED)
    sides = _written_sides(spark, d)
    ranged = spark.read.parquet(_two_runs(spark, d, obs, rejected, in_range, sides) + "/rows")
    whole = spark.read.parquet(_two_runs(spark, d, obs, rejected, DRIVER_SETTINGS, sides) + "/rows")
    return ranged.withColumn("replaced", F.lit("range")).unionByName(whole.withColumn("replaced", F.lit("all")))


def q_latest_time_newest(spark, d):
    """INC1, AGG8: the latest published time, from the newest month that holds a row."""
    out = new_work_path(spark, "batch-latest")
    args = (roles.sites(spark, d), roles.context(spark, d), out, DRIVER_SETTINGS, roles.zone_overrides(spark, d))
    run_batch(spark, roles.spread_observations(spark, d), *args)
    return latest_published(spark, out, DRIVER_SETTINGS).agg(F.max("obs_ts").alias("latest_ts"))


SITE_DAY = ("2024-01-10", "2024-01-16")
SITES_READ = (20, 40)


def q_site_day_scan(spark, d):
    """SRC3, FLT7: sites and days from rows that lie in order of both in a month."""
    path = new_work_path(spark, "clustered")
    obs = roles.spread_observations(spark, d).withColumns({"year": F.year("obs_ts"), "month": F.month("obs_ts")})
    write_partitioned(obs, path, ["year", "month"], cluster_by=["site_id", "obs_ts"])
    stored = spark.read.schema(obs.schema).parquet(path)
    return in_date_range(stored, *SITE_DAY, TZ).filter(F.col("site_id").between(*SITES_READ)).drop("batch")


def q_context_csv_lines(spark, d):
    """SRC5, SRC6, SNK6: CSV files read line by line in splits."""
    path = new_work_path(spark, "context-lines")
    write_context_archive(_context_texts(spark, d), path, "20240201T000000000000Z")
    ctx = context_from_lines(read_lines(spark, path), TZ, _zones(spark, d))
    return ctx.select("zone", "ctx_ts", *MEASURES, "row_ok")


UNREADABLE_CODE = 50


def q_context_csv_rejects(spark, d):
    """SRC5, DQ5: unreadable context rows are kept with their cells: read = used + quarantined."""
    base = new_work_path(spark, "context-rejects")
    text = F.when(F.col("weather_code") < UNREADABLE_CODE, F.lit("n/a")).otherwise(F.col("temperature_2m_c").cast("string"))
    ctx = roles.context(spark, d).withColumn("temperature_2m_c", text)
    write_context_archive(_context_texts(spark, d, ctx), f"{base}/archive", "20240201T000000000000Z")
    rows = context_from_lines(read_lines(spark, f"{base}/archive"), TZ, _zones(spark, d))
    used, n = accept_context(spark, rows, f"{base}/rejects")
    if n["n_context_read"] != rows.count():
        raise RuntimeError(f"the figures {n} are not those of the archive")
    both = used.unionByName(spark.read.parquet(f"{base}/rejects"))
    return both.select("zone", "ctx_ts", "row_ok", F.array_join("bad_cells", ",").alias("bad_cells"), "temperature_2m_c", "weather_code")


def q_raw_variant(spark, d):
    """PRJ6: the whole item stored as VARIANT; undeclared nested fields are read from it."""
    path = new_work_path(spark, "raw-variant")
    items = flatten_items(items_from_lines(_event_lines(spark, d)), raw_as_variant=True)
    items.select("site_id", "obs_ts", "raw").write.parquet(path)
    stored = spark.read.schema("site_id bigint, obs_ts timestamp_ntz, raw variant").parquet(path)
    return stored.select(
        "site_id",
        "obs_ts",
        F.try_variant_get("raw", "$.note.event", "bigint").alias("note_event"),
        F.try_variant_get("raw", "$.horodate", "string").alias("horodate"),
    )


def q_preview_sites(spark, d):
    """SNK7, SRT2: the first twenty sites by key."""
    return preview(roles.sites(spark, d), 20, ["site_id"])


def q_text_dates(spark, d):
    """FN15, FN19: the date part of a time text; the ingestion stamp."""
    ev = roles.table(spark, d, "events")
    return ev.select(
        "event_id", date_of_text(obs_text()).alias("text_date"), ingest_stamp("ts").alias("stamp")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "dedup_latest": q_dedup_latest,
    "dedup_plain_count": q_dedup_plain_count,
    "enrich_site_left": q_enrich_site_left,
    "orphan_split": q_orphan_split,
    "join_quality": q_join_quality,
    "zone_override": q_zone_override,
    "slot_15min": q_slot_15min,
    "enrich_context": q_enrich_context,
    "context_match_report": q_context_match_report,
    "zones_without_context": q_zones_without_context,
    "zone_coverage": q_zone_coverage,
    "null_zone_sites": q_null_zone_sites,
    "null_zone_counts": q_null_zone_counts,
    "capacity_anomalies": q_capacity_anomalies,
    "capacity_valid": q_capacity_valid,
    "fill_rate": q_fill_rate,
    "rate_out_of_range": q_rate_out_of_range,
    "local_calendar": q_local_calendar,
    "quality_gate": q_quality_gate,
    "quality_gate_matched": q_quality_gate_matched,
    "reconciliation": q_reconciliation,
    "site_hour_rollup": q_site_hour_rollup,
    "site_hour_top20": q_site_hour_top20,
    "zone_hour_rollup": q_zone_hour_rollup,
    "latest_observation": q_latest_observation,
    "latest_time": q_latest_time,
    "resume_point": q_resume_point,
    "date_range_scan": q_date_range_scan,
    "weekly_windows": q_weekly_windows,
    "backfill_plan": q_backfill_plan,
    "keyed_merge": q_keyed_merge,
    "merge_counts": q_merge_counts,
    "time_text_parse": q_time_text_parse,
    "key_quarantine": q_key_quarantine,
    "pages_explode": q_pages_explode,
    "pages_roundtrip": q_pages_roundtrip,
    "raw_payload": q_raw_payload,
    "nested_flatten": q_nested_flatten,
    "geo_point": q_geo_point,
    "typed_cells": q_typed_cells,
    "context_csv_roundtrip": q_context_csv_roundtrip,
    "local_to_instant": q_local_to_instant,
    "partitioned_roundtrip": q_partitioned_roundtrip,
    "batch_rows": q_batch_rows,
    "batch_hours": q_batch_hours,
    "batch_quality": q_batch_quality,
    "stream_landing_merge": q_stream_landing_merge,
    "stream_dedup_enrich": q_stream_dedup_enrich,
    "store_load": q_store_load,
    "landed_concat": q_landed_concat,
    "append_roundtrip": q_append_roundtrip,
    "batch_full_replace": q_batch_full_replace,
    "batch_full_replace_hours": q_batch_full_replace_hours,
    "batch_range_replace": q_batch_range_replace,
    "batch_merge_correction": q_batch_merge_correction,
    "batch_incremental": q_batch_incremental,
    "batch_rejects": q_batch_rejects,
    "context_csv_refetch": q_context_csv_refetch,
    "raw_lines": q_raw_lines,
    "stream_landing_quarantine": q_stream_landing_quarantine,
    "stream_late_rows": q_stream_late_rows,
    "stream_late_counts": q_stream_late_counts,
    "stream_landing_counts": q_stream_landing_counts,
    "keyed_merge_bucketed": q_keyed_merge_bucketed,
    "batch_snapshot_range": q_batch_snapshot_range,
    "batch_snapshot_hours": q_batch_snapshot_hours,
    "batch_replace_empty": q_batch_replace_empty,
    "latest_time_newest": q_latest_time_newest,
    "site_day_scan": q_site_day_scan,
    "context_csv_lines": q_context_csv_lines,
    "context_csv_rejects": q_context_csv_rejects,
    "raw_variant": q_raw_variant,
    "preview_sites": q_preview_sites,
    "text_dates": q_text_dates,
}

