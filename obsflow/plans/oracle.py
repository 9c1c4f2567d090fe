"""DuckDB SQL twins of the registered queries (the correctness oracle).

Written independently of the Spark plans, over the driver's views. Where the
two engines differ, the SQL states Spark's semantics explicitly:

- averages are rounded half-up exactly in integer arithmetic (DuckDB rounds
  the binary double, Spark the decimal; the library averages exactly);
- 15-minute slots use ``time_bucket``; local time uses ``timezone``;
- integer result types are cast to Spark's INT where DuckDB gives BIGINT.
"""

from __future__ import annotations

from obsflow.plans import roles
from obsflow.plans.roles import SQL_CONSISTENCY_BROKEN as BROKEN
from obsflow.plans.roles import sql_spread as S
from obsflow.plans.roles import sql_with as W

TZ = roles.TIME_ZONE
MEASURES = ", ".join(roles.CONTEXT_ROLE_MEASURES)


def half_up_avg(x: str, decimals_in: int) -> str:
    """Mean of non-negative ``x`` (with ``decimals_in`` decimals) rounded half-up to 2."""
    units = f"CAST(round(({x}) * {10 ** decimals_in}) AS HUGEINT)" if decimals_in else f"CAST({x} AS HUGEINT)"
    k = 100 // 10**decimals_in
    s, n = f"sum({units})", f"count({x})"
    return f"CASE WHEN {n} = 0 THEN NULL ELSE CAST(((2 * {k} * {s} + {n}) // (2 * {n})) AS DOUBLE) / 100 END"


def _rollup(keys: str, source: str) -> str:
    return f"""
SELECT {keys}, count(*) AS n_obs,
       {half_up_avg('available', 0)} AS avg_available,
       {half_up_avg('free', 0)} AS avg_free,
       {half_up_avg('fill_rate', 2)} AS avg_fill_rate,
       {half_up_avg('temperature_2m_c', 2)} AS avg_temperature
FROM {source} GROUP BY {keys}"""


SITE_HOUR = "site_id, site_name, zone, year, month, day, hour"
ZONE_HOUR = "zone, year, month, day, hour"
FINAL = f"(SELECT * EXCLUDE (is_orphan) FROM final_all WHERE NOT {BROKEN})"


def _gate(source: str) -> str:
    return f"""
SELECT *, (time_null = 0 AND site_name_null = 0 AND capacity_non_positive = 0
           AND available_negative = 0 AND fill_rate_out_of_range = 0) AS passed
FROM (SELECT count(*) AS n_rows,
             count(*) FILTER (WHERE obs_ts IS NULL) AS time_null,
             count(*) FILTER (WHERE site_name IS NULL) AS site_name_null,
             count(*) FILTER (WHERE zone IS NULL) AS zone_null,
             count(*) FILTER (WHERE capacity <= 0) AS capacity_non_positive,
             count(*) FILTER (WHERE available < 0) AS available_negative,
             count(*) FILTER (WHERE temperature_2m_c IS NULL) AS context_null,
             count(*) FILTER (WHERE fill_rate < 0 OR fill_rate > 100) AS fill_rate_out_of_range
      FROM {source})"""


_TEXT = """
CASE event_type
  WHEN 'view' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || '+00:00'
  WHEN 'click' THEN strftime(ts + INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S') || '+02:00'
  WHEN 'error' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || 'Z'
  WHEN 'purchase' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00'
  ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END"""

_PARSE = r"""
CASE WHEN regexp_full_match(obs_text, '\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(Z|[+-]\d{2}:\d{2})')
     THEN timezone('UTC', strptime(regexp_replace(obs_text, 'Z$', '+00:00'), '%Y-%m-%d %H:%M:%S%z')) END"""

PARSED = f"""
(SELECT event_id, site_id, obs_text, {_PARSE} AS obs_ts
 FROM (SELECT event_id, user_id AS site_id, {_TEXT} AS obs_text FROM events))"""

WINDOWS = """
(SELECT CAST(ws AS DATE) AS window_start, least(CAST(ws AS DATE) + 6, end_date) AS window_end
 FROM (SELECT unnest(generate_series(CAST(start_date AS TIMESTAMP), CAST(end_date - 1 AS TIMESTAMP),
                                     INTERVAL 7 DAY)) AS ws, end_date
       FROM (SELECT CAST(min(obs_ts) AS DATE) AS start_date, CAST(max(obs_ts) AS DATE) AS end_date FROM dedup)))"""

SITES_WITH_SLOTS = "SELECT site_id, site_name, zone, lat, lon, CAST(lon AS INTEGER) AS slots FROM sites"

_MERGE = """
SELECT coalesce(s.o_orderkey, r.o_orderkey) AS o_orderkey, s.o_custkey,
       CASE WHEN r.o_orderkey IS NOT NULL THEN r.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus,
       CASE WHEN r.o_orderkey IS NOT NULL THEN r.o_totalprice ELSE s.o_totalprice END AS o_totalprice,
       CASE WHEN r.o_orderkey IS NOT NULL THEN r.o_orderdate ELSE s.o_orderdate END AS o_orderdate,
       s.o_orderpriority,
       CASE WHEN s.o_orderkey IS NOT NULL AND r.o_orderkey IS NOT NULL THEN
              CASE WHEN s.o_orderdate IS NOT DISTINCT FROM r.o_orderdate
                    AND s.o_orderstatus IS NOT DISTINCT FROM r.o_orderstatus
                    AND s.o_totalprice IS NOT DISTINCT FROM r.o_totalprice
                   THEN 'unchanged' ELSE 'updated' END
            WHEN r.o_orderkey IS NOT NULL THEN 'inserted' ELSE 'kept' END AS change
FROM stored s FULL JOIN reloaded r ON s.o_orderkey = r.o_orderkey"""

_REASONS = """concat_ws(',',
  CASE WHEN capacity IS NULL THEN 'capacity_null' END,
  CASE WHEN available IS NULL THEN 'available_null' END,
  CASE WHEN capacity <= 0 THEN 'capacity_non_positive' END,
  CASE WHEN available < 0 THEN 'available_negative' END,
  CASE WHEN available > capacity THEN 'available_above_capacity' END)"""

_RAW = """to_json({'horodate': strftime(obs_ts, '%Y-%m-%d %H:%M:%S') || '+00:00',
       'number': site_id, 'status': status,
       'main_stands': {'capacity': capacity, 'availabilities': {'bikes': available, 'stands': free}}})"""

_LINE = """CASE WHEN event_type = 'error' THEN 'not json ' || event_id
       ELSE '{"horodate":"' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '+00:00","number":' || user_id
            || ',"note":{"event":' || event_id || '}}' END"""

# The instant of the registered full replacement.
FULL_REPLACE_BEFORE = "2024-05-20 00:00:00"

_BATCH_ROWS = (
    "site_id, site_name, zone, lat, lon, obs_ts, slot_ts, status, capacity, available, free, "
    f"{MEASURES}, fill_rate, obs_local, year, month, day, hour"
)

# The watermark of the late rows: a day before the latest of the first drop.
_WATERMARK = "(SELECT max(obs_ts) - INTERVAL 1 DAY FROM obs_base)"
_REPLACED = "CAST(obs_local AS DATE) BETWEEN DATE '2024-03-15' AND DATE '2024-04-20'"

ORACLE_SQL: dict[str, str] = {
    "dedup_latest": W("dedup") + "SELECT * FROM dedup",
    "dedup_plain_count": W("obs") + "SELECT count(*) AS n_rows FROM (SELECT DISTINCT site_id, obs_ts FROM obs)",
    "enrich_site_left": W("enriched") + "SELECT * FROM enriched",
    "orphan_split": W("enriched") + "SELECT * EXCLUDE (is_orphan) FROM enriched WHERE is_orphan",
    "join_quality": W("enriched")
    + "SELECT count(*) AS n_rows, count(*) FILTER (WHERE NOT is_orphan) AS n_matched, "
    "count(*) FILTER (WHERE is_orphan) AS n_orphans FROM enriched",
    "zone_override": W("lookup")
    + "SELECT site_id, site_name, zone, coalesce(in_dim, false) AS in_dimension FROM lookup",
    "slot_15min": W("dedup")
    + "SELECT site_id, obs_ts, time_bucket(INTERVAL 15 MINUTE, obs_ts) AS slot_ts FROM dedup",
    "enrich_context": W("joined") + "SELECT * EXCLUDE (is_orphan) FROM joined",
    "context_match_report": W("joined")
    + "SELECT count(*) AS n_rows, count(*) FILTER (WHERE NOT has_context) AS n_unmatched, "
    "count(*) FILTER (WHERE temperature_2m_c IS NULL) AS n_measure_null FROM joined",
    "zones_without_context": W("enriched", "ctx")
    + "SELECT zone FROM (SELECT DISTINCT zone FROM enriched WHERE NOT is_orphan) f "
    "WHERE NOT EXISTS (SELECT 1 FROM ctx c WHERE c.zone = f.zone)",
    "zone_coverage": W("enriched", "ctx")
    + "SELECT count(*) AS n_zones, count(*) FILTER (WHERE c.zone IS NULL) AS n_zones_without_context "
    "FROM (SELECT DISTINCT zone FROM enriched WHERE NOT is_orphan) f "
    "LEFT JOIN (SELECT DISTINCT zone FROM ctx) c ON f.zone = c.zone",
    "null_zone_sites": W("enriched")
    + "SELECT DISTINCT site_id, site_name, lat, lon FROM enriched WHERE NOT is_orphan AND zone IS NULL",
    "null_zone_counts": W("enriched")
    + "SELECT count(*) AS n_rows, CAST(coalesce(count(DISTINCT site_id) + "
    "max(CASE WHEN site_id IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_sites "
    "FROM enriched WHERE NOT is_orphan AND zone IS NULL",
    "capacity_anomalies": W("joined")
    + f"SELECT site_id, obs_ts, capacity, available, free, {_REASONS} AS reasons FROM joined WHERE {BROKEN}",
    "capacity_valid": W("joined")
    + f"SELECT site_id, obs_ts, status, capacity, available, free FROM joined WHERE NOT {BROKEN}",
    "fill_rate": W("final_all") + f"SELECT site_id, obs_ts, capacity, available, fill_rate FROM {FINAL}",
    "rate_out_of_range": W("final_all")
    + "SELECT site_id, site_name, obs_ts, capacity, available, free, fill_rate FROM final_all "
    "WHERE coalesce(fill_rate < 0 OR fill_rate > 100, false)",
    "local_calendar": W("final_all") + f"SELECT site_id, obs_ts, obs_local, year, month, day, hour FROM {FINAL}",
    "quality_gate": W("final_all") + _gate(FINAL),
    "quality_gate_matched": W("final_all") + _gate("final_all"),
    "reconciliation": W("enriched")
    + f"""SELECT *, n_read = n_matched + n_orphans AS read_equals_matched_plus_orphans,
       n_final = n_matched - n_anomalies AS final_equals_matched_minus_anomalies
FROM (SELECT count(*) AS n_read, count(*) FILTER (WHERE NOT is_orphan) AS n_matched,
             count(*) FILTER (WHERE is_orphan) AS n_orphans,
             count(*) FILTER (WHERE NOT is_orphan AND {BROKEN}) AS n_anomalies,
             count(*) FILTER (WHERE NOT is_orphan AND NOT {BROKEN}) AS n_final
      FROM enriched)""",
    "site_hour_rollup": W("final_all") + _rollup(SITE_HOUR, FINAL),
    "site_hour_top20": W("final_all")
    + _rollup(SITE_HOUR, FINAL)
    + " ORDER BY site_id, year, month, day, hour LIMIT 20",
    "zone_hour_rollup": W("final_all") + _rollup(ZONE_HOUR, FINAL),
    "latest_observation": W("dedup")
    + "SELECT * FROM dedup ORDER BY obs_ts DESC NULLS LAST, site_id DESC NULLS LAST LIMIT 1",
    "latest_time": W("dedup") + "SELECT max(obs_ts) AS latest_ts FROM dedup",
    "resume_point": W("dedup")
    + f"SELECT CAST(timezone('{TZ}', timezone('UTC', max(obs_ts))) AS DATE) AS start_date, "
    "DATE '2024-02-15' AS end_date, 'stored' AS start_source FROM dedup",
    "date_range_scan": W("obs_base")
    + "SELECT site_id, obs_ts, status FROM obs_base "
    "WHERE obs_ts >= TIMESTAMP '2024-01-05' AND obs_ts < TIMESTAMP '2024-01-09'",
    "weekly_windows": W("dedup") + f"SELECT * FROM {WINDOWS}",
    "backfill_plan": W("dedup", "sites")
    + f"SELECT z.zone, w.window_start, w.window_end FROM (SELECT DISTINCT zone FROM sites WHERE zone IS NOT NULL) z "
    f"CROSS JOIN {WINDOWS} w",
    "keyed_merge": W("stored", "reloaded") + _MERGE,
    "merge_counts": W("stored", "reloaded")
    + f"""SELECT count(*) FILTER (WHERE change = 'inserted') AS n_inserted,
       count(*) FILTER (WHERE change = 'updated') AS n_updated,
       count(*) FILTER (WHERE change = 'unchanged') AS n_unchanged,
       count(*) FILTER (WHERE change = 'kept') AS n_kept, count(*) AS n_rows
FROM ({_MERGE})""",
    "time_text_parse": f"SELECT * FROM {PARSED}",
    "key_quarantine": f"SELECT event_id, site_id, obs_text FROM {PARSED} WHERE site_id IS NULL OR obs_ts IS NULL",
    "pages_explode": W("sites") + SITES_WITH_SLOTS,
    "pages_roundtrip": W("sites") + SITES_WITH_SLOTS,
    "raw_payload": W("obs_base") + f"SELECT event_id, {_RAW} AS raw FROM obs_base",
    "nested_flatten": W("obs_base")
    + """SELECT site_id, strftime(obs_ts, '%Y-%m-%d %H:%M:%S') || '+00:00' AS obs_text,
       date_trunc('second', obs_ts) AS obs_ts, status, capacity, available, free FROM obs_base""",
    "geo_point": W("sites")
    + "SELECT site_id, to_json({'type': 'Point', 'coordinates': [lon, lat]}) AS location FROM sites",
    "typed_cells": W("ctx") + f"SELECT zone, ctx_ts, {MEASURES} FROM ctx",
    "context_csv_roundtrip": W("ctx") + f"SELECT zone, ctx_ts, {MEASURES}, true AS row_ok FROM ctx",
    "local_to_instant": f"SELECT event_id, ts AS local_ts, timezone('UTC', timezone('{TZ}', ts)) AS utc_ts FROM events",
    "partitioned_roundtrip": W("final_all") + f"SELECT * FROM {FINAL} WHERE month = 1",
    "batch_rows": W("final_all") + f"SELECT {_BATCH_ROWS} FROM {FINAL}",
    "batch_hours": W("final_all") + _rollup(SITE_HOUR, FINAL),
    "batch_quality": W("final_all") + f"SELECT *, '' AS failed_rules FROM ({_gate(FINAL)})",
    "stream_landing_merge": W("obs_base")
    + f"""SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY site_id, obs_ts
           ORDER BY obs_text DESC, status DESC, capacity DESC, available DESC, free DESC) AS rn
  FROM (SELECT site_id, strftime(obs_ts, '%Y-%m-%d %H:%M:%S') || '+00:00' AS obs_text,
               date_trunc('second', obs_ts) AS obs_ts, status, capacity, available, free,
               CAST(obs_ts AS DATE) AS obs_date, {_RAW} AS raw FROM obs_base)) WHERE rn = 1""",
    "stream_dedup_enrich": W("enriched") + "SELECT * EXCLUDE (event_id, batch) FROM enriched",
    "store_load": "SELECT event_id, user_id, ts, event_type FROM events",
    "landed_concat": W("obs")
    + "SELECT * REPLACE (CAST(NULL AS INTEGER) AS free) FROM obs WHERE batch = 1 "
    "UNION ALL SELECT * FROM obs WHERE batch = 2",
    "append_roundtrip": W("obs_base")
    + "SELECT *, 1 AS drop_no FROM obs_base UNION ALL SELECT *, 2 AS drop_no FROM obs_base",
    "batch_full_replace": S("final_all")
    + f"SELECT {_BATCH_ROWS} FROM {FINAL} WHERE obs_ts < TIMESTAMP '{FULL_REPLACE_BEFORE}'",
    "batch_full_replace_hours": S("final_all")
    + _rollup(SITE_HOUR, f"(SELECT * FROM {FINAL} WHERE obs_ts < TIMESTAMP '{FULL_REPLACE_BEFORE}')"),
    "batch_range_replace": S("final_all")
    + f"SELECT {_BATCH_ROWS} FROM (SELECT * REPLACE (CASE WHEN CAST(obs_local AS DATE) BETWEEN DATE '2024-03-15' "
    f"AND DATE '2024-04-20' THEN 'revised' ELSE status END AS status) FROM {FINAL})",
    "batch_merge_correction": S("final_all")
    + f"SELECT {_BATCH_ROWS} FROM {FINAL} WHERE (site_id, obs_ts) NOT IN "
    "(SELECT (site_id, obs_ts) FROM obs_base WHERE status = 'view')",
    "batch_incremental": S("final_all") + f"SELECT {_BATCH_ROWS} FROM {FINAL}",
    "batch_rejects": W("enriched")
    + f"""SELECT site_id, obs_ts, CASE WHEN is_orphan THEN 'orphan' ELSE 'anomaly' END AS disposition,
       concat_ws(',', CASE WHEN is_orphan THEN 'orphan' END, CASE WHEN capacity IS NULL THEN 'capacity_null' END,
                 CASE WHEN available IS NULL THEN 'available_null' END,
                 CASE WHEN capacity <= 0 THEN 'capacity_non_positive' END,
                 CASE WHEN available < 0 THEN 'available_negative' END,
                 CASE WHEN available > capacity THEN 'available_above_capacity' END) AS reasons
FROM enriched WHERE is_orphan OR {BROKEN}""",
    "context_csv_refetch": W("ctx") + f"SELECT zone, ctx_ts, {MEASURES}, true AS has_context FROM ctx",
    "raw_lines": f"""SELECT CASE WHEN event_type <> 'error' THEN user_id END AS site_id,
       CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END AS obs_ts, {_LINE} AS raw FROM events""",
    "stream_landing_quarantine": f"SELECT {_LINE} AS raw FROM events WHERE event_type = 'error'",
    "stream_late_rows": W("obs_base")
    + f"""SELECT * EXCLUDE (event_id), {_WATERMARK} AS late_watermark, 1 AS epoch_id FROM obs_base
WHERE obs_ts < TIMESTAMP '2024-01-20' AND obs_ts <= {_WATERMARK}""",
    "stream_late_counts": W("obs_base")
    + f"""SELECT epoch_id, max_ts, CASE WHEN n_kept > 0 THEN max_ts END AS max_kept_ts, n_read, n_kept, n_read - n_kept - n_late AS n_copies, n_late
FROM (SELECT 0 AS epoch_id, max(obs_ts) AS max_ts, count(*) AS n_read, count(DISTINCT (site_id, obs_ts)) AS n_kept, 0::BIGINT AS n_late
      FROM obs_base WHERE obs_ts >= TIMESTAMP '2024-01-20'
      UNION ALL
      SELECT 1, max(obs_ts), count(*), count(DISTINCT (site_id, obs_ts)) FILTER (WHERE obs_ts > {_WATERMARK}),
             count(*) FILTER (WHERE obs_ts <= {_WATERMARK}) FROM obs_base WHERE obs_ts < TIMESTAMP '2024-01-20'
      UNION ALL
      SELECT 2, max(obs_ts), count(*), 0, count(*) FILTER (WHERE obs_ts <= {_WATERMARK})
      FROM obs_base WHERE obs_ts >= TIMESTAMP '2024-01-30 12:00:00')""",
    "stream_landing_counts": W("obs_base")
    + """, k AS (SELECT DISTINCT site_id, date_trunc('second', obs_ts) AS ts, status = 'error' AS revised,
              obs_ts < TIMESTAMP '2024-01-12' AS in_first, obs_ts >= TIMESTAMP '2024-01-10 12:00:00' AS in_second FROM obs_base)
SELECT count(*) FILTER (WHERE in_first) AS n_inserted, 0::BIGINT AS n_updated, 0::BIGINT AS n_unchanged, 0::BIGINT AS n_kept,
       count(*) FILTER (WHERE in_first) AS n_rows, 0 AS epoch_id FROM k
UNION ALL
SELECT count(*) FILTER (WHERE NOT in_first), count(*) FILTER (WHERE in_first AND in_second AND revised),
       count(*) FILTER (WHERE in_first AND in_second AND NOT revised), count(*) FILTER (WHERE NOT in_second), count(*), 1
FROM k WHERE CAST(ts AS DATE) IN (SELECT CAST(ts AS DATE) FROM k WHERE in_second)""",
    "keyed_merge_bucketed": W("obs_base")
    + """SELECT * EXCLUDE (event_id) REPLACE (CASE WHEN status = 'error' AND obs_ts >= TIMESTAMP '2024-01-10 12:00:00'
       THEN 'revised' ELSE status END AS status), CAST(obs_ts AS DATE) AS obs_date FROM obs_base""",
    "batch_snapshot_range": S("final_all")
    + f"""SELECT {_BATCH_ROWS}, 'before' AS seen FROM {FINAL} UNION ALL
SELECT {_BATCH_ROWS}, 'after' AS seen FROM (SELECT * REPLACE (CASE WHEN {_REPLACED} THEN 'revised' ELSE status END AS status) FROM {FINAL})""",
    "batch_snapshot_hours": S("final_all") + _rollup(SITE_HOUR, f"(SELECT * FROM {FINAL} WHERE NOT {_REPLACED})"),
    "batch_replace_empty": S("final_all") + f"SELECT {_BATCH_ROWS}, 'range' AS replaced FROM {FINAL} WHERE NOT {_REPLACED}",
    "latest_time_newest": S("final_all") + f"SELECT max(obs_ts) AS latest_ts FROM {FINAL}",
    "site_day_scan": S("obs_base")
    + f"""SELECT *, CAST(year(obs_ts) AS INTEGER) AS year, CAST(month(obs_ts) AS INTEGER) AS month FROM obs_base
WHERE site_id BETWEEN 20 AND 40
  AND CAST(timezone('{TZ}', timezone('UTC', obs_ts)) AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-16'""",
    "context_csv_lines": W("ctx") + f"SELECT zone, ctx_ts, {MEASURES}, true AS row_ok FROM ctx",
    "context_csv_rejects": W("ctx")
    + """SELECT zone, ctx_ts, weather_code >= 50 AS row_ok, CASE WHEN weather_code < 50 THEN 'temperature_2m_c' ELSE '' END AS bad_cells,
       CASE WHEN weather_code >= 50 THEN temperature_2m_c END AS temperature_2m_c, weather_code FROM ctx""",
    "raw_variant": """SELECT CASE WHEN event_type <> 'error' THEN user_id END AS site_id,
       CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END AS obs_ts,
       CASE WHEN event_type <> 'error' THEN event_id END AS note_event,
       CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || '+00:00' END AS horodate FROM events""",
    "preview_sites": W("sites") + "SELECT * FROM sites ORDER BY site_id LIMIT 20",
    "text_dates": f"""SELECT event_id, CASE WHEN event_type <> 'purchase' THEN CAST(substr({_TEXT}, 1, 10) AS DATE) END AS text_date,
       strftime(ts, '%Y%m%dT%H%M%S%f') || 'Z' AS stamp FROM events""",
}
