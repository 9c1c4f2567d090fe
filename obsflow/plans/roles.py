"""Role mapping from the driver's tables to the library's inputs.

The driver provides TPC-H-like tables plus ``events``. They play these roles
(each Spark builder has its SQL twin below, used by the oracle):

- observations: ``events`` (site = user_id, time = ts, status = event_type,
  capacity = props.k, available = floor(value), free = capacity - available
  floored at 0), plus a re-fetched copy (landing batch 2) of every event in
  an overlapping reload window: the duplicates a real backfill produces;
- site dimension: ``customer`` outside the BUILDING segment (so the rest
  become orphans), zone = nation name, left NULL for accounts in debit;
- zone overrides: ``supplier`` keys with their nation (a second zone source);
- context series: per (nation, 15-minute slot), figures over ``view``
  events, for nations outside AFRICA only (so some zones lack context);
- merge: ``orders`` stored up to 1999, and a reload of 1999-07 onwards that
  supplies four columns, with a surcharge on urgent orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.functions.time import slot_start

# Fixed values of the mapping.
REFETCH_FROM = "2024-01-10 00:00:00"
REFETCH_UNTIL = "2024-01-12 00:00:00"
EXCLUDED_SEGMENT = "BUILDING"
CONTEXT_EVENT_TYPE = "view"
CONTEXT_EXCLUDED_REGION = "AFRICA"
MERGE_STORED_UNTIL = "2000-01-01"
MERGE_RELOAD_FROM = "1999-07-01"
MERGE_REVISED_PRIORITY = "1-URGENT"
MERGE_SURCHARGE = 10.0
TIME_ZONE = "Europe/Paris"

CONTEXT_ROLE_MEASURES = (
    "temperature_2m_c",
    "apparent_temperature_c",
    "relative_humidity_2m_pct",
    "precipitation_mm",
    "weather_code",
)


# Declared schemas of the driver tables the roles read (times carry no zone
# in the files, so they are TIMESTAMP_NTZ). Reading with a schema skips the
# footer-inference job per table.
DRIVER_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in DRIVER_SCHEMAS:
        reader = reader.schema(DRIVER_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ts(text: str):
    return F.lit(text).cast("timestamp_ntz")


def observation_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    capacity = F.get_json_object("props", "$.k").try_cast("int")
    available = F.floor("value").cast("int")
    return ev.select(
        F.col("user_id").alias("site_id"),
        F.col("ts").alias("obs_ts"),
        F.col("event_type").alias("status"),
        capacity.alias("capacity"),
        available.alias("available"),
        F.greatest(capacity - available, F.lit(0)).alias("free"),
        "event_id",
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed observations with re-fetched copies (batch 2) of one window."""
    base = observation_base(spark, sf_dir)
    first = base.withColumn("batch", F.lit(1))
    window = (F.col("obs_ts") >= _ts(REFETCH_FROM)) & (F.col("obs_ts") < _ts(REFETCH_UNTIL))
    again = base.filter(window).withColumn("batch", F.lit(2))
    return first.unionByName(again)


# Months over which the spread observations reach (across both clock changes).
SPREAD = "INTERVAL 30 DAY"


def spread_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All observations, moved by 0 to 6 times 30 days depending on the site,
    so that they cover seven months and a clock change."""
    base = observation_base(spark, sf_dir)
    days = (F.col("site_id") % 7 * 30).cast("int")
    return base.withColumn("obs_ts", F.col("obs_ts") + F.make_dt_interval(days)).withColumn("batch", F.lit(1))


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    j = c.filter(F.col("c_mktsegment") != EXCLUDED_SEGMENT).join(
        n, c.c_nationkey == n.n_nationkey, "inner"
    )
    return j.select(
        F.col("c_custkey").alias("site_id"),
        F.col("c_name").alias("site_name"),
        F.when(F.col("c_acctbal") >= 0, F.col("n_name")).alias("zone"),
        F.col("c_acctbal").alias("lat"),
        F.col("c_nationkey").cast("double").alias("lon"),
    )


def zone_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    return s.join(n, s.s_nationkey == n.n_nationkey).select(
        F.col("s_suppkey").alias("site_id"), F.col("n_name").alias("zone")
    )


def context(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").filter(F.col("event_type") == CONTEXT_EVENT_TYPE)
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region").filter(F.col("r_name") != CONTEXT_EXCLUDED_REGION)
    zones = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", F.col("n_name").alias("zone"))
    cents = F.round(F.col("value") * 100).cast("bigint")
    # Reduced per user and slot before the join, so that a user with very many
    # events brings a few rows to it; every figure combines again afterwards.
    slots = ev.groupBy("user_id", slot_start("ts", 15).alias("ctx_ts")).agg(
        F.max("value").alias("hi"),
        F.min("value").alias("lo"),
        F.count(F.lit(1)).alias("n"),
        F.sum(cents).alias("cents"),
        F.min(F.get_json_object("props", "$.k").try_cast("int")).alias("k"),
    )
    j = slots.join(c, slots.user_id == c.c_custkey).join(zones, F.col("c_nationkey") == F.col("n_nationkey"))
    return j.groupBy("zone", "ctx_ts").agg(
        F.max("hi").alias("temperature_2m_c"),
        F.min("lo").alias("apparent_temperature_c"),
        F.sum("n").cast("int").alias("relative_humidity_2m_pct"),
        (F.sum("cents") / F.lit(100.0)).alias("precipitation_mm"),
        F.min("k").alias("weather_code"),
    )


def stored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.filter(F.col("o_orderdate") < _ts(MERGE_STORED_UNTIL))


def reloaded_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").filter(F.col("o_orderdate") >= _ts(MERGE_RELOAD_FROM))
    price = F.when(
        F.col("o_orderpriority") == MERGE_REVISED_PRIORITY, F.col("o_totalprice") + F.lit(MERGE_SURCHARGE)
    ).otherwise(F.col("o_totalprice"))
    return o.select("o_orderkey", "o_orderdate", "o_orderstatus", price.alias("o_totalprice"))


# ---------------------------------------------------------------------------
# SQL twins (DuckDB), as CTE bodies. Spark's semantics are spelled out where
# DuckDB differs: 15-minute slots via time_bucket, JSON via
# json_extract_string, integer types cast explicitly.
# ---------------------------------------------------------------------------

SQL_OBS_BASE = f"""
SELECT user_id AS site_id, ts AS obs_ts, event_type AS status,
       TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS capacity,
       CAST(floor(value) AS INTEGER) AS available,
       greatest(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) - CAST(floor(value) AS INTEGER), 0) AS free,
       event_id
FROM events"""

SQL_OBS = f"""
SELECT *, 1 AS batch FROM obs_base
UNION ALL
SELECT *, 2 AS batch FROM obs_base
WHERE obs_ts >= TIMESTAMP '{REFETCH_FROM}' AND obs_ts < TIMESTAMP '{REFETCH_UNTIL}'"""

# Latest landing batch wins, then greatest remaining columns.
SQL_DEDUP = """
SELECT site_id, obs_ts, status, capacity, available, free, event_id, batch FROM (
  SELECT *, row_number() OVER (PARTITION BY site_id, obs_ts
       ORDER BY batch DESC, status DESC, capacity DESC, available DESC, free DESC, event_id DESC) AS rn
  FROM obs) WHERE rn = 1"""

SQL_SITES = f"""
SELECT c.c_custkey AS site_id, c.c_name AS site_name,
       CASE WHEN c.c_acctbal >= 0 THEN n.n_name END AS zone,
       c.c_acctbal AS lat, CAST(c.c_nationkey AS DOUBLE) AS lon
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE c.c_mktsegment <> '{EXCLUDED_SEGMENT}'"""

SQL_OVERRIDES = """
SELECT s.s_suppkey AS site_id, n.n_name AS zone
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey"""

SQL_LOOKUP = """
SELECT coalesce(s.site_id, o.site_id) AS site_id, s.site_name, coalesce(s.zone, o.zone) AS zone,
       s.lat, s.lon, s.site_id IS NOT NULL AS in_dim
FROM sites s FULL JOIN overrides o ON s.site_id = o.site_id"""

SQL_CONTEXT = f"""
SELECT n.n_name AS zone, time_bucket(INTERVAL 15 MINUTE, e.ts) AS ctx_ts,
       max(e.value) AS temperature_2m_c, min(e.value) AS apparent_temperature_c,
       CAST(count(*) AS INTEGER) AS relative_humidity_2m_pct,
       sum(CAST(round(e.value * 100) AS BIGINT)) / 100.0::DOUBLE AS precipitation_mm,
       min(TRY_CAST(json_extract_string(e.props, '$.k') AS INTEGER)) AS weather_code
FROM events e
JOIN customer c ON e.user_id = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
WHERE e.event_type = '{CONTEXT_EVENT_TYPE}' AND r.r_name <> '{CONTEXT_EXCLUDED_REGION}'
GROUP BY 1, 2"""

# Deduplicated observations joined to the site lookup (orphan = no dimension row).
SQL_ENRICHED = """
SELECT d.site_id, d.obs_ts, d.status, d.capacity, d.available, d.free, d.event_id, d.batch,
       l.site_name, l.zone, l.lat, l.lon, NOT coalesce(l.in_dim, false) AS is_orphan
FROM dedup d LEFT JOIN lookup l ON d.site_id = l.site_id"""

SQL_SLOTTED = """
SELECT *, time_bucket(INTERVAL 15 MINUTE, obs_ts) AS slot_ts FROM enriched WHERE NOT is_orphan"""

SQL_JOINED = """
SELECT m.*, c.temperature_2m_c, c.apparent_temperature_c, c.relative_humidity_2m_pct,
       c.precipitation_mm, c.weather_code, c.zone IS NOT NULL AS has_context
FROM slotted m LEFT JOIN ctx c ON m.zone = c.zone AND m.slot_ts = c.ctx_ts"""

SQL_CONSISTENCY_BROKEN = (
    "(capacity IS NULL OR available IS NULL OR coalesce(capacity <= 0, false) "
    "OR coalesce(available < 0, false) OR coalesce(available > capacity, false))"
)

SQL_FINAL = f"""
SELECT *, CASE WHEN capacity > 0 THEN round(available / capacity * 100, 2) END AS fill_rate,
       timezone('{TIME_ZONE}', timezone('UTC', obs_ts)) AS obs_local,
       CAST(year(timezone('{TIME_ZONE}', timezone('UTC', obs_ts))) AS INTEGER) AS year,
       CAST(month(timezone('{TIME_ZONE}', timezone('UTC', obs_ts))) AS INTEGER) AS month,
       CAST(day(timezone('{TIME_ZONE}', timezone('UTC', obs_ts))) AS INTEGER) AS day,
       CAST(hour(timezone('{TIME_ZONE}', timezone('UTC', obs_ts))) AS INTEGER) AS hour
FROM joined"""

SQL_STORED_ORDERS = f"SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{MERGE_STORED_UNTIL}'"

SQL_RELOADED_ORDERS = f"""
SELECT o_orderkey, o_orderdate, o_orderstatus,
       CASE WHEN o_orderpriority = '{MERGE_REVISED_PRIORITY}' THEN o_totalprice + {MERGE_SURCHARGE}::DOUBLE
            ELSE o_totalprice END AS o_totalprice
FROM orders WHERE o_orderdate >= TIMESTAMP '{MERGE_RELOAD_FROM}'"""


def sql_spread(*names: str) -> str:
    """``sql_with`` over the spread observations."""
    return sql_with(*names).replace(
        "user_id AS site_id, ts AS obs_ts", f"user_id AS site_id, ts + (user_id % 7) * {SPREAD} AS obs_ts"
    )


def sql_with(*names: str) -> str:
    """A WITH clause holding the named CTEs, in dependency order."""
    bodies = {
        "obs_base": SQL_OBS_BASE,
        "obs": SQL_OBS,
        "dedup": SQL_DEDUP,
        "sites": SQL_SITES,
        "overrides": SQL_OVERRIDES,
        "lookup": SQL_LOOKUP,
        "ctx": SQL_CONTEXT,
        "enriched": SQL_ENRICHED,
        "slotted": SQL_SLOTTED,
        "joined": SQL_JOINED,
        "final_all": SQL_FINAL,
        "stored": SQL_STORED_ORDERS,
        "reloaded": SQL_RELOADED_ORDERS,
    }
    deps = {
        "obs": ["obs_base"],
        "dedup": ["obs"],
        "lookup": ["sites", "overrides"],
        "enriched": ["dedup", "lookup"],
        "slotted": ["enriched"],
        "joined": ["slotted", "ctx"],
        "final_all": ["joined"],
    }
    order: list[str] = []

    def visit(n: str) -> None:
        for d in deps.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({bodies[n]})" for n in order) + "\n"
