"""Enrichment joins (JON1-JON3, FN12, FLT1, ENR1-ENR4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.functions.numeric import pct_rate
from obsflow.functions.time import calendar_columns, slot_start, utc_to_local
from obsflow.operators.joins import many_to_one_join, require_unique, unique_by

SITE_COLUMNS = ("site_name", "zone", "lat", "lon")
_IN_DIM = "__in_dimension"
# Where a key was fetched more than once, the latest fetch wins.
FETCH_ORDER = ("ingested_at",)


def fetch_order(df: DataFrame, order: Sequence[str] = FETCH_ORDER) -> list[str]:
    """The columns of ``order`` that ``df`` has: where a key repeats, the
    record with the greatest of these, the last fetch, wins."""
    return [c for c in order if c in df.columns]


def site_lookup(sites: DataFrame, overrides: DataFrame | None = None, order: Sequence[str] = FETCH_ORDER) -> DataFrame:
    """Site dimension with zone overrides folded in (FN12, m4).

    ``sites``: site_id plus SITE_COLUMNS, and optionally the columns of
    ``order``. ``overrides``: (site_id, zone) used only where the dimension's
    zone is NULL; an override for a site the dimension lacks still provides a
    zone, but the site stays an orphan, exactly as an override applied to
    joined rows would behave. Keys are made unique first so the join cannot
    fan out (m17): the last fetch wins, then the greatest record.
    """
    order = fetch_order(sites, order)
    # One union and one aggregate (one shuffle): the last dimension record
    # and the greatest override per key, both deterministic.
    rec = F.struct(*[F.col(c) for c in [*order, *SITE_COLUMNS]])
    both = sites.select("site_id", rec.alias("__rec"))
    none = F.lit(None)
    if overrides is not None:
        rec_type = both.schema["__rec"].dataType.simpleString()
        both = both.withColumn("__ovr", none.cast("string")).unionByName(
            overrides.select("site_id", none.cast(rec_type).alias("__rec"), F.col("zone").alias("__ovr"))
        )
    else:
        both = both.withColumn("__ovr", none.cast("string"))
    agg = both.groupBy("site_id").agg(F.max("__rec").alias("__rec"), F.max("__ovr").alias("__ovr"))
    return agg.select(
        "site_id",
        F.col("__rec.site_name").alias("site_name"),
        F.coalesce(F.col("__rec.zone"), F.col("__ovr")).alias("zone"),
        F.col("__rec.lat").alias("lat"),
        F.col("__rec.lon").alias("lon"),
        F.when(F.col("__rec").isNotNull(), F.lit(True)).alias(_IN_DIM),
    )


def attach_sites(
    obs: DataFrame,
    sites: DataFrame,
    overrides: DataFrame | None = None,
    orphan_on: str = "site_key",
    on_duplicate: str = "dedup",
) -> DataFrame:
    """Left join observations to the site dimension; flag orphans (JON1, FLT1, ENR1).

    ``orphan_on="site_key"`` (default): orphan = no dimension row matched.
    ``orphan_on="site_name"``: the reference's test, orphan = joined name is
    NULL, so a known site without a name is an orphan too (m3).
    ``on_duplicate="raise"`` fails on a repeated site key instead of keeping
    the last fetched record (m17). ``sites`` may also be a lookup made by
    ``site_lookup`` beforehand.
    """
    prepared = _IN_DIM in sites.columns
    if on_duplicate == "raise" and not prepared:
        require_unique(sites, ["site_id"], "site dimension")
    elif on_duplicate not in ("dedup", "raise"):
        raise ValueError(f"on_duplicate must be 'dedup' or 'raise', not {on_duplicate!r}")
    lookup = sites if prepared else site_lookup(sites, overrides)
    joined = many_to_one_join(obs, lookup, ["site_id"], ["site_id"])
    if orphan_on == "site_name":
        orphan = F.col("site_name").isNull()
    elif orphan_on == "site_key":
        orphan = F.col(_IN_DIM).isNull()
    else:
        raise ValueError(f"orphan_on must be 'site_key' or 'site_name', not {orphan_on!r}")
    return joined.withColumn("is_orphan", orphan).drop(_IN_DIM)


def split_orphans(enriched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(matched, orphans) from one flagged frame; the two are exact complements."""
    return enriched.filter(~F.col("is_orphan")), enriched.filter(F.col("is_orphan"))


def with_slot(df: DataFrame, ts_col: str = "obs_ts", out: str = "slot_ts", minutes: int = 15) -> DataFrame:
    """Add the start of the time slot holding ``ts_col`` (FN4)."""
    return df.withColumn(out, slot_start(ts_col, minutes))


def context_lookup(context: DataFrame, measures: Sequence[str], order: Sequence[str] = FETCH_ORDER) -> DataFrame:
    """One row per (zone, ctx_ts), the last fetched, marked ``has_context``."""
    order = fetch_order(context, order)
    ctx = unique_by(context.select("zone", "ctx_ts", *measures, *order), ["zone", "ctx_ts"], order)
    return ctx.select("zone", "ctx_ts", *measures, F.lit(True).alias("has_context"))


def attach_context(
    df: DataFrame,
    context: DataFrame,
    measures: Sequence[str],
    zone_col: str = "zone",
    slot_col: str = "slot_ts",
    on_duplicate: str = "dedup",
    order: Sequence[str] = FETCH_ORDER,
) -> DataFrame:
    """Left join on (zone, slot) to the context series (JON2, ENR2).

    The context is made unique on (zone, ctx_ts) so the join is many-to-one;
    of several fetches of a slot the last one (by ``order``) wins. It may also
    be a lookup made by ``context_lookup`` beforehand. NULL zones match
    nothing (m5).
    Adds ``has_context`` (a context row matched), separate from whether its
    measures are NULL (m16).
    """
    prepared = "has_context" in context.columns
    if on_duplicate == "raise" and not prepared:
        require_unique(context, ["zone", "ctx_ts"], "context series")
    elif on_duplicate not in ("dedup", "raise"):
        raise ValueError(f"on_duplicate must be 'dedup' or 'raise', not {on_duplicate!r}")
    ctx = context if prepared else context_lookup(context, measures, order)
    out = many_to_one_join(df, ctx, [zone_col, slot_col], ["zone", "ctx_ts"])
    return out.withColumn("has_context", F.coalesce(F.col("has_context"), F.lit(False)))


def zones_without_context(facts: DataFrame, context: DataFrame, zone_col: str = "zone") -> DataFrame:
    """Distinct fact zones that never appear in the context (JON3, AGG4, DQ2).

    A NULL zone equals nothing, so it is listed (m5).
    """
    fact_zones = facts.select(F.col(zone_col).alias("zone")).distinct()
    ctx_zones = context.select("zone").distinct()
    return fact_zones.join(ctx_zones, "zone", "left_anti")


def with_fill_rate(df: DataFrame, part: str = "available", whole: str = "capacity", out: str = "fill_rate") -> DataFrame:
    """Percentage of capacity in use, 2 decimals, NULL without capacity (ENR3)."""
    return df.withColumn(out, pct_rate(part, whole))


def with_local_calendar(df: DataFrame, tz: str, ts_col: str = "obs_ts", local_col: str = "obs_local") -> DataFrame:
    """Local wall clock and its year, month, day, hour (ENR4, m7, m8)."""
    local = utc_to_local(ts_col, tz)
    return df.withColumns({local_col: local, **calendar_columns(local)})
