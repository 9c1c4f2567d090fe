"""Data-quality reports (DQ1-DQ8, AGG1, AGG3, AGG5, AGG6).

Each report is one aggregate over the frame it describes: a single pass, a
single row (or a small list), no driver-side loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsflow.operators.rules import GATE_RULES, Rule, rule_counts


def _n() -> Column:
    return F.count(F.lit(1))


def join_quality(enriched: DataFrame) -> DataFrame:
    """Rows read, matched and orphaned after the site join (DQ1)."""
    return enriched.agg(
        _n().alias("n_rows"),
        F.count_if(~F.col("is_orphan")).alias("n_matched"),
        F.count_if(F.col("is_orphan")).alias("n_orphans"),
    )


def distinct_count_with_null(col: str) -> Column:
    """Number of distinct values, NULL counted as one value (m12)."""
    return F.count_distinct(F.col(col)) + F.max(F.when(F.col(col).isNull(), 1).otherwise(0))


def null_attribute_report(df: DataFrame, attribute: str, site_col: str = "site_id") -> DataFrame:
    """Rows with a NULL attribute and the distinct sites they belong to (DQ3)."""
    rows = df.filter(F.col(attribute).isNull())
    return rows.agg(
        _n().alias("n_rows"),
        F.coalesce(distinct_count_with_null(site_col), F.lit(0)).cast("bigint").alias("n_sites"),
    )


def null_attribute_sites(
    df: DataFrame, attribute: str, cols: Sequence[str] = ("site_id", "site_name", "lat", "lon")
) -> DataFrame:
    """Distinct site descriptions among rows with a NULL attribute (AGG5, DQ3)."""
    return df.filter(F.col(attribute).isNull()).select(*cols).distinct()


def context_match_report(joined: DataFrame, measure: str = "temperature_2m_c") -> DataFrame:
    """Rows after the context join; without a match; with a NULL measure (DQ4, m16)."""
    return joined.agg(
        _n().alias("n_rows"),
        F.count_if(~F.col("has_context")).alias("n_unmatched"),
        F.count_if(F.col(measure).isNull()).alias("n_measure_null"),
    )


def zone_coverage(facts: DataFrame, context: DataFrame, zone_col: str = "zone") -> DataFrame:
    """Distinct fact zones and how many lack context (DQ2), as one row.

    One shuffle: fact zones are reduced to distinct values first, then
    left-joined to the distinct context zones.
    """
    fact_zones = facts.select(F.col(zone_col).alias("zone")).distinct()
    ctx_zones = context.select("zone").distinct().withColumn("__has", F.lit(True))
    j = fact_zones.join(ctx_zones, "zone", "left")
    return j.agg(
        _n().alias("n_zones"),
        F.count_if(F.col("__has").isNull()).alias("n_zones_without_context"),
    )


def gate_figures(df: DataFrame, rules: Sequence[Rule] = GATE_RULES, where: Column | None = None) -> list[Column]:
    """Aggregate columns of the gate: row count plus one count per rule (AGG1)."""
    n = _n() if where is None else F.count_if(where)
    return [n.alias("n_rows"), *rule_counts(rules, where=where)]


def quality_gate(df: DataFrame, rules: Sequence[Rule] = GATE_RULES) -> DataFrame:
    """One row: the row count, one count per rule, and the verdict (DQ6, m13, m14).

    ``passed`` is TRUE when no blocking rule is broken by any row.
    """
    figures = df.agg(*gate_figures(df, rules))
    blocking = [F.col(r.name) == 0 for r in rules if r.blocking]
    verdict = F.lit(True)
    for cond in blocking:
        verdict = verdict & cond
    return figures.withColumn("passed", verdict)


def gate_verdict(metrics: dict[str, int], rules: Sequence[Rule] = GATE_RULES, prefix: str = "") -> dict:
    """Verdict from already observed figures (no extra job)."""
    failed = [r.name for r in rules if r.blocking and int(metrics.get(f"{prefix}{r.name}", 0) or 0) > 0]
    return {"passed": not failed, "failed_rules": failed}


def reconciliation(n_read: Column, n_matched: Column, n_orphans: Column, n_anomalies: Column, n_final: Column) -> list[Column]:
    """Published identities: read = matched + orphans; final = matched - anomalies (DQ8)."""
    return [
        (n_read == n_matched + n_orphans).alias("read_equals_matched_plus_orphans"),
        (n_final == n_matched - n_anomalies).alias("final_equals_matched_minus_anomalies"),
    ]
