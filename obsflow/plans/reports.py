"""The job's diagnostics as DataFrames, read from a finished run (SNK7, DQ1-DQ8).

The reference prints these with ``show()`` after recomputing the pipeline
from the sources each time. Here they read the staged table of the run
(a written table), so each report is a scan of already enriched rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.operators.enrich import zones_without_context
from obsflow.operators.quality import null_attribute_sites
from obsflow.operators.rollup import top_n
from obsflow.plans.batch_job import ANOMALY, OK, BatchResult, published_table
from obsflow.plans.layouts import HOUR_NAMES, read_as_library


def staged(spark: SparkSession, result: BatchResult) -> DataFrame:
    """The run's staged rows; a published run keeps them only with ``keep_staging``."""
    return spark.read.parquet(result.staging_path)


def quarantine(spark: SparkSession, result: BatchResult) -> DataFrame:
    """Every row that was not published, with its disposition and reasons."""
    return spark.read.parquet(result.rejects_path)


def matched(spark: SparkSession, result: BatchResult) -> DataFrame:
    """Rows matched to a site, before the consistency filter."""
    return staged(spark, result).filter(F.col("disposition").isin(OK, ANOMALY))


def run_reports(
    spark: SparkSession, result: BatchResult, context: DataFrame | None = None, top: int = 20
) -> dict[str, DataFrame]:
    """All diagnostics of one run, as lazily evaluated DataFrames."""
    m = result.metrics
    counts = spark.createDataFrame(
        [(m["n_rows"], m["n_matched"], m["n_orphans"], m["n_anomalies"], m["n_final"])],
        "n_rows bigint, n_matched bigint, n_orphans bigint, n_anomalies bigint, n_final bigint",
    )
    rows = matched(spark, result)
    out = {
        "join_quality": counts,
        "null_zone_sites": null_attribute_sites(rows, "zone"),
        "rate_out_of_range": rows.filter((F.col("fill_rate") < 0) | (F.col("fill_rate") > 100)).select(
            "site_id", "site_name", "obs_ts", "capacity", "available", "free", "fill_rate"
        ),
        "quarantine_by_reason": quarantine(spark, result)
        .select(F.explode_outer("reasons").alias("reason"))
        .groupBy("reason")
        .count(),
    }
    if result.published:
        hours = read_as_library(published_table(spark, result.hours_path.rsplit("/", 1)[0], "hours"), HOUR_NAMES)
        out["site_hour_top"] = top_n(hours, ["site_id", "year", "month", "day", "hour"], top)
    if context is not None:
        out["zones_without_context"] = zones_without_context(rows, context)
    return out
