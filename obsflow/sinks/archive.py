"""Raw archives (SNK5, SNK6): landed text kept under ingestion-time paths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.functions.text import zone_path_key


def write_page_snapshot(pages: DataFrame, path: str, ingested_at: str) -> None:
    """Append a snapshot of JSON pages under ``ingested_at=<stamp>`` (SNK5).

    Empty pages are not archived. The "current" copy of the reference is not
    written: readers take the latest snapshot (sources.snapshots, SRC7).
    """
    kept = pages.filter(F.coalesce(F.size("values") > 0, F.lit(False)))
    kept.withColumn("ingested_at", F.lit(ingested_at)).write.mode("append").partitionBy("ingested_at").json(path)


def write_context_archive(texts: DataFrame, path: str, ingested_at: str) -> None:
    """Archive whole CSV texts under zone/start/end/ingestion folders (SNK6).

    ``texts``: one row per (zone, start, end) with the full text in
    ``value``. The zone folder uses the lossy path key (m24). Each row is one
    folder, so each file holds exactly one text.
    """
    out = texts.select(
        zone_path_key("zone").alias("commune"),
        F.col("start").cast("string").alias("start"),
        F.col("end").cast("string").alias("end"),
        F.lit(ingested_at).alias("ingested_at"),
        "value",
    )
    (
        out.repartition("commune", "start", "end")
        .write.mode("append")
        .partitionBy("commune", "start", "end", "ingested_at")
        .option("lineSep", "\n")
        .text(path)
    )
