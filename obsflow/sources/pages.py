"""JSON page sources (SRC1, SRC7) and the site dimension built from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from obsflow.operators.reshape import explode_records, non_empty_pages, sites_from_records
from obsflow.schemas import SITE_PAGE

CORRUPT_COL = "_corrupt_record"


def read_pages(spark: SparkSession, path: str, schema=SITE_PAGE, keep_corrupt: bool = True) -> DataFrame:
    """JSON-lines pages read with a declared schema (SRC1).

    PERMISSIVE mode: a malformed line becomes a row with ``_corrupt_record``
    set instead of failing the read.
    """
    if keep_corrupt:
        # A new StructType: ``StructType.add`` would modify the shared schema.
        schema = StructType([*schema.fields, StructField(CORRUPT_COL, StringType())])
    return (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COL)
        .json(path)
    )


def latest_snapshot(df: DataFrame, col: str = "ingested_at") -> DataFrame:
    """Rows of the most recent snapshot only (SRC7).

    The maximum is a scalar subquery; on a partition column the scan then
    reads only that partition.
    """
    latest = df.select(F.max(col)).scalar()
    return df.filter(F.col(col) == latest)


def sites_from_pages(pages: DataFrame) -> DataFrame:
    """Pages -> canonical site dimension (FLT8, PRJ1, PRJ2)."""
    return sites_from_records(explode_records(non_empty_pages(pages)))


def page_report(pages: DataFrame) -> DataFrame:
    """One row: pages read, malformed ones, well-formed ones without records,
    and records. ``pages`` as read by ``read_pages``."""
    bad = F.col(CORRUPT_COL).isNotNull()
    n = F.coalesce(F.size("values"), F.lit(0))
    return pages.select(bad.alias("bad"), F.greatest(n, F.lit(0)).alias("n")).agg(
        F.count(F.lit(1)).alias("n_pages"),
        F.count_if("bad").alias("n_malformed"),
        F.count_if(~F.col("bad") & (F.col("n") == 0)).alias("n_empty"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_records"),
    )


def read_sites(spark: SparkSession, path: str, snapshot_col: str | None = "ingested_at", on_malformed: str = "raise") -> DataFrame:
    """Site dimension from a page archive, latest snapshot when historised.

    A malformed page would take up to a page of sites with it and turn their
    observations into orphans, so it fails the query that reads it (no job
    runs here). With ``on_malformed="skip"`` it is left out; count such pages
    with ``page_report(read_pages(...))``.
    """
    if on_malformed not in ("raise", "skip"):
        raise ValueError(f"on_malformed must be 'raise' or 'skip', not {on_malformed!r}")
    pages = read_pages(spark, path)
    if snapshot_col and snapshot_col in pages.columns:
        pages = latest_snapshot(pages, snapshot_col)
    bad = F.col(CORRUPT_COL).isNotNull()
    if on_malformed == "raise":
        error = F.raise_error(F.concat(F.lit("malformed site page: "), F.substring(CORRUPT_COL, 1, 200)))
        pages = pages.filter(F.when(bad, error.cast("boolean")).otherwise(F.lit(True)))
    else:
        pages = pages.filter(~bad)
    return sites_from_pages(pages)
