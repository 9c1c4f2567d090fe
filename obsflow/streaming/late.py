"""Streaming dedup that keeps late rows (STR2).

Spark's own streaming dedup drops a row that arrives later than the watermark
and only counts it. Here every row ends in a table:

    out/epoch_id=<n>      first arrivals of each (site, instant), with the site
    late/epoch_id=<n>     rows at or before the watermark, as received, with the
                          watermark that made them late
    epochs/epoch_id=<n>   one row per micro-batch: the times it has seen, and how many
                          rows were read, kept, copies of kept rows, and late

The watermark before a batch is the latest time of all earlier batches less the
delay. It is read from the ``epochs`` table, so it survives a restart and a
replayed batch meets the same one; each batch writes only folders of its own
number, so a replay overwrites what it wrote. Always:

    read = kept + copies + late
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from obsflow.operators.dedup import dedup_latest
from obsflow.operators.enrich import attach_sites
from obsflow.session import new_work_path
from obsflow.sinks.parquet import remove_folder, table_exists

EPOCHS = "epoch_id int, max_ts timestamp_ntz, max_kept_ts timestamp_ntz, n_read bigint, n_kept bigint, n_copies bigint, n_late bigint"
LATE_MARK = "late_watermark"


@dataclass(frozen=True)
class LateTables:
    """Folders of the stream; all below ``base`` unless named."""

    base: str

    @property
    def out(self) -> str:
        return f"{self.base.rstrip('/')}/out"

    @property
    def late(self) -> str:
        return f"{self.base.rstrip('/')}/late"

    @property
    def epochs(self) -> str:
        return f"{self.base.rstrip('/')}/epochs"

    @property
    def checkpoint(self) -> str:
        return f"{self.base.rstrip('/')}/checkpoint"


def epochs(spark: SparkSession, tables: LateTables) -> DataFrame:
    """The figures of every batch so far."""
    if not table_exists(spark, tables.epochs):
        return spark.createDataFrame([], EPOCHS)
    return spark.read.schema(EPOCHS).parquet(tables.epochs)


def _one_batch(
    df: DataFrame, epoch_id: int, tables: LateTables, delay: str, keys: Sequence[str], ts_col: str, sites: DataFrame, overrides: DataFrame | None
) -> None:
    spark = df.sparkSession
    work = new_work_path(spark, "late-batch")
    df.write.parquet(work)  # the batch is computed once
    batch = spark.read.schema(df.schema).parquet(work)
    before = epochs(spark, tables).filter(F.col("epoch_id") < epoch_id)
    # One value on the driver, so that filters prune by it.
    mark = before.agg((F.max("max_ts") - F.expr(f"INTERVAL {delay}")).alias("mark")).first().mark
    watermark = F.lit(mark).cast("timestamp_ntz")

    keyed = F.lit(True)
    for k in keys:
        keyed = keyed & F.col(k).isNotNull()
    is_late = F.coalesce(keyed & (F.col(ts_col) <= watermark), F.lit(False))
    late = batch.filter(is_late).withColumn(LATE_MARK, watermark)
    late.write.mode("overwrite").parquet(f"{tables.late}/epoch_id={epoch_id}")

    # Rows without a full key cannot be deduplicated by it: all are kept.
    fresh = dedup_latest(batch.filter(keyed & ~is_late), keys)
    # Copies can only be among kept rows later than the watermark: the few
    # batches that hold such rows are read, by folder and by time.
    live = [r.epoch_id for r in before.filter(watermark.isNull() | (F.col("max_kept_ts") > watermark)).select("epoch_id").collect()]
    if live:
        key_schema = StructType([batch.schema[k] for k in keys]).add("epoch_id", "integer")
        kept_before = spark.read.schema(key_schema).parquet(tables.out)
        kept_before = kept_before.filter(F.col("epoch_id").isin(live) & (watermark.isNull() | (F.col(ts_col) > watermark)))
        fresh = fresh.join(kept_before.select(*keys), list(keys), "left_anti")
    kept = attach_sites(fresh.unionByName(batch.filter(~keyed)), sites, overrides)
    kept.write.mode("overwrite").parquet(f"{tables.out}/epoch_id={epoch_id}")

    written = spark.read.schema(kept.schema).parquet(f"{tables.out}/epoch_id={epoch_id}")
    n_late = spark.read.schema(late.schema).parquet(f"{tables.late}/epoch_id={epoch_id}").count()
    n_read, max_ts = batch.agg(F.count(F.lit(1)), F.max(ts_col)).first()
    n_kept, max_kept = written.agg(F.count(F.lit(1)), F.max(ts_col)).first()
    figures = spark.createDataFrame([(max_ts, max_kept, n_read, n_kept, n_read - n_kept - n_late, n_late)], EPOCHS.split(", ", 1)[1])
    figures.coalesce(1).write.mode("overwrite").parquet(f"{tables.epochs}/epoch_id={epoch_id}")
    remove_folder(spark, work)


def dedup_enrich_keep_late(
    observations: DataFrame,
    sites: DataFrame,
    base: str,
    delay: str,
    keys: Sequence[str] = ("site_id", "obs_ts"),
    ts_col: str = "obs_ts",
    overrides: DataFrame | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the stream ``observations`` into the tables below ``base``.

    ``delay`` is the tolerated lateness (``"1 DAY"``): a key is kept once within it,
    and rows at or before the watermark go to the late table, all of them. Start it again
    with the same ``base`` to go on where it stopped.
    """
    tables = LateTables(base)
    writer = observations.writeStream.foreachBatch(
        lambda df, epoch_id: _one_batch(df, epoch_id, tables, delay, list(keys), ts_col, sites, overrides)
    ).option("checkpointLocation", tables.checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def late_rows(spark: SparkSession, tables: LateTables, schema: StructType) -> DataFrame:
    """Every late row as it was received, with its batch and watermark."""
    if not table_exists(spark, tables.late):
        return spark.createDataFrame([], schema).selectExpr("*", f"cast(null as timestamp_ntz) as {LATE_MARK}", "cast(null as int) as epoch_id")
    return spark.read.schema(StructType(list(schema.fields)).add(LATE_MARK, "timestamp_ntz").add("epoch_id", "integer")).parquet(tables.late)


def merge_late(kept: DataFrame, late: DataFrame, sites: DataFrame, keys: Sequence[str] = ("site_id", "obs_ts"), overrides: DataFrame | None = None) -> DataFrame:
    """Kept rows and the late ones that add a key: what a batch job over all rows
    would keep. Late rows get their site here."""
    added = dedup_latest(late.drop(LATE_MARK, "epoch_id"), list(keys))
    added = added.join(kept.select(*keys), list(keys), "left_anti")
    return kept.drop("epoch_id").unionByName(attach_sites(added, sites, overrides))
