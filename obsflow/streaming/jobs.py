"""Streaming forms of landing and deduplication (STR1, STR2).

STR1: new raw feed files -> flatten -> keyed merge into a partitioned table,
one micro-batch at a time through ``foreachBatch``. The stream checkpoint
takes the place of the reference's "resume from the latest stored date":
every file is processed exactly once, and a replayed batch merges to the
same table because the merge is idempotent.

STR2: deduplication on (site, instant) inside a watermark, then a
stream-static join to the site dimension. State is bounded by the watermark
delay; rows later than the delay are dropped by Spark, so the delay is the
lateness the job tolerates: it has no default, and ``LateRows`` counts what
was dropped. ``streaming.late`` is the form that keeps late rows in a table.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from obsflow.functions.time import utc_ntz_to_instant
from obsflow.operators.dedup import dedup_latest
from obsflow.operators.enrich import attach_sites
from obsflow.operators.merge import INSERTED, change_counts, keyed_merge
from obsflow.operators.reshape import flatten_items, items_from_lines
from obsflow.schemas import RAW_OBSERVATION_ITEM
from obsflow.session import new_work_path
from obsflow.sinks import bucketed
from obsflow.sinks.parquet import remove_folder, table_exists, write_partitioned

LANDING_KEYS = ("site_id", "obs_ts")
LANDING_PARTITION = "obs_date"


COUNTS = "n_inserted bigint, n_updated bigint, n_unchanged bigint, n_kept bigint, n_rows bigint"


def merge_into_table(
    spark: SparkSession,
    batch: DataFrame,
    table_path: str,
    keys: Sequence[str] = LANDING_KEYS,
    partition_col: str = LANDING_PARTITION,
    partition_expr: str = "to_date(obs_ts)",
    buckets: int | None = None,
    on_staged: Callable[[dict], None] | None = None,
) -> dict:
    """Upsert one batch into a partitioned Parquet table (SNK3, INC4); the counts
    of inserted, updated, unchanged and kept rows of the touched partitions.

    The partition must follow from the key (be ``partition_expr`` over key
    columns, or one of them), else a row could exist twice. Only the partitions the batch
    touches are read, merged and rewritten; an empty batch changes nothing. The merged
    partitions are staged first, so the table is never overwritten by a plan
    reading it, and ``on_staged`` gets the counts before the table changes.
    With ``buckets`` the table is laid out by key and its stored rows are not
    shuffled (``sinks.bucketed``).
    """
    if partition_col not in keys and not batch.filter(~F.col(partition_col).eqNullSafe(F.expr(partition_expr))).isEmpty():
        raise ValueError(f"{partition_col} must be {partition_expr}: a key may not change its partition")
    batch = dedup_latest(batch, keys)
    # One row per date in the batch, on the driver: the filter then prunes folders.
    dates = [r[0] for r in batch.select(partition_col).distinct().collect()]
    if not dates:
        counts = dict.fromkeys((c.split()[0] for c in COUNTS.split(", ")), 0)
        if on_staged is not None:
            on_staged(counts)
        return counts
    if buckets is not None:
        return bucketed.merge(spark, landing_table(table_path, batch.schema, keys, partition_col, buckets), batch, dates, on_staged)
    if table_exists(spark, table_path):
        current = spark.read.parquet(table_path).filter(F.col(partition_col).isin(dates))
        merged = keyed_merge(current, batch, keys)
    else:
        merged = batch.withColumn("change", F.lit(INSERTED))
    staged, seen = new_work_path(spark, "merge-stage"), Observation(f"merge_{uuid.uuid4().hex}")
    write_partitioned(merged, staged, [partition_col], observe=(seen, change_counts()))
    counts = dict(seen.get)
    if on_staged is not None:
        on_staged(counts)
    again = spark.read.schema(merged.schema).parquet(staged).drop("change")
    write_partitioned(again, table_path, [partition_col], rebalance=False)
    remove_folder(spark, staged)
    return counts


def landing_table(table_path: str, schema: StructType, keys: Sequence[str] = LANDING_KEYS, partition_col: str = LANDING_PARTITION, buckets: int = 64) -> bucketed.BucketedTable:
    """The bucketed landing table at a path; its catalog name follows from it."""
    name = f"obsflow_{hashlib.sha256(table_path.rstrip('/').encode()).hexdigest()[:24]}"
    fields = sorted(schema.fields, key=lambda f: f.name == partition_col)  # the partition column last
    return bucketed.BucketedTable(name, table_path, StructType(fields), tuple(keys), partition_col, buckets)


def landing_stream(
    spark: SparkSession,
    source_path: str,
    table_path: str,
    checkpoint_path: str,
    schema: StructType = RAW_OBSERVATION_ITEM,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    quarantine_path: str | None = None,
    counts_path: str | None = None,
    buckets: int | None = None,
) -> StreamingQuery:
    """Start STR1: raw JSON items under ``source_path``, one per line, -> merged table.

    ``raw`` is the received line. Items whose key cannot be read (malformed
    line, unparsed time, missing site) cannot be merged by key; they are
    written, with the line, to ``quarantine_path`` (default: the table path +
    ``_quarantine``). Each micro-batch is parsed once, into a staged table.

    ``counts_path`` (default: the table path + ``_counts``) gets one row a batch:
    inserted, updated, unchanged and kept rows. It is written before the table
    changes and not again when a batch is replayed, so the figures are those of the
    first time.
    """
    quarantine_path = quarantine_path or table_path.rstrip("/") + "_quarantine"
    counts_path = (counts_path or table_path.rstrip("/") + "_counts").rstrip("/")
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    items = items_from_lines(reader.text(source_path), "value", schema)
    flat = flatten_items(items).withColumn(LANDING_PARTITION, F.to_date("obs_ts"))
    keyed = F.col("site_id").isNotNull() & F.col("obs_ts").isNotNull()

    def each_batch(df: DataFrame, epoch_id: int) -> None:
        session = df.sparkSession
        staged = new_work_path(session, "landing-batch")
        df.withColumn("__keyed", keyed).write.partitionBy("__keyed").parquet(staged)
        parsed = session.read.schema(df.withColumn("__keyed", keyed).schema).parquet(staged)
        # The quarantine first: it must not wait for a merge that may fail.
        # Written per epoch under its own folder, so a replayed epoch
        # overwrites its own rows instead of adding them twice.
        bad = parsed.filter("not __keyed").drop("__keyed").withColumn("epoch_id", F.lit(epoch_id))
        bad.write.mode("overwrite").parquet(f"{quarantine_path.rstrip('/')}/epoch_id={epoch_id}")

        def keep_counts(counts: dict) -> None:
            # Spark marks a finished write; one that was cut off is done again.
            if not table_exists(session, f"{counts_path}/epoch_id={epoch_id}/_SUCCESS"):
                row = session.createDataFrame([tuple(counts[c.split()[0]] for c in COUNTS.split(", "))], COUNTS)
                row.coalesce(1).write.mode("overwrite").parquet(f"{counts_path}/epoch_id={epoch_id}")

        merge_into_table(session, parsed.filter("__keyed").drop("__keyed"), table_path, buckets=buckets, on_staged=keep_counts)
        remove_folder(session, staged)

    writer = flat.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint_path)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def await_available_now(query: StreamingQuery, timeout_s: int = 1800) -> None:
    """Wait for an ``availableNow`` stream to drain; stop it and fail if it does not."""
    if not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"stream {query.name or query.id} did not drain within {timeout_s}s")
    if query.exception() is not None:
        raise RuntimeError(f"stream failed: {query.exception()}")


class LateRows(StreamingQueryListener):
    """Counts, per query, the rows Spark dropped as later than the watermark.

    Add it with ``spark.streams.addListener`` before starting the query;
    ``dropped[str(query.id)]`` holds the sum over all micro-batches.
    """

    def __init__(self):
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event):
        self.dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event):
        p = event.progress
        late = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
        self.dropped[str(p.id)] = self.dropped.get(str(p.id), 0) + late

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def dedup_enrich_stream(
    observations: DataFrame,
    sites: DataFrame,
    watermark: str,
    keys: Sequence[str] = LANDING_KEYS,
    overrides: DataFrame | None = None,
) -> DataFrame:
    """STR2: streaming dedup within ``watermark`` then the site join.

    The watermark needs an instant, so the UTC NTZ time is mapped 1:1 to a
    TIMESTAMP column first; the dedup key uses it in place of ``obs_ts``.
    The first arrival of a key is kept (streaming has no "later" copy).
    """
    ts_key = "__event_time"
    other = [k for k in keys if k != "obs_ts"]
    keyed = F.col("obs_ts").isNotNull()
    for k in other:
        keyed = keyed & F.col(k).isNotNull()
    s = observations.filter(keyed).withColumn(ts_key, utc_ntz_to_instant("obs_ts"))
    s = s.withWatermark(ts_key, watermark).dropDuplicatesWithinWatermark([*other, ts_key]).drop(ts_key)
    # Rows without a full key cannot be deduplicated by it: they pass through
    # unmerged rather than being lost to a NULL event time.
    s = s.unionByName(observations.filter(~keyed))
    return attach_sites(s, sites, overrides)
