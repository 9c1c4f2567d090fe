"""A landing table that merges without moving what is stored (SNK3, INC4).

The table is partitioned by a column that follows from the key (a date) and, inside
each partition, bucketed by the key. Spark knows from the table's definition which
bucket a stored row lies in, so a join on the key shuffles only the incoming batch to
as many partitions as there are buckets, and the merged rows are written from
where they are, one file a bucket and partition.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from obsflow.operators.merge import change_counts, keyed_merge
from obsflow.session import new_work_path
from obsflow.sinks.parquet import partition_folders, remove_folder, swap_folders, table_exists
from obsflow.sinks.versions import create_file, read_file

SPEC = "_buckets.json"


@dataclass(frozen=True)
class BucketedTable:
    """``name`` in the session's catalog, files below ``path``. ``schema`` holds
    all columns; ``partition_col`` must follow from ``keys``."""

    name: str
    path: str
    schema: StructType
    keys: tuple[str, ...]
    partition_col: str
    buckets: int


def open_table(spark: SparkSession, t: BucketedTable) -> DataFrame:
    """The table, defined in this session's catalog if it is not yet (the files
    outlive a session, the definition may not)."""
    spec = json.dumps({"keys": list(t.keys), "partition": t.partition_col, "buckets": t.buckets})
    spec_path = f"{t.path.rstrip('/')}/{SPEC}"
    if not table_exists(spark, spec_path):
        if table_exists(spark, t.path) and partition_folders(spark, t.path, [t.partition_col]):
            raise ValueError(f"{t.path} holds a table that is not bucketed")
        create_file(spark, spec_path, spec)
    elif read_file(spark, spec_path) != spec:
        # Other buckets would make Spark look for rows in the wrong files.
        raise ValueError(f"{t.path} is laid out as {read_file(spark, spec_path)}, not {spec}")
    if not spark.catalog.tableExists(t.name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in t.schema)
        keys = ", ".join(f"`{k}`" for k in t.keys)
        spark.sql(
            f"CREATE TABLE {t.name} ({columns}) USING parquet PARTITIONED BY (`{t.partition_col}`) "
            f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {int(t.buckets)} BUCKETS LOCATION '{t.path}'"
        )
        spark.catalog.recoverPartitions(t.name)
    return spark.table(t.name)


def merged(spark: SparkSession, t: BucketedTable, batch: DataFrame, partitions: Sequence) -> DataFrame:
    """``batch`` merged into the given partitions of the table, with ``change``."""
    return keyed_merge(open_table(spark, t).filter(F.col(t.partition_col).isin(list(partitions))), batch, t.keys)


def merge(spark: SparkSession, t: BucketedTable, batch: DataFrame, partitions: Sequence, on_staged: Callable[[dict], None] | None = None) -> dict:
    """Upsert ``batch`` (one row a key) into the ``partitions`` it touches.

    The merged partitions are written once, beside the table, in its layout; the
    counts of the changes are observed by that write and handed to ``on_staged``; then
    the partition folders take the old ones' places by renames.
    """
    staged, name = new_work_path(spark, "bucketed"), f"obsflow_staged_{uuid.uuid4().hex}"
    seen = Observation(name)
    out = merged(spark, t, batch, partitions).observe(seen, *change_counts()).select(*t.schema.names)
    writer = out.write.partitionBy(t.partition_col).bucketBy(t.buckets, *t.keys).sortBy(*t.keys)
    try:
        writer.format("parquet").option("path", staged).saveAsTable(name)
        counts = dict(seen.get)
        if on_staged is not None:
            on_staged(counts)
        folders = partition_folders(spark, staged, [t.partition_col])
        swap_folders(spark, [(f"{staged}/{f}", f"{t.path.rstrip('/')}/{f}") for f in folders], f"{t.path.rstrip('/')}/_before-{name}")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove_folder(spark, staged)
    for f in folders:
        value = f.split("=", 1)[1]
        spark.sql(f"ALTER TABLE {t.name} ADD IF NOT EXISTS PARTITION (`{t.partition_col}` = '{value}')")
    spark.catalog.refreshTable(t.name)
    return counts
