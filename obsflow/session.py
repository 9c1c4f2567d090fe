"""Session construction and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import weakref

from pyspark.sql import SparkSession

# Settings every job relies on. The session zone only matters for instant
# (TIMESTAMP) columns; the library keeps times as TIMESTAMP_NTZ in UTC so
# results do not depend on it, but pinning it keeps `show()` output stable.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str = "local[8]",
    app_name: str = "obsflow",
    shuffle_partitions: int = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session for tests, the bench and local runs.

    On a cluster the caller's session is used as is; only ``ensure_shared_dir``
    touches its configuration, and only when no checkpoint folder is set.
    """
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    Intermediate tables (staging, merge output, archives written by the
    round-trip queries) go under it so that every executor sees them and a
    lost executor does not lose them. A local temporary folder is created and
    registered only in local mode when the session names none, as in tests;
    on a cluster a missing setting is an error.
    """
    sc = spark_context(spark)
    shared = spark.conf.get("spark.checkpoint.dir", None) or _LOCAL_SHARED.get(spark)
    if not shared and sc is not None:
        shared = sc.getCheckpointDir()
    if not shared:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "local")
        if not _is_local(master):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a folder every executor can reach "
                "(hdfs://, s3a://, abfs://, ...) for staged tables"
            )
        # spark.checkpoint.dir cannot be changed at run time; the context's
        # checkpoint folder can, and is what later calls find.
        shared = tempfile.mkdtemp(prefix="obsflow-")
        _LOCAL_SHARED[spark] = shared
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared)
    return shared.rstrip("/")


# Local-mode fallback folders, per live session, when none was configured
# (weak keys: an id() could be reused by a later session).
_LOCAL_SHARED: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def _is_local(master: str) -> bool:
    """Driver and executors in one process."""
    return master == "local" or master.startswith("local[")


def spark_context(spark: SparkSession):
    """The session's SparkContext, or None on a Spark Connect session."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions expose no SparkContext
        return None


def new_work_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder under the shared folder."""
    base = ensure_shared_dir(spark)
    path = f"{base}/obsflow/{label}-{uuid.uuid4().hex[:12]}"
    sc = spark_context(spark)
    if sc is not None and _is_local(sc.master) and ("://" not in path or path.startswith("file:")):
        # Only here is the driver's own disk the shared one; on a cluster a path
        # without a scheme is one of its default file system.
        os.makedirs(os.path.dirname(path.removeprefix("file://").removeprefix("file:")), exist_ok=True)
    return path


def cluster_conf(
    input_bytes: int,
    executor_cores: int = 4,
    executors: int = 1000,
    shuffle_ratio: float = 0.5,
    target_partition_bytes: int = 256 * 1024 * 1024,
) -> dict[str, str]:
    """Sizing for a large run, to pass to spark-submit or the session builder.

    - Scan splits of 512 MB keep the task count near input / 512 MB
      (200k tasks for 100 TB) while each split fits an executor core.
    - The initial shuffle partition count covers the expected shuffle volume
      at ``target_partition_bytes`` each, and is at least 3x the cores so
      every wave is full; AQE then coalesces small partitions and splits
      skewed ones (a skewed partition is 5x the median and over 1 GB).
    - Sides of up to 64 MB, by the size of their written files or as AQE
      measures it, are broadcast.
    """
    cores = executor_cores * executors
    shuffle_bytes = int(input_bytes * shuffle_ratio)
    partitions = max(3 * cores, -(-shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(512 * 1024 * 1024),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * 1024 * 1024),
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.session.timeZone": "UTC",
    }
