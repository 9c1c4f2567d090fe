"""Parquet sinks (SNK1, SNK2, SNK4, SNK7, SNK8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str],
    mode: str = "overwrite",
    dynamic: bool = True,
    rebalance: bool = True,
    observe: tuple[Observation, Sequence[Column]] | None = None,
    cluster_by: Sequence[str] = (),
) -> None:
    """Write Parquet partitioned by ``partition_cols`` (SNK1, SNK2).

    ``dynamic=True`` replaces only the partitions present in ``df`` (m25);
    ``False`` is the reference's full replacement. ``rebalance`` adds AQE's
    REBALANCE on the partition columns: one shuffle that groups each
    partition's rows into tasks of the advisory size (splitting a hot month
    across tasks), instead of every task writing a small file into every
    partition. ``cluster_by`` takes its place: the rows are dealt by ranges of
    (partition, these columns) and sorted, so that inside a partition each file, and
    each of its row groups, holds a narrow range of them and a filter skips
    the others by their statistics (SRC3, FLT7).
    """
    if cluster_by:
        order = [*partition_cols, *cluster_by]
        out = df.repartitionByRange(*order).sortWithinPartitions(*order)
    elif rebalance and partition_cols:
        out = df.hint("rebalance", *partition_cols)
    else:
        out = df
    if observe is not None:
        # Above the exchange: the metrics are collected by the write's result
        # tasks, which update accumulators once per partition even when a
        # lost executor forces earlier stages to run again.
        obs, cols = observe
        out = out.observe(obs, *cols)
    writer = out.write.mode(mode).option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.parquet(path)


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Plain append for targets without a key (SNK4)."""
    df.write.mode("append").format(fmt).save(path)


def read_back(spark: SparkSession, path: str, partition_filter: F.Column | None = None) -> DataFrame:
    """Read a written dataset back, partitions discovered from the path (SRC3).

    A filter on partition columns prunes directories (``PartitionFilters``).
    """
    df = spark.read.parquet(path)
    return df if partition_filter is None else df.filter(partition_filter)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, asked of the path's own Hadoop file system.

    Works for any scheme the cluster is configured for (hdfs, s3a, abfs,
    file) and plans no query, so a missing table is not an analysis error.
    """
    from obsflow.session import spark_context

    sc = spark_context(spark)
    if sc is None:  # Spark Connect: ask the reader instead
        from pyspark.errors import AnalysisException

        try:
            spark.read.parquet(path).schema  # noqa: B018
            return True
        except AnalysisException:
            return False
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def _file_system(spark: SparkSession, path: str):
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()), sc._jvm.org.apache.hadoop.fs.Path


def partition_folders(spark: SparkSession, path: str, partition_cols: Sequence[str]) -> list[str]:
    """Partition folders below ``path``, as ``year=2024/month=7``, in the order of
    their values (numbers as numbers). Only folders are listed, no files."""
    fs, make = _file_system(spark, path)
    found = fs.globStatus(make("/".join([path.rstrip("/"), *[f"{c}=*" for c in partition_cols]]))) or []
    names = ["/".join(s.getPath().toString().split("/")[-len(partition_cols) :]) for s in found if s.isDirectory()]

    def order(folder: str) -> list[tuple]:
        values = [v.split("=", 1)[1] for v in folder.split("/")]
        return [(0, int(v), "") if v.lstrip("-").isdigit() else (1, 0, v) for v in values]

    return sorted(names, key=order)


def write_empty(df: DataFrame, path: str) -> None:
    """A table of ``df``'s columns without rows: one file without partition
    folders, so that a reader without a schema finds the columns."""
    df.limit(0).coalesce(1).write.mode("overwrite").parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder this library wrote, if it is there."""
    fs, make = _file_system(spark, path)
    fs.delete(make(path), True)


def swap_folders(spark: SparkSession, moves: Sequence[tuple[str | None, str]], aside: str) -> None:
    """Put new folders in the place of old ones, by renames only.

    Each of ``moves`` is (new folder or None, place); None leaves the place
    empty. What stood there is moved below ``aside`` first and deleted at the
    end. If a rename fails, those done are undone, and the error is raised: the
    places then hold what they held before. All paths must be on one file
    system; ``aside`` should begin with an underscore so that readers skip it.
    """
    if not moves:
        return
    fs, make = _file_system(spark, aside)
    done: list[tuple[str, str]] = []

    def rename(src: str, dst: str) -> None:
        fs.mkdirs(make(dst).getParent())
        if not fs.rename(make(src), make(dst)):
            raise OSError(f"could not move {src} to {dst}")
        done.append((src, dst))

    try:
        for k, (new, place) in enumerate(moves):
            if fs.exists(make(place)):
                rename(place, f"{aside}/{k}")
            if new is not None:
                rename(new, place)
    except Exception:
        for src, dst in reversed(done):
            fs.rename(make(dst), make(src))
        raise
    fs.delete(make(aside), True)


def verify_count(spark: SparkSession, path: str, expected: int) -> dict:
    """Read-back row count compared with the count observed at write time (SNK8).

    Parquet counts come from footers, so this reads no data pages.
    """
    n = spark.read.parquet(path).count()
    return {"path": path, "expected": int(expected), "read_back": int(n), "ok": int(n) == int(expected)}


def preview(df: DataFrame, n: int = 20, order: Sequence[str] = ()) -> DataFrame:
    """First ``n`` rows for display, ordered when ``order`` is given (SNK7, SRT2)."""
    return (df.orderBy(*order) if order else df).limit(n)
