"""Published tables behind one pointer (SNK1, SNK2, SNK8).

A run writes its files into a folder of its own and then adds one small pointer
file that says which folder holds each partition of each table. Readers take
the newest pointer, so they see all of a run or nothing of it, and a reader that
has resolved a pointer keeps reading the files it names while newer ones appear.
Nothing that is published is ever moved or overwritten:

    out/_published/000000000007.json      the pointer
    out/rows/version=<run>/year=2024/month=7/part-...
    out/hours/version=<run>/year=2024/month=7/part-...

Two runs that publish at once both try to create the same next pointer; the
second one fails and has published nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from obsflow.sinks.parquet import _file_system, partition_folders, remove_folder

VERSION = "version"


@dataclass(frozen=True)
class Table:
    """One table of a snapshot: its schema, and for each partition folder
    (``year=2024/month=7``) the version that holds it."""

    schema: StructType
    folders: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Snapshot:
    number: int
    tables: Mapping[str, Table]


def _pointer(out_dir: str, number: int) -> str:
    return f"{out_dir.rstrip('/')}/_published/{number:012d}.json"


def _numbers(spark: SparkSession, out_dir: str) -> list[int]:
    folder = f"{out_dir.rstrip('/')}/_published"
    fs, make = _file_system(spark, folder)
    if not fs.exists(make(folder)):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(make(folder))]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())


def snapshot(spark: SparkSession, out_dir: str, number: int | None = None) -> Snapshot | None:
    """The newest snapshot (or the given one); None if nothing is published."""
    numbers = _numbers(spark, out_dir)
    if number is None:
        if not numbers:
            return None
        number = numbers[-1]
    found = json.loads(read_file(spark, _pointer(out_dir, number)))
    return Snapshot(number, {n: Table(StructType.fromJson(t["schema"]), t["folders"]) for n, t in found["tables"].items()})


def read_table(spark: SparkSession, out_dir: str, table: str, at: Snapshot | None = None, folders: Iterable[str] | None = None) -> DataFrame:
    """One table as a snapshot has it (default: the newest). ``folders`` keeps only
    these partitions, so that no other is listed."""
    at = at or snapshot(spark, out_dir)
    if at is None:
        raise FileNotFoundError(f"nothing is published in {out_dir}")
    t = at.tables[table]
    wanted = t.folders if folders is None else [f for f in folders if f in t.folders]
    base = f"{out_dir.rstrip('/')}/{table}"
    paths = [f"{base}/{VERSION}={t.folders[f]}/{f}" for f in wanted]
    if not paths:
        return spark.createDataFrame([], t.schema)
    return spark.read.schema(t.schema).option("basePath", base).parquet(*paths).select(*t.schema.names)


def new_version_path(out_dir: str, table: str, version: str) -> str:
    return f"{out_dir.rstrip('/')}/{table}/{VERSION}={version}"


def switch(
    spark: SparkSession,
    out_dir: str,
    before: Snapshot | None,
    version: str,
    schemas: Mapping[str, StructType],
    partition_cols: list[str],
    replaced: Iterable[str] | None,
) -> Snapshot:
    """Publish what was written as ``version`` after ``before``, in one step.

    ``replaced`` lists the partition folders that the run owns; None: all.
    Those it wrote no file for are gone; the others stay with the version that
    holds them.
    """
    tables = {}
    for name, schema in schemas.items():
        old = dict(before.tables[name].folders) if before and replaced is not None else {}
        for f in replaced or ():
            old.pop(f, None)
        new = {f: version for f in partition_folders(spark, new_version_path(out_dir, name, version), partition_cols)}
        tables[name] = Table(schema, old | new)
    made = Snapshot(before.number + 1 if before else 1, tables)
    text = json.dumps({"tables": {n: {"schema": t.schema.jsonValue(), "folders": dict(t.folders)} for n, t in tables.items()}})
    create_file(spark, _pointer(out_dir, made.number), text)
    return made


def create_file(spark: SparkSession, path: str, text: str) -> None:
    """A whole new small file at once, or an error if there is one."""
    fs, make = _file_system(spark, path)
    jvm = spark.sparkContext._jvm
    aside = make(f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")
    out = fs.create(aside, False)
    out.write(bytearray(text.encode()))
    out.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    none[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        files.rename(aside, make(path), none)
    except Exception:
        fs.delete(aside, False)
        raise


def read_file(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    fs, make = _file_system(spark, path)
    stream = fs.open(make(path))
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def expire(spark: SparkSession, out_dir: str, keep: int = 2) -> list[str]:
    """Delete what only snapshots older than the last ``keep`` name: version
    folders and their pointers. Returns the deleted folders. Run it when no reader
    works with an older snapshot and no run is under way."""
    if keep < 1:
        raise ValueError("the newest snapshot must be kept")
    numbers = _numbers(spark, out_dir)
    kept = [snapshot(spark, out_dir, n) for n in numbers[-keep:]]
    gone = []
    for name in kept[-1].tables if kept else ():
        base = f"{out_dir.rstrip('/')}/{name}"
        live = {v for s in kept for v in (s.tables[name].folders.values() if name in s.tables else ())}
        for folder in partition_folders(spark, base, [VERSION]):
            if folder.removeprefix(f"{VERSION}=") not in live:
                remove_folder(spark, f"{base}/{folder}")
                gone.append(f"{name}/{folder}")
    for n in numbers[:-keep]:
        remove_folder(spark, _pointer(out_dir, n))
    return gone
