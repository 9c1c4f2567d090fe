"""Format-neutral table source (SRC2, SRC4).

A document-store collection, a Parquet folder or a JSON folder are all read
through ``DataFrameReader.format(...)`` with a declared schema. Connector
jars and object-store credentials are the caller's: options are passed
through unchanged (``spark.hadoop.fs.s3a.*`` belong in the session conf).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def load_table(
    spark: SparkSession,
    fmt: str,
    schema: StructType | None = None,
    path: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read one table with an explicit schema; no inference in production."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    return reader.load(path) if path is not None else reader.load()


def collection(spark: SparkSession, database: str, name: str, schema: StructType, fmt: str = "mongodb") -> DataFrame:
    """A document-store collection through its Spark connector (SRC2)."""
    return load_table(spark, fmt, schema, options={"database": database, "collection": name})
