"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from ..session import new_work_path
from ..sinks.parquet import remove_folder

WORD_BPE_FILE = "word_bpe_49k.json"
PIECE_BPE_FILE = "piece_bpe_32k.model"


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: its lineage is
    cut, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = new_work_path(spark, f"llm-{label}")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_path = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete tables of ``written`` that no later result reads."""
    for df in tables:
        remove_folder(df.sparkSession, df._written_path)


def values(batch, column: str) -> Iterator:
    """Python values of one Arrow column, one at a time, so that a batch of
    long texts is not held twice."""
    for value in batch.column(column):
        yield value.as_py()
