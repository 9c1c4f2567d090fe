"""Reshaping landed records (PRJ1, PRJ5, PRJ6, PRJ9, PRJ10, FLT8, FN21)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from obsflow.functions.text import record_json
from obsflow.functions.time import parse_instant
from obsflow.schemas import RAW_OBSERVATION_ITEM, SITE_FIELDS


def non_empty_pages(pages: DataFrame, array_col: str = "values") -> DataFrame:
    """Drop pages whose array is NULL or empty (FLT8)."""
    return pages.filter(F.coalesce(F.size(array_col) > 0, F.lit(False)))


def explode_records(pages: DataFrame, array_col: str = "values") -> DataFrame:
    """One row per record of the array, record fields as columns (PRJ1, FN21).

    ``inline`` yields nothing for NULL or empty arrays, like explode.
    """
    return pages.select(F.inline(array_col))


def sites_from_records(records: DataFrame) -> DataFrame:
    """Landed site records -> canonical site dimension columns."""
    return records.select(*[F.col(src).alias(dst) for src, dst in SITE_FIELDS.items()])


def items_from_lines(lines: DataFrame, line_col: str = "value", schema: StructType = RAW_OBSERVATION_ITEM) -> DataFrame:
    """Text lines -> items with their declared fields, and the line as ``raw`` (PRJ6).

    The received text stays whole: fields the schema does not declare are in
    ``raw``, and so is a line that is no JSON object, whose fields are NULL.
    Other columns of ``lines`` are carried along. Blank lines are no items.
    """
    parsed = lines.filter(F.trim(F.col(line_col)) != "").withColumn("__item", F.from_json(F.col(line_col), schema))
    others = [c for c in lines.columns if c != line_col]
    return parsed.select(*others, *[F.col("__item")[f.name].alias(f.name) for f in schema.fields], F.col(line_col).alias("raw"))


def flatten_items(items: DataFrame, keep_raw: bool = True, raw_as_variant: bool = False) -> DataFrame:
    """Raw feed items -> canonical observations (PRJ5, PRJ6).

    Nested counts two levels down; a missing or NULL ``main_stands`` gives
    NULL counts (m18). ``raw`` keeps the whole item as JSON text, or as a
    VARIANT with ``raw_as_variant`` (queried with ``variant_get``). Where the
    items have a ``raw`` column (see ``items_from_lines``) it is kept as it is,
    undeclared fields included; else it is rebuilt from the declared fields.
    """
    cols = [
        F.col("number").alias("site_id"),
        F.col("horodate").alias("obs_text"),
        parse_instant("horodate").alias("obs_ts"),
        F.col("status"),
        F.col("main_stands.capacity").alias("capacity"),
        F.col("main_stands.availabilities.bikes").alias("available"),
        F.col("main_stands.availabilities.stands").alias("free"),
    ]
    if keep_raw:
        raw = F.col("raw") if "raw" in items.columns else record_json(*[F.col(c) for c in items.columns])
        cols.append((F.try_parse_json(raw) if raw_as_variant else raw).alias("raw"))
    return items.select(*cols)


def from_landed(landed: DataFrame) -> DataFrame:
    """Landed observation (station_id, horodate, ...) -> canonical observation."""
    return landed.select(
        F.col("station_id").alias("site_id"),
        F.col("horodate").alias("obs_text"),
        parse_instant("horodate").alias("obs_ts"),
        "status",
        "capacity",
        F.col("bikes_available").alias("available"),
        F.col("stands_available").alias("free"),
    )


def concat_frames(frames: Iterable[DataFrame]) -> DataFrame:
    """Concatenate frames by column name, missing columns as NULL (PRJ10)."""
    frames = list(frames)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def context_from_landed(landed: DataFrame, measures: Iterable[str] | None = None) -> DataFrame:
    """Landed context (commune, location, datetime instant, measures) -> canonical.

    The landed time is an instant; it becomes the UTC wall clock (NTZ) the
    library joins on.
    """
    from obsflow.functions.time import instant_to_utc_ntz
    from obsflow.schemas import CONTEXT_MEASURES

    declared = {f.name: f.dataType for f in CONTEXT_MEASURES.fields}
    names = list(measures) if measures is not None else list(declared)
    ts = F.col("datetime")
    ts = instant_to_utc_ntz(ts) if dict(landed.dtypes).get("datetime") == "timestamp" else ts.cast("timestamp_ntz")
    # Measures missing from the landed documents are NULL of their declared type.
    cols = [F.col(c) if c in landed.columns else F.lit(None).cast(declared[c]).alias(c) for c in names]
    return landed.select(
        F.col("commune").alias("zone"),
        *(["location"] if "location" in landed.columns else []),
        ts.alias("ctx_ts"),
        *cols,
    )
