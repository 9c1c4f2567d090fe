"""Context series from raw CSV texts with a preamble (SRC5, SRC6, PRJ8, PRJ9, FN13, FN14, FN17).

An archived file is preamble lines, then a header line starting with ``time,``,
then rows; each cell is addressed by header name, so a reordered header still
maps correctly. There are two readers with the same rows:

- ``read_lines``: files are read line by line in splits, whatever their size; only
  the header of each file is gathered and joined to its lines;
- ``read_texts``: one row per file with its whole text, for texts that are already
  values of a column, and files that surely fit into a task.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from obsflow.functions.numeric import try_cast, try_flag
from obsflow.functions.text import geo_point, zone_path_key
from obsflow.functions.time import parse_local_text
from obsflow.operators.joins import unique_by
from obsflow.schemas import CONTEXT_CSV_COLUMNS, CONTEXT_CSV_HEADER_PREFIX
from obsflow.session import new_work_path
from obsflow.sinks.parquet import write_partitioned

# Path layout: .../commune=<key>/start=<date>/end=<date>/ingested_at=<stamp>[.csv | /part-...]
_PATH_FIELDS = {
    "commune_key": r"commune=([^/]+)",
    "start": r"start=([^/]+)",
    "end": r"end=([^/]+)",
    "ingested_at": r"ingested_at=([^/.]+)",
}


def _unescape(value: Column) -> Column:
    """Path segment -> its text: undo the file URI encoding, then Spark's
    partition-folder escaping (``:`` is written ``%3A``, so ``%253A`` in the
    URI). A literal ``+`` is kept (URL decoding would turn it into a space).
    """
    once = F.try_url_decode(F.regexp_replace(value, r"\+", "%2B"))
    return F.try_url_decode(F.regexp_replace(once, r"\+", "%2B"))


def _path_fields() -> dict[str, Column]:
    """Zone, window and ingestion stamp from ``file_path`` (SRC6)."""
    fields = {k: _unescape(F.regexp_extract("file_path", rx, 1)) for k, rx in _PATH_FIELDS.items()}
    fields["start"] = F.try_to_date(fields["start"], "yyyy-MM-dd")
    fields["end"] = F.try_to_date(fields["end"], "yyyy-MM-dd")
    return fields


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: its whole text and its path (SRC5, SRC6).

    Zone, window and ingestion stamp come from the path, through the
    ``_metadata`` column, so both the reference's file-name layout and a
    folder layout work; partition discovery is switched off to keep types
    as text.
    """
    df = (
        spark.read.option("recursiveFileLookup", "true")
        .text(path, wholetext=True)
        .select("value", F.col("_metadata.file_path").alias("file_path"))
    )
    return df.withColumns(_path_fields())


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line: ``value``, ``file_path`` and ``line_at``, its place in the
    file (SRC5).

    A large file is read by many tasks. ``line_at`` orders the lines of a file: by
    the split's first byte, then by the order of reading inside the split; it is
    the same in every scan of the same files, since Spark plans the splits from
    the file listing alone. A file without any line gives no row.
    """
    return (
        spark.read.option("recursiveFileLookup", "true")
        .text(path)
        .select(
            "value",
            F.col("_metadata.file_path").alias("file_path"),
            F.struct(F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("line")).alias("line_at"),
        )
    )


def split_lines(lines: DataFrame) -> DataFrame:
    """Lines of ``read_lines`` -> one row per data line, like ``split_text``.

    Of each file the first line that starts with ``time,`` is its header; one row a
    file is gathered and joined back to the lines behind it, so no file's lines meet in
    one task unless Spark chooses to shuffle them for that join.
    """
    is_header = F.col("value").startswith(CONTEXT_CSV_HEADER_PREFIX)
    first = lines.filter(is_header).groupBy("file_path").agg(F.min(F.struct("line_at", "value")).alias("first"))
    headers = first.select(
        F.col("file_path"), F.col("first.line_at").alias("__header_at"), split_cells(F.col("first.value")).alias("__header"), *[c.alias(n) for n, c in _path_fields().items()]
    )
    data = lines.join(headers, "file_path").filter((F.col("line_at") > F.col("__header_at")) & (F.trim("value") != ""))
    cells = split_cells(F.col("value"))
    data = data.select(
        "file_path",
        *_PATH_FIELDS,
        F.lit(True).alias("header_found"),
        F.col("line_at.line").alias("line_no"),
        F.col("value").alias("line"),
        F.when(F.size(cells) == F.size("__header"), F.map_from_arrays("__header", cells)).alias("cells"),
    )
    # A file without a header gives one row, so that it is quarantined.
    lost = lines.select("file_path").distinct().join(first, "file_path", "left_anti").withColumns(_path_fields())
    lost = lost.withColumns(
        {"header_found": F.lit(False), "line_no": F.lit(0).cast("long"), "line": F.lit(None).cast("string"), "cells": F.lit(None).cast("map<string,string>")}
    )
    return data.unionByName(lost)


def split_cells(line: Column) -> Column:
    """Cells of one CSV line; a quoted cell may hold commas and doubled quotes.

    A line without a quote takes the plain split. An unbalanced quote leaves
    the wrong number of cells, so the row is quarantined.
    """
    # A comma is a separator if an even number of quotes follows it.
    quoted = F.split(line, r',(?=(?:[^"]*+"[^"]*+")*+[^"]*+$)')
    plain = F.transform(
        quoted,
        lambda c: F.when(
            F.trim(c).rlike(r'(?s)^".*"$'), F.replace(F.regexp_extract(F.trim(c), r'(?s)^"(.*)"$', 1), F.lit('""'), F.lit('"'))
        ).otherwise(c),
    )
    return F.when(line.contains('"'), plain).otherwise(F.split(line, ","))


def split_text(texts: DataFrame, text_col: str = "value") -> DataFrame:
    """Whole texts -> one row per data line with a header->cell map (FN17).

    Adds ``header_found`` (FALSE when no line starts with ``time,``: such a
    text yields one row with NULL ``cells`` so that it is quarantined, not
    silently dropped), ``line_no``, ``line`` and ``cells``. Blank lines and a trailing
    newline are skipped; CRLF line ends are accepted.
    """
    lines = F.split(F.col(text_col), r"\r?\n")
    hdr_pos = F.array_position(F.transform(lines, lambda l: l.startswith(CONTEXT_CSV_HEADER_PREFIX)), True)
    t = texts.withColumns({"__lines": lines, "__hdr": hdr_pos})
    header = split_cells(F.element_at("__lines", F.col("__hdr").cast("int")))
    body = F.slice("__lines", (F.col("__hdr") + 1).cast("int"), F.size("__lines"))
    body = F.filter(body, lambda l: F.trim(l) != "")
    t = t.withColumns(
        {
            "header_found": F.col("__hdr") > 0,
            "__header": F.when(F.col("__hdr") > 0, header),
            "__body": F.when(F.col("__hdr") > 0, body).otherwise(F.array(F.lit(None).cast("string"))),
        }
    )
    # A text without a header keeps one sentinel row (NULL line) so that it
    # is quarantined; a header with no data lines simply yields no rows.
    t = t.select("*", F.posexplode("__body").alias("line_no", "__line"))
    cells = split_cells(F.col("__line"))
    cell_map = F.when(
        F.col("__line").isNotNull() & (F.size(cells) == F.size("__header")),
        F.map_from_arrays("__header", cells),
    )
    return t.withColumns({"cells": cell_map, "line": F.col("__line")}).drop("__lines", "__hdr", "__header", "__body", "__line")


def typed_measures(cells: Column | str = "cells") -> dict[str, Column]:
    """Header-named cells -> typed, renamed measures; bad cells NULL (PRJ8, FN14, m23)."""
    m = F.col(cells) if isinstance(cells, str) else cells
    out = {}
    for header, name, dtype in CONTEXT_CSV_COLUMNS:
        cell = F.element_at(m, F.lit(header))
        out[name] = try_flag(cell) if dtype == "boolean" else try_cast(cell, dtype) if dtype != "string" else cell
    return out


def context_from_texts(texts: DataFrame, tz: str, zones: DataFrame | None = None) -> DataFrame:
    """Parsed context rows: zone, location, ctx_ts (UTC NTZ) and measures.

    ``zones`` (zone, lat, lon) recovers the exact zone name from the lossy
    path key (m24) and the GeoJSON point (PRJ7); without it the path key is
    used as the zone. Rows whose time or a non-empty cell cannot be read
    keep NULLs, list the columns in ``bad_cells`` and have ``row_ok =
    FALSE``; empty cells are missing values (NULL) in an otherwise ok row.
    """
    return _typed_rows(split_text(texts), tz, zones)


def context_from_lines(lines: DataFrame, tz: str, zones: DataFrame | None = None) -> DataFrame:
    """``context_from_texts`` for the lines of ``read_lines``."""
    return _typed_rows(split_lines(lines), tz, zones)


def accept_context(spark: SparkSession, rows: DataFrame, rejects_path: str) -> tuple[DataFrame, dict]:
    """Parsed context rows -> (the readable ones, figures), read once.

    The unreadable ones are kept at ``rejects_path`` with their line, file and the
    cells that could not be read: rows read = used + quarantined.
    """
    work, seen = new_work_path(spark, "context-intake"), Observation(f"context_{uuid.uuid4().hex}")
    figures = [F.count(F.lit(1)).alias("n_context_read"), F.count_if("row_ok").alias("n_context_used")]
    write_partitioned(rows, work, ["row_ok"], rebalance=False, observe=(seen, figures))
    n = dict(seen.get)
    kept = spark.read.schema(rows.schema).parquet(work)
    kept.filter(~F.col("row_ok")).write.mode("overwrite").parquet(rejects_path)
    return kept.filter("row_ok"), n | {"n_context_quarantined": n["n_context_read"] - n["n_context_used"]}


def _typed_rows(rows: DataFrame, tz: str, zones: DataFrame | None) -> DataFrame:
    rows = rows.withColumns(typed_measures("cells"))
    rows = rows.withColumn("ctx_ts", parse_local_text("ctx_time_text", tz))
    if zones is not None:
        z = zones.select(
            zone_path_key("zone").alias("commune_key"), "zone", geo_point("lon", "lat").alias("location")
        )
        rows = rows.join(unique_by(z, ["commune_key"]), "commune_key", "left")
    else:
        rows = rows.withColumns({"zone": F.col("commune_key"), "location": F.lit(None).cast("struct<type:string,coordinates:array<double>>")})
    measure_names = [name for _, name, _ in CONTEXT_CSV_COLUMNS[1:]]
    # A cell that holds text but does not parse makes the row inconsistent
    # (quarantined, m23); an empty cell is a missing value and stays NULL.
    bad = F.array_compact(
        F.array(
            *[
                F.when(
                    (F.trim(F.element_at("cells", F.lit(header))) != "") & F.col(name).isNull(), F.lit(name)
                )
                for header, name, _ in CONTEXT_CSV_COLUMNS[1:]
            ]
        )
    )
    rows = rows.withColumn("bad_cells", bad)
    ok = F.col("cells").isNotNull() & F.col("ctx_ts").isNotNull() & (F.size("bad_cells") == 0)
    return rows.select(
        "zone",
        "location",
        "ctx_ts",
        *measure_names,
        "start",
        "end",
        "ingested_at",
        "line_no",
        "line",
        *(["file_path"] if "file_path" in rows.columns else []),
        "bad_cells",
        ok.alias("row_ok"),
    )
