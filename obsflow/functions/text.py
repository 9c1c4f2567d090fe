"""Text and record expressions (FN17, FN18, FN20, PRJ6, PRJ7)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def zone_path_key(col: str | Column) -> Column:
    """Zone name as written in archive paths: space -> "_", "/" -> "-" (FN18).

    Not reversible (m24): archives are matched to zones by applying the same
    function to the zone table, never by decoding the path.
    """
    return F.translate(_c(col), " /", "_-")


def geo_point(lon: str | Column, lat: str | Column) -> Column:
    """GeoJSON point struct, longitude first (PRJ7)."""
    return F.struct(
        F.lit("Point").alias("type"),
        F.array(_c(lon).cast("double"), _c(lat).cast("double")).alias("coordinates"),
    )


def record_json(*cols: str | Column) -> Column:
    """Whole record as JSON text, non-ASCII kept as is (FN20, PRJ6)."""
    return F.to_json(F.struct(*cols))
