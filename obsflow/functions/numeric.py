"""Numeric expressions (FN8-FN12, FN14, FN22)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def pct_rate(part: str | Column, whole: str | Column, scale: int = 2) -> Column:
    """``round(part / whole * 100, scale)`` when ``whole > 0``, else NULL (FN9).

    The guard keeps ANSI division by zero from firing, and a NULL or
    non-positive denominator gives NULL rather than a bogus rate.
    """
    w = _c(whole)
    return F.when(w > 0, F.round(_c(part) / w * 100, scale))


def exact_avg(col: str | Column, scale: int = 2) -> Column:
    """Average rounded half-up to ``scale`` decimals, independent of order.

    A DOUBLE average sums in whatever order the partitions arrive, so ties at
    the rounding digit can fall either way from run to run. Inputs here are
    counts or values already rounded to 2 decimals (m10), which a decimal
    holds exactly, so the sum is exact; the mean carries 14 decimals before
    the final half-up rounding, so that intermediate step cannot move a tie.
    NULLs are skipped and an all-NULL group gives NULL (m11). Result is DOUBLE.
    """
    dec = _c(col).cast("decimal(30,10)")
    return F.round(F.avg(dec), scale).cast("double")


def try_cast(col: str | Column, dtype: str | DataType) -> Column:
    """Text -> type, NULL instead of an error for bad or empty cells (FN14, m23)."""
    c = _c(col)
    return F.when(F.trim(c) == "", F.lit(None).cast(dtype)).otherwise(c.try_cast(dtype))


def try_flag(col: str | Column) -> Column:
    """"0"/"1" text -> boolean, as bool(int(text)) but NULL when malformed."""
    return try_cast(col, "int") != 0
