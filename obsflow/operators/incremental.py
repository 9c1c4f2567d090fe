"""Incremental loading plans (INC1-INC3, JON4, FN16).

The reference computes these in a driver loop; here each is a small
DataFrame derived from the stored data, so the plan is data, not control
flow, and it can be joined or written like any other table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.functions.time import local_day_bounds, utc_to_local


def in_date_range(
    df: DataFrame,
    start: str,
    end: str,
    tz: str = "UTC",
    ts_col: str = "obs_ts",
    date_col: str | None = None,
    widen: str = "0 minutes",
    date_is: str = "landing",
) -> DataFrame:
    """Rows whose UTC time falls on the local dates ``start``..``end``, both
    included (FLT7).

    The bounds are literals, pushed down to the scan. ``date_col`` names a
    partition column that prunes folders too; ``date_is`` says what it holds:

    - ``"landing"``: the UTC date the row arrived, on or after its own time. Folders
      before the range are skipped; a row may arrive any time later.
    - ``"utc"``: the UTC date of ``ts_col`` itself. Folders on both sides are
      skipped; a row that is read and has another date raises, since rows like it
      may lie in skipped folders.

    ``widen`` moves the lower bound back, for a series looked up by slot.
    """
    if date_is not in ("landing", "utc"):
        raise ValueError(f"date_is must be 'landing' or 'utc', not {date_is!r}")
    lo, hi = local_day_bounds(start, end, tz)
    lo = lo - F.expr(f"INTERVAL '{widen.split()[0]}' {widen.split()[1].rstrip('s').upper()}")
    out = df.filter((F.col(ts_col) >= lo) & (F.col(ts_col) < hi))
    if date_col is not None:
        date = F.col(date_col).cast("date")
        out = out.filter(date >= F.to_date(lo))
        if date_is == "utc":
            wrong = F.raise_error(F.concat(F.lit(f"{date_col} is not the UTC date of {ts_col}: "), date.cast("string")))
            out = out.filter(date <= F.to_date(hi)).filter(
                F.when(date == F.to_date(ts_col), F.lit(True)).otherwise(wrong.cast("boolean"))
            )
    return out


def newest_partition(df: DataFrame, ts_col: str, partitions: Sequence[Mapping[str, object]]) -> DataFrame:
    """Rows of the newest partition that holds a time (INC1, AGG8).

    ``partitions`` are partition values in ascending order, from a listing of
    folders. They are tried from the newest down: a folder without a row or without a
    time is passed over, so the latest time is that of the whole table, but only the
    newest folders are read. The partition columns must ascend with the time.
    """
    for values in reversed(partitions):
        part = df
        for name, value in values.items():
            part = part.filter(F.col(name) == value)
        if not part.filter(F.col(ts_col).isNotNull()).isEmpty():
            return part
    return df.filter(F.lit(False))


def resume_point(
    stored: DataFrame,
    ts_col: str = "obs_ts",
    start: str | None = None,
    end: str | None = None,
    today: dt.date | None = None,
    tz: str | None = None,
    lookback_days: int = 7,
) -> DataFrame:
    """One row (start_date, end_date, start_source) for the next load (INC1).

    Start: the explicit date, else the date of the latest stored time, else
    ``today - lookback_days``. End: the explicit date, else ``today``. The
    latest time is the maximum of the parsed time, not of its text (m21);
    with ``tz`` its local date is used. ``today`` is a parameter so runs are
    reproducible; it defaults to the session's current date.
    """
    latest = F.max(ts_col)
    latest_date = F.to_date(utc_to_local(latest, tz) if tz else latest)
    today_col = F.lit(today) if today is not None else F.current_date()
    explicit_start = F.lit(start).cast("date") if start else F.lit(None).cast("date")
    explicit_end = F.lit(end).cast("date") if end else F.lit(None).cast("date")
    start_col = F.coalesce(explicit_start, latest_date, F.date_sub(today_col, lookback_days))
    source = (
        F.when(explicit_start.isNotNull(), F.lit("explicit"))
        .when(latest_date.isNotNull(), F.lit("stored"))
        .otherwise(F.lit("default"))
    )
    return stored.agg(
        start_col.alias("start_date"),
        F.coalesce(explicit_end, today_col).alias("end_date"),
        source.alias("start_source"),
    )


def window_starts(start: F.Column, end: F.Column, days: int = 7, include_end: bool = False) -> F.Column:
    """Array of window start dates from ``start`` while start < end (or <= end).

    ``include_end=False`` is the reference's loop: an end date that falls
    exactly on a new window start is never loaded (m22).
    """
    last = end if include_end else F.date_sub(end, 1)
    step = F.expr(f"INTERVAL {int(days)} DAYS")
    return F.when(last >= start, F.sequence(start, last, step)).otherwise(F.array().cast("array<date>"))


def weekly_windows(ranges: DataFrame, days: int = 7, include_end: bool = False) -> DataFrame:
    """Split each (start_date, end_date) row into inclusive windows (INC2).

    Each window covers ``days`` days, the last one clipped to ``end_date``.
    Other columns of ``ranges`` (e.g. a zone) are carried to every window.
    """
    starts = window_starts(F.col("start_date"), F.col("end_date"), days, include_end)
    out = ranges.withColumn("window_start", F.explode(starts))
    return out.withColumn(
        "window_end", F.least(F.date_add("window_start", days - 1), F.col("end_date"))
    ).drop("start_date", "end_date")


def backfill_plan(zones: DataFrame, ranges: DataFrame, days: int = 7, include_end: bool = False) -> DataFrame:
    """Every zone x every window of the global range (INC3, JON4).

    The range is one row, so its window list is a scalar subquery that each
    zone row explodes: no join, and the output is exactly |zones| x |windows|.
    """
    starts = window_starts(F.col("start_date"), F.col("end_date"), days, include_end)
    window_list = ranges.select(
        F.transform(starts, lambda s: F.struct(s.alias("window_start"), F.least(F.date_add(s, days - 1), F.col("end_date")).alias("window_end")))
    ).scalar()
    return zones.select("zone", F.inline(window_list))
