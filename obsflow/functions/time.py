"""Time expressions (FN1-FN7, FN13, FN15, FN16, FN19).

Convention: every time column the library produces is TIMESTAMP_NTZ holding
the UTC wall clock ("UTC NTZ"). All arithmetic below is integer arithmetic on
microseconds since the epoch, so nothing depends on the session time zone,
pre-1970 values floor correctly, and no text round trip is involved (m6).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The observation time text format of the landed feed, e.g.
# "2024-09-01 14:05:00+02:00" or "2024-09-01 12:05:00Z".
OBS_TIME_PATTERN = "yyyy-MM-dd HH:mm:ssXXX"
# Context series local time text, e.g. "2024-09-01T14:00".
CONTEXT_TIME_PATTERN = "yyyy-MM-dd'T'HH:mm"
# Ingestion stamp used in archive paths, e.g. "20240901T120500123456Z".
INGEST_STAMP_PATTERN = "yyyyMMdd'T'HHmmssSSSSSS'Z'"

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_micros_ntz(col: str | Column) -> Column:
    """Microseconds between the NTZ epoch and a TIMESTAMP_NTZ value."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), _c(col))


def ntz_from_epoch_micros(micros: Column) -> Column:
    """TIMESTAMP_NTZ at ``micros`` after the NTZ epoch."""
    return F.timestamp_add("MICROSECOND", micros, F.expr(_EPOCH_NTZ))


def instant_to_utc_ntz(col: str | Column) -> Column:
    """TIMESTAMP (instant) -> its UTC wall clock as TIMESTAMP_NTZ.

    Goes through epoch microseconds, so the session zone plays no part.
    """
    return ntz_from_epoch_micros(F.unix_micros(_c(col)))


def utc_ntz_to_instant(col: str | Column) -> Column:
    """UTC wall clock (TIMESTAMP_NTZ) -> TIMESTAMP instant."""
    return F.timestamp_micros(epoch_micros_ntz(col))


def parse_instant(col: str | Column, pattern: str = OBS_TIME_PATTERN, also: Sequence[str] = ()) -> Column:
    """Time text with an explicit offset -> UTC NTZ (FN1, m1).

    ``try_to_timestamp`` gives NULL for text that does not match the pattern
    (missing offset, ``+02``, fractional seconds, garbage) instead of failing
    the whole job under ANSI mode; callers count and quarantine the NULLs.
    ``also`` lists further patterns tried in order (e.g. with fractional
    seconds) for feeds that are known to vary.
    """
    parsed = [F.try_to_timestamp(_c(col), F.lit(p)) for p in (pattern, *also)]
    return instant_to_utc_ntz(F.coalesce(*parsed) if len(parsed) > 1 else parsed[0])


def slot_start(col: str | Column, minutes: int = 15) -> Column:
    """Floor a UTC NTZ time to its slot of ``minutes`` (FN2-FN5, m6).

    Equivalent to floor(epoch / step) * step, done on integer microseconds
    with ``pmod`` so instants before 1970 floor downwards too. Unlike
    ``window()``, it keeps rows whose time is NULL (window adds a NOT NULL
    filter).
    """
    step = int(minutes) * 60 * 1_000_000
    micros = epoch_micros_ntz(col)
    return ntz_from_epoch_micros(micros - F.pmod(micros, F.lit(step)))


def utc_to_local(col: str | Column, tz: str) -> Column:
    """UTC NTZ -> local wall clock NTZ in ``tz`` (FN6, m7)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), _c(col))


def local_to_utc(col: str | Column, tz: str) -> Column:
    """Local wall clock NTZ in ``tz`` -> UTC NTZ (FN13, m9).

    Ambiguous autumn times take the earlier (summer) offset; times inside the
    spring gap move forward by the gap, as a zone-aware local datetime does.
    """
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), _c(col))


def local_day_bounds(start: str, end: str, tz: str) -> tuple[Column, Column]:
    """UTC NTZ instants [first, last) of the inclusive local dates
    ``start``..``end`` in ``tz``. Both fold to literals, so a filter on them
    reaches the scan."""
    first = F.lit(str(start)).cast("date").cast("timestamp_ntz")
    after = F.date_add(F.lit(str(end)).cast("date"), 1).cast("timestamp_ntz")
    return local_to_utc(first, tz), local_to_utc(after, tz)


def parse_wallclock(col: str | Column, pattern: str) -> Column:
    """Time text without offset -> the same wall clock as TIMESTAMP_NTZ.

    NULL when malformed. The text is read as UTC (a ``Z`` is appended) and
    brought back through epoch microseconds, so the session zone is unused.
    """
    text = F.concat(_c(col), F.lit("Z"))
    return instant_to_utc_ntz(F.try_to_timestamp(text, F.lit(pattern + "XXX")))


def parse_local_text(col: str | Column, tz: str, pattern: str = CONTEXT_TIME_PATTERN) -> Column:
    """Local time text (no offset) in ``tz`` -> UTC NTZ, NULL when malformed."""
    return local_to_utc(parse_wallclock(col, pattern), tz)


def calendar_columns(local_col: str | Column) -> dict[str, Column]:
    """Year, month, day of month and hour of a local wall clock (FN7)."""
    c = _c(local_col)
    return {
        "year": F.year(c),
        "month": F.month(c),
        "day": F.dayofmonth(c),
        "hour": F.hour(c),
    }


def date_of_text(col: str | Column) -> Column:
    """Date part of a "yyyy-MM-dd ..." time text (FN15), NULL when malformed."""
    return F.try_to_date(F.split_part(_c(col), F.lit(" "), F.lit(1)), "yyyy-MM-dd")


def ingest_stamp(col: str | Column) -> Column:
    """UTC NTZ -> ingestion stamp text used in archive paths (FN19)."""
    return F.date_format(_c(col), INGEST_STAMP_PATTERN)
