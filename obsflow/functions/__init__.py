"""Column-level building blocks: pure ``Column -> Column`` expressions."""

from obsflow.functions.numeric import exact_avg, pct_rate, try_cast, try_flag
from obsflow.functions.text import geo_point, record_json, zone_path_key
from obsflow.functions.time import (
    calendar_columns,
    date_of_text,
    ingest_stamp,
    instant_to_utc_ntz,
    local_day_bounds,
    local_to_utc,
    parse_instant,
    parse_local_text,
    parse_wallclock,
    slot_start,
    utc_ntz_to_instant,
    utc_to_local,
)

__all__ = [
    "calendar_columns",
    "date_of_text",
    "exact_avg",
    "geo_point",
    "ingest_stamp",
    "instant_to_utc_ntz",
    "local_day_bounds",
    "local_to_utc",
    "parse_instant",
    "parse_local_text",
    "parse_wallclock",
    "pct_rate",
    "record_json",
    "slot_start",
    "try_cast",
    "try_flag",
    "utc_ntz_to_instant",
    "utc_to_local",
    "zone_path_key",
]
