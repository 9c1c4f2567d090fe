"""Declared schemas of every input, and the canonical column names.

Inputs are always read with a declared schema (no inference); the canonical
names below are what the operators expect after the source adapters.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# Fixed values below: the field names of the landed documents and feed
# items (they must equal the data's), in the order the data carries them.

# --- landed site pages (JSON lines, one page per line) -------------------
SITE_RECORD = StructType(
    [
        StructField("idstation", LongType()),
        StructField("nom", StringType()),
        StructField("commune", StringType()),
        StructField("lat", DoubleType()),
        StructField("lon", DoubleType()),
        StructField("nbbornettes", IntegerType()),
    ]
)
SITE_PAGE = StructType([StructField("values", ArrayType(SITE_RECORD))])

# Landed site field -> canonical site-dimension column.
SITE_FIELDS = {
    "idstation": "site_id",
    "nom": "site_name",
    "commune": "zone",
    "lat": "lat",
    "lon": "lon",
    "nbbornettes": "slots",
}

# --- raw observation item as delivered by the feed ------------------------
RAW_OBSERVATION_ITEM = StructType(
    [
        StructField("horodate", StringType()),
        StructField("number", LongType()),
        StructField("status", StringType()),
        StructField(
            "main_stands",
            StructType(
                [
                    StructField("capacity", IntegerType()),
                    StructField(
                        "availabilities",
                        StructType(
                            [
                                StructField("bikes", IntegerType()),
                                StructField("stands", IntegerType()),
                            ]
                        ),
                    ),
                ]
            ),
        ),
    ]
)

# --- landed observation, key (station_id, horodate) ----------------------
LANDED_OBSERVATION = StructType(
    [
        StructField("horodate", StringType()),
        StructField("station_id", LongType()),
        StructField("status", StringType()),
        StructField("capacity", IntegerType()),
        StructField("bikes_available", IntegerType()),
        StructField("stands_available", IntegerType()),
        StructField("raw", StringType()),
    ]
)

# --- canonical observation after the source adapter ----------------------
OBSERVATION = StructType(
    [
        StructField("site_id", LongType()),
        StructField("obs_text", StringType()),
        StructField("obs_ts", TimestampNTZType()),
        StructField("status", StringType()),
        StructField("capacity", IntegerType()),
        StructField("available", IntegerType()),
        StructField("free", IntegerType()),
    ]
)

# --- landed context series, key (commune, datetime) ----------------------
CONTEXT_MEASURES = StructType(
    [
        StructField("temperature_2m_c", DoubleType()),
        StructField("relative_humidity_2m_pct", IntegerType()),
        StructField("apparent_temperature_c", DoubleType()),
        StructField("precipitation_mm", DoubleType()),
        StructField("rain_mm", DoubleType()),
        StructField("snowfall_cm", DoubleType()),
        StructField("weather_code", IntegerType()),
        StructField("wind_speed_10m_kmh", DoubleType()),
        StructField("wind_gusts_10m_kmh", DoubleType()),
        StructField("is_day", BooleanType()),
        StructField("visibility_m", DoubleType()),
    ]
)
GEO_POINT = StructType(
    [
        StructField("type", StringType()),
        StructField("coordinates", ArrayType(DoubleType())),
    ]
)
CONTEXT = StructType(
    [
        StructField("zone", StringType()),
        StructField("location", GEO_POINT),
        StructField("ctx_ts", TimestampNTZType()),
        *CONTEXT_MEASURES.fields,
    ]
)

# The context CSV header cells and the typed column each one
# becomes, in the order the provider writes them.
CONTEXT_CSV_COLUMNS = [
    ("time", "ctx_time_text", "string"),
    ("temperature_2m (°C)", "temperature_2m_c", "double"),
    ("relative_humidity_2m (%)", "relative_humidity_2m_pct", "int"),
    ("apparent_temperature (°C)", "apparent_temperature_c", "double"),
    ("precipitation (mm)", "precipitation_mm", "double"),
    ("rain (mm)", "rain_mm", "double"),
    ("snowfall (cm)", "snowfall_cm", "double"),
    ("weather_code (wmo code)", "weather_code", "int"),
    ("wind_speed_10m (km/h)", "wind_speed_10m_kmh", "double"),
    ("wind_gusts_10m (km/h)", "wind_gusts_10m_kmh", "double"),
    ("is_day ()", "is_day", "boolean"),
    ("visibility (m)", "visibility_m", "double"),
]
# The header line starts with this cell; everything before it is preamble.
CONTEXT_CSV_HEADER_PREFIX = "time,"
