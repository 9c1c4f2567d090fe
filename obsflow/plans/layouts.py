"""Published column names of the reference's datasets.

The library works with neutral names; a user switching over can publish the
row grain, the hour grain and the quality table under the names their
downstream queries already use.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Library column -> published column, row grain.
ROW_NAMES = {
    "site_id": "station_id",
    "site_name": "station_nom",
    "zone": "commune",
    "lat": "lat",
    "lon": "lon",
    "obs_ts": "horodate_ts",
    "slot_ts": "creneau_15min",
    "status": "status",
    "capacity": "capacity",
    "available": "bikes_available",
    "free": "stands_available",
    "temperature_2m_c": "temperature_2m_c",
    "apparent_temperature_c": "apparent_temperature_c",
    "relative_humidity_2m_pct": "relative_humidity_2m_pct",
    "precipitation_mm": "precipitation_mm",
    "rain_mm": "rain_mm",
    "wind_speed_10m_kmh": "wind_speed_10m_kmh",
    "weather_code": "weather_code",
    "fill_rate": "taux_velos_disponibles",
    "obs_local": "horodate_local",
    "day": "jour",
    "hour": "heure",
    "year": "annee",
    "month": "mois",
}

# Library column -> published column, station x hour grain.
HOUR_NAMES = {
    "site_id": "station_id",
    "site_name": "station_nom",
    "zone": "commune",
    "day": "jour",
    "hour": "heure",
    "n_obs": "nb_observations",
    "avg_available": "moy_velos_disponibles",
    "avg_free": "moy_places_libres",
    "avg_fill_rate": "moy_taux_velos_disponibles",
    "avg_temperature": "temperature_moyenne_c",
    "year": "annee",
    "month": "mois",
}

# Gate figure -> published quality column.
QUALITY_NAMES = {
    "n_rows": "nb_lignes",
    "time_null": "horodate_null",
    "site_name_null": "station_null",
    "zone_null": "commune_null",
    "capacity_non_positive": "capacity_non_positive",
    "available_negative": "bikes_negatifs",
    "context_null": "meteo_null",
    "fill_rate_out_of_range": "taux_hors_limites",
}

PARTITIONS = ("annee", "mois")


def publish_as(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename mapped columns to their published names; others keep theirs."""
    return df.select(*[F.col(c).alias(names.get(c, c)) for c in df.columns])


def read_as_library(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Inverse of ``publish_as``: published names back to library names."""
    back = {dst: src for src, dst in names.items()}
    return df.select(*[F.col(c).alias(back.get(c, c)) for c in df.columns])
