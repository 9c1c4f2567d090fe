"""Roll-ups (AGG2, ENR5) and ordered previews (SRT1-SRT3, AGG8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.functions.numeric import exact_avg

SITE_HOUR_KEYS = ("site_id", "site_name", "zone", "year", "month", "day", "hour")
ZONE_HOUR_KEYS = ("zone", "year", "month", "day", "hour")


def hourly_rollup(
    df: DataFrame,
    keys: Sequence[str] = SITE_HOUR_KEYS,
    temperature_col: str = "temperature_2m_c",
) -> DataFrame:
    """Count and 2-decimal means per group (AGG2, ENR5).

    ``n_obs`` counts every row, the means skip NULLs (m11); the rate mean is
    the mean of the already rounded rate (m10). Means are exact decimals, so
    the result does not depend on partitioning. The group keys are the
    local calendar fields, so the two UTC hours of the autumn change share
    one local hour (m8). Partial aggregation runs before the shuffle.
    """
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_obs"),
        exact_avg("available").alias("avg_available"),
        exact_avg("free").alias("avg_free"),
        exact_avg("fill_rate").alias("avg_fill_rate"),
        exact_avg(temperature_col).alias("avg_temperature"),
    )


def top_n(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """First ``n`` rows by ``order`` ascending (SRT1): planned as a top-k."""
    return df.orderBy(*order).limit(n)


def latest_row(df: DataFrame, ts_col: str = "obs_ts", tie_break: Sequence[str] = ()) -> DataFrame:
    """The single latest row (SRT3), ties broken by ``tie_break`` descending."""
    order = [F.col(ts_col).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in tie_break]]
    return df.orderBy(*order).limit(1)


def latest_time(df: DataFrame, ts_col: str = "obs_ts") -> DataFrame:
    """Maximum time over the frame (AGG8): a partial/final aggregate, one row."""
    return df.agg(F.max(ts_col).alias("latest_ts"))
