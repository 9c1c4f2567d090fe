"""Many-to-one joins and the fan-out guard (m17)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_by(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key; the survivor is the greatest by ``order`` then all columns.

    Used on dimension and context inputs before a many-to-one join so that a
    duplicated key cannot multiply fact rows (m17). Map-side partial
    aggregation collapses copies before the shuffle. These sides are small,
    so the survivor is the plainly explainable greatest row.
    """
    from obsflow.operators.dedup import dedup_latest

    return dedup_latest(df, keys, order)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their multiplicity."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def require_unique(df: DataFrame, keys: Sequence[str], what: str) -> None:
    """Fail when ``keys`` repeat in ``df`` (m17, strict mode).

    One aggregate over the (small) side; only whether a duplicate exists
    reaches the driver.
    """
    if duplicate_keys(df, keys).limit(1).count() > 0:
        raise ValueError(f"{what}: duplicate keys on {list(keys)}; joining would multiply fact rows")


def many_to_one_join(
    facts: DataFrame, side: DataFrame, fact_keys: Sequence[str], side_keys: Sequence[str], how: str = "left"
) -> DataFrame:
    """Join facts to a side that is unique on ``side_keys``.

    No hint and no size check of our own: building the frame runs no job and
    reads nothing. Spark broadcasts the side when its size, known from the
    files of a written table or measured by AQE once the side's stage has run,
    is below ``spark.sql.autoBroadcastJoinThreshold``; else both sides are
    shuffled and AQE splits a partition that a hot key makes too large. The
    side's key columns are dropped from the result (the fact keys remain).
    """
    renamed = {s: f"__side_{i}" for i, s in enumerate(side_keys)}
    r = side.withColumnsRenamed(renamed)
    cond = [F.col(fk) == F.col(renamed[sk]) for fk, sk in zip(fact_keys, side_keys, strict=True)]
    return facts.join(r, cond, how).drop(*renamed.values())
