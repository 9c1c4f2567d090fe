"""Keyed merge of a batch into a table (SNK3, SNK4, INC4, m19, m20)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsflow.operators.dedup import dedup_latest
from obsflow.operators.rules import quarantine_null_keys

_IN = "__in_"
_E = "__exists"
_I = "__incoming"

# Change labels written to the ``change`` column.
INSERTED, UPDATED, UNCHANGED, KEPT = "inserted", "updated", "unchanged", "kept"


def keyed_merge(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    batch_order: Sequence[str] = (),
    on_null_key: str = "quarantine",
) -> DataFrame:
    """Upsert ``incoming`` into ``existing`` by ``keys``; label every row.

    - Only the columns ``incoming`` supplies are overwritten, NULLs included;
      the other columns of a matched row keep their stored values, and a new
      row has NULL there (m20).
    - Incoming rows are first reduced to one per key, deterministically
      (greatest by ``batch_order`` then by all columns), so the result never
      depends on arrival order.
    - Incoming rows with a NULL key part cannot be matched (m19). With
      ``on_null_key="quarantine"`` they are left out of the merge (get them
      with ``rules.quarantine_null_keys``); with ``"raise"`` the job fails
      as the reference's loader does.
    The result has every column of ``existing`` followed by the new columns
    of ``incoming``, plus ``change`` in {inserted, updated, unchanged, kept}.
    One full outer join, shuffling both sides on the key.
    """
    keys = list(keys)
    if on_null_key not in ("quarantine", "raise"):
        raise ValueError(f"on_null_key must be 'quarantine' or 'raise', not {on_null_key!r}")
    incoming, _ = quarantine_null_keys(incoming, keys, strict=on_null_key == "raise")
    inc = dedup_latest(incoming, keys, batch_order)
    supplied = [c for c in inc.columns if c not in keys]
    new_cols = [c for c in supplied if c not in existing.columns]
    e = existing.withColumn(_E, F.lit(True))
    i = inc.select(*keys, *[F.col(c).alias(_IN + c) for c in supplied], F.lit(True).alias(_I))
    j = e.join(i, keys, "full")
    matched = F.col(_E).isNotNull() & F.col(_I).isNotNull()

    def value(c: str) -> Column:
        if c in supplied:
            return F.when(F.col(_I).isNotNull(), F.col(_IN + c)).otherwise(F.col(c)).alias(c)
        return F.col(c)

    same: Column = F.lit(True)
    for c in supplied:
        if c in existing.columns:
            same = same & F.col(c).eqNullSafe(F.col(_IN + c))
        else:
            same = same & F.col(_IN + c).isNull()
    change = (
        F.when(matched & same, F.lit(UNCHANGED))
        .when(matched, F.lit(UPDATED))
        .when(F.col(_I).isNotNull(), F.lit(INSERTED))
        .otherwise(F.lit(KEPT))
    )
    cols = [value(c) for c in existing.columns] + [F.col(_IN + c).alias(c) for c in new_cols]
    return j.select(*cols, change.alias("change"))


def change_counts() -> list[Column]:
    """Inserted, updated, unchanged, kept and total rows, as aggregates."""
    return [
        F.count_if(F.col("change") == INSERTED).alias("n_inserted"),
        F.count_if(F.col("change") == UPDATED).alias("n_updated"),
        F.count_if(F.col("change") == UNCHANGED).alias("n_unchanged"),
        F.count_if(F.col("change") == KEPT).alias("n_kept"),
        F.count(F.lit(1)).alias("n_rows"),
    ]


def merge_counts(merged: DataFrame) -> DataFrame:
    """One row: inserted, updated, unchanged, kept and total rows."""
    return merged.agg(*change_counts())
