"""Named row rules as data (FLT2-FLT5, FLT9, DQ5-DQ7).

A rule is a name plus a predicate that is TRUE when the row breaks it. A
NULL predicate counts as "not broken", and every rule set that must catch
missing values names them explicitly, so the set of rows breaking a rule set
and the set of rows keeping it partition the input exactly, NULLs included.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    name: str
    broken: Callable[[], Column]
    blocking: bool = True

    def flag(self) -> Column:
        return F.coalesce(self.broken(), F.lit(False))


def _col(name: str) -> Callable[[], Column]:
    return lambda: F.col(name)


# Consistency of capacity and counts (the reference's anomaly filter).
CONSISTENCY_RULES: tuple[Rule, ...] = (
    Rule("capacity_null", lambda: F.col("capacity").isNull()),
    Rule("available_null", lambda: F.col("available").isNull()),
    Rule("capacity_non_positive", lambda: F.col("capacity") <= 0),
    Rule("available_negative", lambda: F.col("available") < 0),
    Rule("available_above_capacity", lambda: F.col("available") > F.col("capacity")),
)

# Rate range check (FLT4, DQ7).
RATE_RULES: tuple[Rule, ...] = (
    Rule("fill_rate_out_of_range", lambda: (F.col("fill_rate") < 0) | (F.col("fill_rate") > 100)),
)

# Final gate figures (DQ6). Coverage rules (zone, context) do not block by
# default in the driver mapping; see plans.batch_job.
GATE_RULES: tuple[Rule, ...] = (
    Rule("time_null", lambda: F.col("obs_ts").isNull()),
    Rule("site_name_null", lambda: F.col("site_name").isNull()),
    Rule("zone_null", lambda: F.col("zone").isNull()),
    Rule("capacity_non_positive", lambda: F.col("capacity") <= 0),
    Rule("available_negative", lambda: F.col("available") < 0),
    Rule("context_null", lambda: F.col("temperature_2m_c").isNull()),
    Rule("fill_rate_out_of_range", lambda: (F.col("fill_rate") < 0) | (F.col("fill_rate") > 100)),
)


def with_reasons(df: DataFrame, rules: Sequence[Rule], out: str = "reasons") -> DataFrame:
    """Add an array of the names of the rules each row breaks (empty if none)."""
    names = [F.when(r.flag(), F.lit(r.name)) for r in rules]
    return df.withColumn(out, F.array_compact(F.array(*names)))


def breaks_any(rules: Sequence[Rule]) -> Column:
    """TRUE when the row breaks at least one rule; never NULL."""
    flag = F.lit(False)
    for r in rules:
        flag = flag | r.flag()
    return flag


def split_by_rules(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(kept, broken): exact complements of each other (FLT2, FLT3)."""
    bad = breaks_any(rules)
    return df.filter(~bad), df.filter(bad)


def rule_counts(rules: Sequence[Rule], prefix: str = "", where: Column | None = None) -> list[Column]:
    """One ``count_if`` per rule; 0, not NULL, over zero rows (m13)."""
    cond = (lambda c: c) if where is None else (lambda c: where & c)
    return [F.count_if(cond(r.flag())).alias(f"{prefix}{r.name}") for r in rules]


def null_key_rule(keys: Sequence[str]) -> Rule:
    """Rows whose key has a NULL part (FLT9)."""

    def broken() -> Column:
        flag = F.lit(False)
        for k in keys:
            flag = flag | F.col(k).isNull()
        return flag

    return Rule("key_part_null", broken)


def quarantine_null_keys(df: DataFrame, keys: Sequence[str], strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) on NULL key parts (FLT9, m19).

    ``strict=True`` reproduces the reference: a single NULL key part fails
    the whole batch, raised inside the job by ``raise_error`` so that no
    driver-side check or extra action is needed.
    """
    rule = null_key_rule(keys)
    if strict:
        msg = F.lit(f"NULL key part in {list(keys)}")
        # A filter, not a dropped column: Catalyst would prune an unused column.
        guard = F.when(rule.flag(), F.raise_error(msg).cast("boolean")).otherwise(F.lit(True))
        return df.filter(guard), df.filter(F.lit(False))
    return df.filter(~rule.flag()), df.filter(rule.flag())
