"""FLT2-FLT5, FLT9, DQ1-DQ8, AGG1, AGG6 (traps m11-m15, m19)."""

import pytest
from pyspark.sql import functions as F

from obsflow.operators import quality
from obsflow.operators.rules import (
    CONSISTENCY_RULES,
    GATE_RULES,
    quarantine_null_keys,
    split_by_rules,
    with_reasons,
)

CAP = "id int, capacity int, available int"
CASES = [
    (1, None, 3),  # capacity null
    (2, 0, 0),  # capacity 0
    (3, -1, 0),  # capacity negative
    (4, 5, 5),  # available equal to capacity: valid
    (5, 5, None),  # available null
    (6, 5, -1),  # available negative
    (7, 5, 6),  # available above capacity
    (8, 10, 3),  # valid
]


def test_flt2_flt3_are_exact_complements_with_nulls(spark):
    df = spark.createDataFrame(CASES, CAP)
    kept, broken = split_by_rules(df, CONSISTENCY_RULES)
    k, b = {r.id for r in kept.collect()}, {r.id for r in broken.collect()}
    assert k == {4, 8}
    assert b == {1, 2, 3, 5, 6, 7}
    assert k | b == {c[0] for c in CASES} and not (k & b)


def test_flt2_reasons(spark):
    df = with_reasons(spark.createDataFrame(CASES, CAP), CONSISTENCY_RULES)
    got = {r.id: r.reasons for r in df.collect()}
    assert got[1] == ["capacity_null"]
    assert got[3] == ["capacity_non_positive", "available_above_capacity"]  # 0 > -1
    assert got[5] == ["available_null"]
    assert got[7] == ["available_above_capacity"]
    assert got[8] == []


def _gate_frame(spark, rows):
    return spark.createDataFrame(
        rows,
        "obs_ts timestamp_ntz, site_name string, zone string, capacity int, available int, "
        "temperature_2m_c double, fill_rate double",
    )


def test_dq6_gate_over_empty_input_gives_zeros(spark):
    out = quality.quality_gate(_gate_frame(spark, []), GATE_RULES).first()
    assert out.n_rows == 0
    assert all(out[r.name] == 0 for r in GATE_RULES)  # 0, not NULL (m13)
    assert out.passed is True


def test_dq6_gate_counts_and_verdict(spark):
    import datetime as dt

    t = dt.datetime(2024, 1, 1)
    rows = [(t, "A", "Z", 10, 5, 1.0, 50.0), (None, "B", None, 0, -1, None, 120.0)]
    out = quality.quality_gate(_gate_frame(spark, rows), GATE_RULES).first()
    assert out.n_rows == 2 and out.time_null == 1 and out.zone_null == 1
    assert out.fill_rate_out_of_range == 1 and out.passed is False
    verdict = quality.gate_verdict(out.asDict(), GATE_RULES)
    assert not verdict["passed"] and "time_null" in verdict["failed_rules"]


def test_dq1_dq3_reports(spark):
    df = spark.createDataFrame(
        [(1, False, None), (1, False, None), (None, False, None), (2, True, "Z"), (3, False, "Z")],
        "site_id int, is_orphan boolean, zone string",
    )
    jq = quality.join_quality(df).first()
    assert (jq.n_rows, jq.n_matched, jq.n_orphans) == (5, 4, 1)
    rep = quality.null_attribute_report(df, "zone").first()
    # NULL site counted as one distinct value, as distinct().count() does (m12).
    assert (rep.n_rows, rep.n_sites) == (3, 2)
    empty = quality.null_attribute_report(df.filter(F.lit(False)), "zone").first()
    assert (empty.n_rows, empty.n_sites) == (0, 0)


def test_flt9_null_key_quarantine_and_strict(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (2, None)], "k1 int, k2 string")
    ok, bad = quarantine_null_keys(df, ["k1", "k2"])
    assert ok.count() == 1 and bad.count() == 2
    strict, _ = quarantine_null_keys(df, ["k1", "k2"], strict=True)
    with pytest.raises(Exception, match="NULL key part"):
        strict.count()
    fine, _ = quarantine_null_keys(df.filter("k1 = 1"), ["k1", "k2"], strict=True)
    assert fine.count() == 1


def test_dq8_reconciliation_identities(spark):
    df = spark.createDataFrame([(10, 7, 3, 2, 5)], "r int, m int, o int, a int, f int")
    c = F.col
    out = df.select(*quality.reconciliation(c("r"), c("m"), c("o"), c("a"), c("f"))).first()
    assert out[0] is True and out[1] is True
