"""FN1-FN7, FN13, FN15: parsing, slots, zones (traps m1, m6-m9)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from obsflow.functions.time import (
    calendar_columns,
    date_of_text,
    local_to_utc,
    parse_instant,
    parse_local_text,
    slot_start,
    utc_to_local,
)

T = dt.datetime


def one_col(spark, values, ddl):
    return spark.createDataFrame([(v,) for v in values], ddl)


def test_fn1_parse_instant_offsets_and_garbage(spark):
    texts = [
        "2024-03-31 01:30:00+02:00",
        "2024-03-31 01:30:00Z",
        "2024-03-31 01:30:00+02",
        "2024-03-31 01:30:00",
        "2024-03-31 01:30:00.123+00:00",
        "garbage",
        None,
        "1969-12-31 23:59:59Z",
    ]
    out = one_col(spark, texts, "t string").select(parse_instant("t").alias("ts")).collect()
    got = [r.ts for r in out]
    assert got == [
        T(2024, 3, 30, 23, 30),
        T(2024, 3, 31, 1, 30),
        None,
        None,
        None,
        None,
        None,
        T(1969, 12, 31, 23, 59, 59),
    ]


def test_fn1_result_is_ntz(spark):
    df = one_col(spark, ["2024-01-01 00:00:00Z"], "t string").select(parse_instant("t").alias("ts"))
    assert df.schema["ts"].dataType.simpleString() == "timestamp_ntz"


@pytest.mark.parametrize(
    "ts,slot",
    [
        (T(2024, 1, 1, 10, 0, 0), T(2024, 1, 1, 10, 0)),
        (T(2024, 1, 1, 10, 14, 59, 999999), T(2024, 1, 1, 10, 0)),
        (T(2024, 1, 1, 10, 15, 0), T(2024, 1, 1, 10, 15)),
        (T(1969, 12, 31, 23, 59, 59), T(1969, 12, 31, 23, 45)),
        (T(1900, 1, 1, 0, 7), T(1900, 1, 1, 0, 0)),
    ],
)
def test_fn4_slot_boundaries_and_pre_1970(spark, ts, slot):
    df = spark.createDataFrame([(ts,)], "ts timestamp_ntz")
    assert df.select(slot_start("ts", 15).alias("s")).first().s == slot


def test_fn4_slot_keeps_null_rows(spark):
    df = spark.createDataFrame([(None,), (T(2024, 1, 1, 0, 20),)], "ts timestamp_ntz")
    out = df.select(slot_start("ts").alias("s")).collect()
    assert len(out) == 2 and out[0].s is None


def test_fn4_slot_other_lengths(spark):
    df = spark.createDataFrame([(T(2024, 1, 1, 10, 59),)], "ts timestamp_ntz")
    assert df.select(slot_start("ts", 60).alias("s")).first().s == T(2024, 1, 1, 10, 0)
    assert df.select(slot_start("ts", 5).alias("s")).first().s == T(2024, 1, 1, 10, 55)


def test_fn6_local_time_across_dst_and_new_year(spark):
    rows = [
        (T(2024, 3, 31, 0, 59),),  # before spring change: +1
        (T(2024, 3, 31, 1, 0),),  # after: +2
        (T(2024, 10, 27, 0, 30),),  # autumn, first 02:30
        (T(2024, 10, 27, 1, 30),),  # autumn, second 02:30 (m8)
        (T(2024, 12, 31, 23, 30),),  # local year changes
    ]
    df = spark.createDataFrame(rows, "ts timestamp_ntz").select(utc_to_local("ts", "Europe/Paris").alias("l"))
    got = [r.l for r in df.collect()]
    assert got == [
        T(2024, 3, 31, 1, 59),
        T(2024, 3, 31, 3, 0),
        T(2024, 10, 27, 2, 30),
        T(2024, 10, 27, 2, 30),
        T(2025, 1, 1, 0, 30),
    ]


def test_fn7_calendar_of_new_years_eve(spark):
    df = spark.createDataFrame([(T(2024, 12, 31, 23, 30),)], "ts timestamp_ntz")
    local = utc_to_local("ts", "Europe/Paris")
    r = df.select(*[c.alias(k) for k, c in calendar_columns(local).items()]).first()
    assert (r.year, r.month, r.day, r.hour) == (2025, 1, 1, 0)


def test_fn13_local_to_utc_ambiguous_and_gap(spark):
    rows = [(T(2024, 10, 27, 2, 30),), (T(2024, 3, 31, 2, 30),), (T(2024, 7, 1, 12, 0),)]
    df = spark.createDataFrame(rows, "l timestamp_ntz").select(local_to_utc("l", "Europe/Paris").alias("u"))
    got = [r.u for r in df.collect()]
    # Ambiguous: earlier (summer) offset; gap: moved forward by the gap (m9).
    assert got == [T(2024, 10, 27, 0, 30), T(2024, 3, 31, 1, 30), T(2024, 7, 1, 10, 0)]


def test_fn13_parse_local_text(spark):
    df = one_col(spark, ["2024-01-15T14:15", "2024-01-15 14:15", ""], "t string")
    got = [r.u for r in df.select(parse_local_text("t", "Europe/Paris").alias("u")).collect()]
    assert got == [T(2024, 1, 15, 13, 15), None, None]


def test_fn15_date_of_text(spark):
    df = one_col(spark, ["2024-09-01 12:00:00+02:00", "bad", None], "t string")
    got = [r.d for r in df.select(date_of_text("t").alias("d")).collect()]
    assert got == [dt.date(2024, 9, 1), None, None]


def test_session_zone_does_not_change_results(spark):
    texts = ["2024-10-27 02:30:00+02:00", "2024-10-27 02:30:00+01:00", "2024-03-31 03:30:00+02:00"]
    df = one_col(spark, texts, "t string")

    def run():
        ts = parse_instant("t")
        local = utc_to_local(ts, "Europe/Paris")
        return [tuple(r) for r in df.select(ts, slot_start(ts), local, F.hour(local)).collect()]

    before = run()
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        after = run()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert before == after


def test_fn19_ingest_stamp(spark):
    from obsflow.functions.time import ingest_stamp

    df = spark.createDataFrame([(T(2024, 9, 1, 12, 5, 0, 123456),)], "ts timestamp_ntz")
    assert df.select(ingest_stamp("ts").alias("s")).first().s == "20240901T120500123456Z"


def test_fn1_extra_patterns_tried_in_order(spark):
    df = one_col(spark, ["2024-03-31 01:30:00.123+00:00", "2024-03-31 01:30:00Z", "bad"], "t string")
    got = [r.ts for r in df.select(parse_instant("t", also=["yyyy-MM-dd HH:mm:ss.SSSXXX"]).alias("ts")).collect()]
    assert got == [T(2024, 3, 31, 1, 30, 0, 123000), T(2024, 3, 31, 1, 30), None]
