"""ENR6 through the spark-submit entry, on inputs shaped like the reference's landing."""

import datetime as dt
import json
import os

from obsflow.plans import cli

T = dt.datetime


def test_cli_runs_job_in_reference_layout(spark, tmp_dir):
    base = tmp_dir.removeprefix("file:")
    os.makedirs(f"{base}/pages/ingested_at=20240120T000000000000Z")
    page = {"values": [
        {"idstation": 1, "nom": "Place A", "commune": "Centre 1er", "lat": 45.7, "lon": 4.8, "nbbornettes": 20},
        {"idstation": 4242, "nom": "Gare", "commune": None, "lat": 45.7, "lon": 4.86, "nbbornettes": 10},
    ]}
    with open(f"{base}/pages/ingested_at=20240120T000000000000Z/p.json", "w", encoding="utf-8") as f:
        f.write(json.dumps(page) + "\n")
    landed = spark.createDataFrame(
        [
            ("2024-01-15 14:05:00+01:00", 1, "OPEN", 20, 5, 15, None),
            ("2024-01-15 13:05:00Z", 1, "OPEN", 20, 5, 15, None),  # same instant, other offset
            ("2024-01-15 14:10:00+01:00", 4242, "OPEN", 10, 2, 8, None),
            ("2024-01-15 14:10:00+01:00", 42, "OPEN", 10, 2, 8, None),  # orphan
            ("2024-01-15 14:10", 1, "OPEN", 10, 2, 8, None),  # unparsed time
        ],
        "horodate string, station_id bigint, status string, capacity int, bikes_available int, "
        "stands_available int, raw string",
    )
    landed.write.parquet(f"{tmp_dir}/obs")
    ctx = spark.createDataFrame(
        [("Centre 1er", T(2024, 1, 15, 13, 0), 4.5), ("North Quay", T(2024, 1, 15, 13, 0), 5.5)],
        "commune string, datetime timestamp, temperature_2m_c double",
    )
    ctx.write.parquet(f"{tmp_dir}/ctx")
    cfg = {
        "observations": {"kind": "landed", "format": "parquet", "path": f"{tmp_dir}/obs"},
        "sites": {"pages": f"{tmp_dir}/pages"},
        "context": {"kind": "landed", "format": "parquet", "path": f"{tmp_dir}/ctx"},
        "overrides": [[4242, "North Quay"]],
        "out": f"{tmp_dir}/out",
        "time_zone": "Europe/Paris",
        "layout": "reference",
        "orphan_on": "site_name",
    }
    with open(f"{base}/job.json", "w", encoding="utf-8") as f:
        json.dump(cfg, f)
    assert cli.main(["--config", f"{base}/job.json"], spark=spark) == 0
    rows = spark.read.parquet(f"{tmp_dir}/out/rows")
    assert {"station_id", "horodate_ts", "commune", "taux_velos_disponibles", "annee", "mois"} <= set(rows.columns)
    got = {r.station_id: r for r in rows.collect()}
    assert set(got) == {1, 4242}
    assert got[4242].commune == "North Quay" and got[4242].temperature_2m_c == 5.5
    assert got[1].temperature_2m_c == 4.5 and got[1].heure == 14
    hours = spark.read.parquet(f"{tmp_dir}/out/hours")
    assert {"nb_observations", "moy_velos_disponibles", "temperature_moyenne_c"} <= set(hours.columns)
    assert sorted(r.nb_observations for r in hours.collect()) == [1, 1]
    quality = spark.read.parquet(f"{tmp_dir}/out/quality")
    assert {"nb_lignes", "horodate_null", "station_null", "commune_null", "capacity_non_positive",
            "bikes_negatifs", "meteo_null", "taux_hors_limites"} <= set(quality.columns)


def test_cli_incremental_mode(spark, tmp_dir):
    base = tmp_dir.removeprefix("file:")
    spark.createDataFrame(
        [("2024-01-15 14:05:00+01:00", 1, "OPEN", 20, 5, 15, None)],
        "horodate string, station_id bigint, status string, capacity int, bikes_available int, stands_available int, raw string",
    ).write.parquet(f"{tmp_dir}/obs")
    spark.createDataFrame([(1, "A", "Z", 45.0, 4.0, 3)], "idstation bigint, nom string, commune string, lat double, lon double, nbbornettes int").write.parquet(f"{tmp_dir}/sites")
    spark.createDataFrame([("Z", T(2024, 1, 15, 13, 0), 4.5)], "commune string, datetime timestamp, temperature_2m_c double").write.parquet(f"{tmp_dir}/ctx")
    cfg = {
        "observations": {"kind": "landed", "format": "parquet", "path": f"{tmp_dir}/obs"},
        "sites": {"format": "parquet", "path": f"{tmp_dir}/sites"},
        "context": {"kind": "landed", "format": "parquet", "path": f"{tmp_dir}/ctx"},
        "out": f"{tmp_dir}/out",
        "mode": "incremental",
        "start": "2024-01-15",
        "end": "2024-01-15",
    }
    with open(f"{base}/job.json", "w", encoding="utf-8") as f:
        json.dump(cfg, f)
    assert cli.main(["--config", f"{base}/job.json"], spark=spark) == 0
    assert spark.read.parquet(f"{tmp_dir}/out/rows").count() == 1


def test_cli_with_csv_archive_context(spark, tmp_dir):
    import datetime as dt

    from obsflow.sinks.archive import write_context_archive

    base = tmp_dir.removeprefix("file:")
    header = (
        "time,temperature_2m (°C),relative_humidity_2m (%),apparent_temperature (°C),precipitation (mm),"
        "rain (mm),snowfall (cm),weather_code (wmo code),wind_speed_10m (km/h),wind_gusts_10m (km/h),"
        "is_day (),visibility (m)"
    )
    text = "\n".join(["lat,lon", "45.7,4.8", "", header, "2024-01-15T14:00,6.5,80,3.1,0.0,0.0,0.0,3,10.2,20.1,1,24000.0", "2024-01-15T14:15,warm,80"]) + "\n"
    texts = spark.createDataFrame([("Centre 1er", dt.date(2024, 1, 15), dt.date(2024, 1, 21), text)], "zone string, start date, end date, value string")
    write_context_archive(texts, f"{tmp_dir}/archive", "20240122T000000000000Z")
    spark.createDataFrame([("Centre 1er", 45.7, 4.8)], "zone string, lat double, lon double").write.parquet(f"{tmp_dir}/zones")
    spark.createDataFrame(
        [("2024-01-15 14:05:00+01:00", 1, "OPEN", 20, 5, 15, None)],
        "horodate string, station_id bigint, status string, capacity int, bikes_available int, stands_available int, raw string",
    ).write.parquet(f"{tmp_dir}/obs")
    spark.createDataFrame([(1, "A", "Centre 1er", 45.0, 4.0, 3)], "idstation bigint, nom string, commune string, lat double, lon double, nbbornettes int").write.parquet(f"{tmp_dir}/sites")
    cfg = {
        "observations": {"kind": "landed", "format": "parquet", "path": f"{tmp_dir}/obs"},
        "sites": {"format": "parquet", "path": f"{tmp_dir}/sites"},
        "context": {"kind": "csv_archive", "path": f"{tmp_dir}/archive", "zones": {"format": "parquet", "path": f"{tmp_dir}/zones"}},
        "out": f"{tmp_dir}/out",
    }
    with open(f"{base}/job.json", "w", encoding="utf-8") as f:
        json.dump(cfg, f)
    assert cli.main(["--config", f"{base}/job.json"], spark=spark) == 0
    row = spark.read.parquet(f"{tmp_dir}/out/rows").first()
    assert row.temperature_2m_c == 6.5 and row.zone == "Centre 1er"
    # rows read = used + quarantined, and the unreadable line is kept
    rejects = spark.read.parquet(f"{tmp_dir}/out/context_rejects").collect()
    assert [(r.line, r.zone) for r in rejects] == [("2024-01-15T14:15,warm,80", "Centre 1er")] and rejects[0].run_id


def test_cli_with_raw_lines_and_snapshots(spark, tmp_dir, capsys):
    from obsflow.plans.batch_job import published_table

    base = tmp_dir.removeprefix("file:")
    lines = [
        '{"horodate": "2024-01-15 14:05:00+01:00", "number": 1, "status": "OPEN", "main_stands": {"capacity": 20, "availabilities": {"bikes": 5, "stands": 15}}, "note": "x"}',
        "not an item",
    ]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(f"{tmp_dir}/feed")
    spark.createDataFrame([(1, "A", "Centre", 45.0, 4.0, 3)], "idstation bigint, nom string, commune string, lat double, lon double, nbbornettes int").write.parquet(f"{tmp_dir}/sites")
    spark.createDataFrame([("Centre", None, 1.5)], "zone string, ctx_ts timestamp_ntz, temperature_2m_c double").write.parquet(f"{tmp_dir}/ctx")
    cfg = {
        "observations": {"kind": "raw_lines", "path": f"{tmp_dir}/feed"},
        "sites": {"format": "parquet", "path": f"{tmp_dir}/sites"},
        "context": {"kind": "canonical", "format": "parquet", "path": f"{tmp_dir}/ctx"},
        "out": f"{tmp_dir}/out",
        "measures": ["temperature_2m_c"],
        "extra_columns": ["raw"],
        "gate_rules": [],
        "snapshots": True,
        "cluster_by": ["site_id", "obs_ts"],
    }
    with open(f"{base}/job.json", "w", encoding="utf-8") as f:
        json.dump(cfg, f)
    assert cli.main(["--config", f"{base}/job.json"], spark=spark) == 0
    assert [r.raw for r in published_table(spark, f"{tmp_dir}/out", "rows").collect()] == lines[:1]  # undeclared fields included
    assert [(r.raw, r.disposition) for r in spark.read.parquet(f"{tmp_dir}/out/rejects").collect()] == [(lines[1], "key_null")]
