"""SRC1, SRC3, SRC5-SRC7, PRJ1, PRJ5-PRJ8, FN14, FN18, SNK1, SNK5, SNK6 (m18, m23-m25)."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from obsflow.functions.text import geo_point, zone_path_key
from obsflow.operators.reshape import concat_frames, explode_records, flatten_items, non_empty_pages
from obsflow.schemas import RAW_OBSERVATION_ITEM, SITE_PAGE
from obsflow.sinks.archive import write_context_archive, write_page_snapshot
from obsflow.sinks.parquet import read_back, write_partitioned
from obsflow.sources.context_csv import context_from_texts, read_texts, split_text, typed_measures
from obsflow.sources.pages import page_report, read_pages, read_sites, sites_from_pages

T = dt.datetime
HEADER = (
    "time,temperature_2m (°C),relative_humidity_2m (%),apparent_temperature (°C),precipitation (mm),"
    "rain (mm),snowfall (cm),weather_code (wmo code),wind_speed_10m (km/h),wind_gusts_10m (km/h),"
    "is_day (),visibility (m)"
)


def _local(path):
    return path.removeprefix("file:")


def test_prj1_flt8_pages_with_empty_and_null_values(spark):
    pages = spark.createDataFrame(
        [
            ([(1, "A", "Z", 45.0, 4.0, 10), (2, "B", None, 45.1, 4.1, 12)],),
            ([],),
            (None,),
        ],
        SITE_PAGE,
    )
    assert non_empty_pages(pages).count() == 1
    recs = explode_records(pages)
    assert recs.count() == 2
    assert sites_from_pages(pages).columns == ["site_id", "site_name", "zone", "lat", "lon", "slots"]


def test_src1_src7_json_pages_corrupt_lines_and_latest_snapshot(spark, tmp_dir):
    old = os.path.join(_local(tmp_dir), "ingested_at=20240101T000000000000Z")
    new = os.path.join(_local(tmp_dir), "ingested_at=20240201T000000000000Z")
    os.makedirs(old)
    os.makedirs(new)
    page = {"values": [{"idstation": 1, "nom": "Grand Place", "commune": "Centre 1er", "lat": 45.7, "lon": 4.8, "nbbornettes": 20}]}
    with open(os.path.join(old, "p.json"), "w", encoding="utf-8") as f:
        f.write(json.dumps({"values": [{"idstation": 9, "nom": "Old"}]}) + "\n")
    with open(os.path.join(new, "p.json"), "w", encoding="utf-8") as f:
        f.write(json.dumps(page, ensure_ascii=False) + "\n{not json\n" + json.dumps({"values": []}) + "\n")
    raw = read_pages(spark, tmp_dir)
    # Spark refuses queries over the corrupt column alone: read it with data.
    bad = [r for r in raw.select("values", "_corrupt_record").collect() if r._corrupt_record]
    assert len(bad) == 1
    with pytest.raises(Exception, match="malformed site page"):  # not a silent loss of a page of sites
        read_sites(spark, tmp_dir).collect()
    sites = read_sites(spark, tmp_dir, on_malformed="skip").collect()
    assert [(r.site_id, r.site_name) for r in sites] == [(1, "Grand Place")]
    assert page_report(raw).first().asDict() == {"n_pages": 4, "n_malformed": 1, "n_empty": 1, "n_records": 2}


def test_src5_quoted_cells(spark):
    from obsflow.sources.context_csv import split_text

    text = 'preamble\ntime,"note, long",x\n2024-01-01T00:00,"a, ""b"" c",1\n2024-01-01T00:15,"open,2\n2024-01-01T00:30,plain,3\n'
    rows = split_text(spark.createDataFrame([(text,)], "value string")).collect()
    assert [r.cells for r in rows] == [
        {"time": "2024-01-01T00:00", "note, long": 'a, "b" c', "x": "1"},
        None,  # an unbalanced quote
        {"time": "2024-01-01T00:30", "note, long": "plain", "x": "3"},
    ]


def test_prj6_the_whole_line_is_kept(spark):
    from obsflow.operators.reshape import items_from_lines

    lines = ['{"number": 7, "horodate": "2024-09-01 14:00:00+02:00", "extra": {"a": [1, 2]}}', "{not json", "  "]
    got = flatten_items(items_from_lines(spark.createDataFrame([(x,) for x in lines], "value string"))).collect()
    assert [(r.site_id, r.raw) for r in got] == [(7, lines[0]), (None, lines[1])]


def test_snk5_page_snapshot_roundtrip(spark, tmp_dir):
    pages = spark.createDataFrame([([(1, "A", "Z", 45.0, 4.0, 10)],), ([],)], SITE_PAGE)
    write_page_snapshot(pages, tmp_dir, "20240301T000000000000Z")
    assert [r.site_id for r in read_sites(spark, tmp_dir).collect()] == [1]


def test_prj5_prj6_flatten_nested_items(spark):
    items = spark.createDataFrame(
        [
            ("2024-09-01 14:00:00+02:00", 7, "OPEN", (20, (5, 15))),
            ("2024-09-01 14:00:00+02:00", 8, "OPEN", None),  # no main_stands (m18)
            ("2024-09-01 14:00:00+02:00", 9, "OPEN", (20, None)),
        ],
        RAW_OBSERVATION_ITEM,
    )
    out = {r.site_id: r for r in flatten_items(items).collect()}
    assert (out[7].capacity, out[7].available, out[7].free) == (20, 5, 15)
    assert out[8].capacity is None and out[8].available is None
    assert out[9].capacity == 20 and out[9].available is None
    assert out[7].obs_ts == T(2024, 9, 1, 12, 0)
    assert json.loads(out[7].raw)["main_stands"]["availabilities"]["bikes"] == 5


def test_prj7_geo_point_lon_first(spark):
    df = spark.createDataFrame([(45.7, 4.8)], "lat double, lon double")
    r = df.select(F.to_json(geo_point("lon", "lat")).alias("g")).first()
    assert json.loads(r.g) == {"type": "Point", "coordinates": [4.8, 45.7]}


def test_prj10_concat_frames(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([(2, 3)], "k int, b int")
    assert concat_frames([a, b]).columns == ["k", "a", "b"]


def test_fn18_zone_path_key(spark):
    df = spark.createDataFrame([("Centre 1er Quartier",), ("A/B",), ("Sainte-Anne-lès-Bois",), ("x_y",)], "z string")
    got = [r.k for r in df.select(zone_path_key("z").alias("k")).collect()]
    assert got == ["Centre_1er_Quartier", "A-B", "Sainte-Anne-lès-Bois", "x_y"]


def _csv(lines, crlf=False):
    sep = "\r\n" if crlf else "\n"
    return sep.join(lines)


def test_src5_csv_preamble_header_blank_crlf_empty_cell(spark):
    good = _csv(
        [
            "latitude,longitude,elevation",
            "45.7,4.8,170.0",
            "",
            HEADER,
            "2024-01-15T14:00,5.5,80,3.1,0.0,0.0,0.0,3,10.2,20.1,1,24000.0",
            "2024-01-15T14:15,,81,3.0,0.1,0.1,0.0,bad,10.0,19.0,0,23000.0",
            "",
        ],
        crlf=True,
    )
    no_header = _csv(["just,text", "1,2"])
    texts = spark.createDataFrame([("g", good), ("n", no_header)], "name string, value string")
    rows = split_text(texts).withColumns(typed_measures("cells")).collect()
    by_name = {}
    for r in rows:
        by_name.setdefault(r.name, []).append(r)
    assert len(by_name["g"]) == 2  # blank lines skipped
    first, second = sorted(by_name["g"], key=lambda r: r.line_no)
    assert first.temperature_2m_c == 5.5 and first.is_day is True and first.weather_code == 3
    assert second.temperature_2m_c is None and second.weather_code is None  # m23: cell-level NULL
    assert second.relative_humidity_2m_pct == 81 and second.is_day is False
    assert len(by_name["n"]) == 1 and by_name["n"][0].header_found is False and by_name["n"][0].cells is None


def test_snk6_src6_archive_roundtrip_with_lossy_zone_key(spark, tmp_dir):
    text = _csv(["meta", HEADER, "2024-01-15T14:00,5.5,80,3.1,0.0,0.0,0.0,3,10.2,20.1,1,24000.0"]) + "\n"
    texts = spark.createDataFrame(
        [("Centre 1er Quartier", dt.date(2024, 1, 15), dt.date(2024, 1, 21), text)],
        "zone string, start date, end date, value string",
    )
    write_context_archive(texts, tmp_dir, "20240122T000000000000Z")
    zones = spark.createDataFrame([("Centre 1er Quartier", 45.77, 4.83)], "zone string, lat double, lon double")
    ctx = context_from_texts(read_texts(spark, tmp_dir), "Europe/Paris", zones).collect()
    assert len(ctx) == 1
    r = ctx[0]
    assert r.zone == "Centre 1er Quartier" and r.ctx_ts == T(2024, 1, 15, 13, 0)
    assert r.location.coordinates == [4.83, 45.77]
    assert r.start == dt.date(2024, 1, 15) and r.ingested_at == "20240122T000000000000Z" and r.row_ok


def test_snk1_dynamic_overwrite_touches_one_month(spark, tmp_dir):
    df = spark.createDataFrame([(2024, 1, "a"), (2024, 2, "b")], "year int, month int, v string")
    write_partitioned(df, tmp_dir, ["year", "month"])
    write_partitioned(spark.createDataFrame([(2024, 2, "c")], "year int, month int, v string"), tmp_dir, ["year", "month"])
    got = sorted((r.month, r.v) for r in spark.read.parquet(tmp_dir).collect())
    assert got == [(1, "a"), (2, "c")]  # m25: January survives
    back = read_back(spark, tmp_dir, F.col("month") == 2)
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and back.count() == 1


def test_src2_src4_format_neutral_loader_and_append(spark, tmp_dir):
    from obsflow.sinks.parquet import append, preview, verify_count
    from obsflow.sources.store import load_table

    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    append(df, tmp_dir)
    append(df, tmp_dir)  # SNK4: no key, rows accumulate
    back = load_table(spark, "parquet", df.schema, tmp_dir, {"mergeSchema": "false"})
    assert back.count() == 4
    assert verify_count(spark, tmp_dir, 4)["ok"]
    assert [r.k for r in preview(back, 3, ["k"]).collect()] == [1, 1, 2]


def test_layout_names(spark):
    from obsflow.plans.layouts import HOUR_NAMES, publish_as

    from obsflow.plans.layouts import read_as_library

    df = spark.createDataFrame([(1, "A", 3, 0)], "site_id int, site_name string, n_obs int, other int")
    pub = publish_as(df, HOUR_NAMES)
    assert pub.columns == ["station_id", "station_nom", "nb_observations", "other"]
    assert read_as_library(pub, HOUR_NAMES).columns == df.columns


def test_m23_bad_cell_quarantines_row_empty_cell_does_not(spark):
    text = _csv(
        [
            HEADER,
            "2024-01-15T14:00,,80,3.1,0.0,0.0,0.0,3,10.2,20.1,1,24000.0",  # empty temperature: ok, NULL
            "2024-01-15T14:15,5.0,81,3.0,0.1,0.1,0.0,bad,10.0,19.0,0,23000.0",  # malformed code
            "not-a-time,5.0,81,3.0,0.1,0.1,0.0,3,10.0,19.0,0,23000.0",
        ]
    )
    texts = spark.createDataFrame([("Z", None, None, None, text)], "commune_key string, start date, end date, ingested_at string, value string")
    rows = sorted(context_from_texts(texts, "Europe/Paris").collect(), key=lambda r: r.line_no)
    assert [r.row_ok for r in rows] == [True, False, False]
    assert rows[0].temperature_2m_c is None and rows[0].bad_cells == []
    assert rows[1].bad_cells == ["weather_code"]


def test_prj6_raw_as_variant(spark):
    items = spark.createDataFrame([("2024-09-01 14:00:00+02:00", 7, "OPEN", (20, (5, 15)))], RAW_OBSERVATION_ITEM)
    out = flatten_items(items, raw_as_variant=True)
    assert out.schema["raw"].dataType.simpleString() == "variant"
    got = out.select(F.variant_get("raw", "$.main_stands.availabilities.bikes", "int").alias("b")).first().b
    assert got == 5


def test_src5_quoted_comma_cell_is_quarantined_not_misread(spark):
    text = _csv([HEADER, '2024-01-15T14:00,"5,5",80,3.1,0.0,0.0,0.0,3,10.2,20.1,1,24000.0'])
    texts = spark.createDataFrame([("Z", None, None, None, text)], "commune_key string, start date, end date, ingested_at string, value string")
    r = context_from_texts(texts, "Europe/Paris").first()
    assert r.row_ok is False and r.temperature_2m_c is None


def test_src5_header_only_text_yields_no_rows(spark):
    texts = spark.createDataFrame([("h", _csv(["preamble", HEADER, ""])), ("n", "no header here")], "name string, value string")
    rows = split_text(texts).collect()
    assert [r.name for r in rows] == ["n"] and rows[0].cells is None


def test_snk6_src6_zone_names_with_escaped_characters_roundtrip(spark, tmp_dir):
    zones = ["Écully Nord: A+B", "Champagne-au-Mont-d'Or", "Ville 50%"]
    text = _csv([HEADER, "2024-01-15T14:00,5.5,80,3.1,0.0,0.0,0.0,3,10.2,20.1,1,24000.0"]) + "\n"
    texts = spark.createDataFrame(
        [(z, dt.date(2024, 1, 15), dt.date(2024, 1, 21), text) for z in zones], "zone string, start date, end date, value string"
    )
    write_context_archive(texts, tmp_dir, "20240122T000000000000Z")
    table = spark.createDataFrame([(z, 45.0, 4.0) for z in zones], "zone string, lat double, lon double")
    got = sorted(r.zone for r in context_from_texts(read_texts(spark, tmp_dir), "Europe/Paris", table).collect())
    assert got == sorted(zones)


def _csv_files(spark, folder, files):
    import os

    for zone, text in files.items():
        at = f"{folder.removeprefix('file:')}/commune={zone}/start=2024-01-15/end=2024-01-21"
        os.makedirs(at)
        with open(f"{at}/ingested_at=20240122T000000000000Z.csv", "w", encoding="utf-8", newline="") as f:
            f.write(text)


def test_src5_files_larger_than_a_split(spark, tmp_dir):
    """The lines of one file, read by many tasks, give the rows of the whole text."""
    from obsflow.schemas import CONTEXT_CSV_COLUMNS
    from obsflow.sources.context_csv import context_from_lines, context_from_texts, read_lines, read_texts

    header = ",".join(h for h, _, _ in CONTEXT_CSV_COLUMNS)
    turned = ",".join(["time", *[h for h, _, _ in reversed(CONTEXT_CSV_COLUMNS[1:])]])
    rows = [f"2024-01-{15 + k // 96:02d}T{k // 4 % 24:02d}:{k % 4 * 15:02d},{k / 4},80,3.1,0.0,0.0,0.0,3,10.2,20.1,1,24000.0" for k in range(600)]
    back = [",".join([r.split(",")[0], *reversed(r.split(",")[1:])]) for r in rows]
    preamble = "\n".join(f"note {k}, " + "x" * 80 for k in range(30))  # longer than a split
    _csv_files(
        spark,
        f"{tmp_dir}/a",
        {
            "Long": "\n".join([preamble, header, *rows, ""]),
            "Turned": "\r\n".join(["lat,lon", "", turned, *back]),
            "Quoted": "\n".join([header, '"2024-01-15T14:00",6.5,80,3.1,0.0,0.0,0.0,3,10.2,20.1,1,"24000.0"', "  ", "time,again", rows[0] + ",extra"]),
            "Headless": "\n".join(rows[:40]),
            "Bare": header,
        },
    )
    whole = context_from_texts(read_texts(spark, f"{tmp_dir}/a"), "Europe/Paris")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        lines = read_lines(spark, f"{tmp_dir}/a")
        assert lines.rdd.getNumPartitions() > 20
        split = context_from_lines(lines, "Europe/Paris")
        columns = [c for c in whole.columns if c not in ("line_no", "location", "file_path")]
        got = sorted(map(repr, split.select(*columns).collect()))
        assert "wholetext" not in split._jdf.queryExecution().executedPlan().toString().lower()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == sorted(map(repr, whole.select(*columns).collect()))
    n = {(r.zone, r.row_ok): r["count"] for r in split.groupBy("zone", "row_ok").count().collect()}
    assert n == {("Long", True): 600, ("Turned", True): 600, ("Quoted", True): 1, ("Quoted", False): 2, ("Headless", False): 1}


def test_src5_unreadable_rows_are_counted_and_kept(spark, tmp_dir):
    from obsflow.schemas import CONTEXT_CSV_COLUMNS
    from obsflow.sources.context_csv import accept_context, context_from_lines, read_lines

    header = ",".join(h for h, _, _ in CONTEXT_CSV_COLUMNS)
    good, bad = "2024-01-15T14:00,6.5,80,3.1,0.0,0.0,0.0,3,10.2,20.1,1,24000.0", "2024-01-15T14:15,n/a,80,3.1,0.0,0.0,0.0,3,10.2,20.1,1,24000.0"
    _csv_files(spark, f"{tmp_dir}/a", {"A": "\n".join([header, good, bad, "short,line"]), "B": "no header"})
    used, n = accept_context(spark, context_from_lines(read_lines(spark, f"{tmp_dir}/a"), "Europe/Paris"), f"{tmp_dir}/rejects")
    assert n == {"n_context_read": 4, "n_context_used": 1, "n_context_quarantined": 3} and used.count() == 1
    kept = {r.line: (r.zone, r.bad_cells) for r in spark.read.parquet(f"{tmp_dir}/rejects").collect()}
    assert kept == {bad: ("A", ["temperature_2m_c"]), "short,line": ("A", []), None: ("B", [])}


def test_prj6_variant_is_stored_and_only_its_paths_are_read(spark, tmp_dir):
    from obsflow.operators.reshape import flatten_items, items_from_lines

    lines = ['{"number": 5, "horodate": "2024-01-15 14:00:00Z", "note": {"event": 7, "tags": ["a", {"b": null}]}}', "no json", '{"note": {"event": "text"}}']
    items = flatten_items(items_from_lines(spark.createDataFrame([(x,) for x in lines], "value string")), raw_as_variant=True)
    items.write.parquet(f"{tmp_dir}/v")
    stored = spark.read.parquet(f"{tmp_dir}/v")
    event = stored.select("site_id", F.try_variant_get("raw", "$.note.event", "bigint").alias("event"), F.try_variant_get("raw", "$.note.tags[0]", "string").alias("tag"))
    plan = event._jdf.queryExecution().executedPlan().toString()
    assert "raw:variant" not in plan.replace(" ", "")  # the paths are read, not the whole value
    assert sorted(map(tuple, event.collect()), key=repr) == [(5, 7, "a"), (None, None, None), (None, None, None)]
