import datetime
import json
import random

import pyarrow.parquet as pq
from data import GARES, INTERCITES, TARIFS_IC, TARIFS_TGV, TER, TGV
from pyspark.sql import functions as F

from barorail import schemas as S
from barorail.functions import geo
from barorail.plans import build, realtime
from barorail.sinks import writers
from barorail.sources import readers
from barorail.sources.registry import SOURCES


def _write(path, schema, rows, sep=";", bom=False, extra=None):
    names = schema.names + ([extra] if extra else [])
    lines = [sep.join(names)]
    for row in rows:
        cells = ["" if v is None else f'"{v}"' if sep in v or "\n" in v else v for v in row] + (["x"] if extra else [])
        lines.append(sep.join(cells))
    path.write_text(("﻿" if bom else "") + "\n".join(lines) + "\n", encoding="utf-8")


def test_semicolon_file_with_mark_line_breaks_and_blanks(spark, tmp_path):
    path = tmp_path / "gares.csv"
    _write(path, S.GARES, [("Saint\nMalo", "SML", "A;B", "1.0, 2.0", None, "8", "i")], bom=True)
    (row,) = readers.read_semicolon_csv(spark, str(path), S.GARES).collect()
    assert tuple(row) == ("Saint\nMalo", "SML", "A;B", "1.0, 2.0", None, "8", "i")


def test_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "routes.csv"
    path.write_text('route_type,extra,ROUTE_ID,route_short_name\n2,z,007,"a, b"\n')
    (row,) = readers.read_gtfs_csv(spark, str(path), S.GTFS_ROUTES).collect()
    assert row.asDict() == {"route_id": "007", "agency_id": None, "route_short_name": "a, b", "route_type": "2"}


def test_absent_source_is_empty(spark, tmp_path):
    df = readers.read_source(spark, str(tmp_path), "nl_trips")
    assert df.isEmpty() and df.schema == S.GTFS_TRIPS
    assert readers.read_source(spark, str(tmp_path), "fi_stations").isEmpty()


def test_registry():
    assert len(SOURCES) == 25
    assert SOURCES["ch_stops"].table == "CH_STOPS"
    assert SOURCES["gares"].semicolon and not SOURCES["de_trips"].semicolon


def test_allowlist(spark, tmp_path):
    path = tmp_path / "list.txt"
    path.write_text("a\n\n  b \na\n")
    assert sorted(r.trip_id for r in readers.read_allowlist(spark, str(path), "trip_id").collect()) == ["a", "b"]
    out = tmp_path / "out"
    writers.export_allowlist(spark.createDataFrame([("x",), ("y",)], "route_id string"), "route_id", str(out))
    assert sorted(r.route_id for r in readers.read_allowlist(spark, str(out), "route_id").collect()) == ["x", "y"]


def test_stop_sequence_file_keeps_blanks_as_null(spark, tmp_path):
    rows = [("t", 1, "s", None, 5), ("t", 2, "q", 7, None)]
    out = str(tmp_path / "map")
    writers.export_csv(spark.createDataFrame(rows, S.STOP_SEQUENCE_MAP), out)
    assert sorted(map(tuple, readers.read_stop_sequence_map(spark, out).collect())) == rows


def test_result_export_reports_its_rows(spark, tmp_path):
    assert writers.export_result(spark.range(7), str(tmp_path / "r")) == 7
    writers.export_csv(spark.range(500), str(tmp_path / "sorted"), order_by=["id"])
    lines = [x for p in sorted((tmp_path / "sorted").glob("part-*.csv")) for x in p.read_text().split()]
    assert [int(x) for x in lines if x != "id"] == list(range(500))


def test_messages_round_trip(spark, tmp_path):
    rows = [("t", None, "PL", [("s", 1, None, 2, None)], 5, 6)]
    df = spark.createDataFrame(rows, S.TRIP_MESSAGE)
    assert json.loads(writers.keyed_messages(df).head().value)["route_id"] is None
    writers.publish_json(df, str(tmp_path / "m"))
    back = readers.read_messages(spark, str(tmp_path / "m"))
    assert back.drop("arrivee").collect() == df.collect()


def test_same_day_landing_replaces(spark, tmp_path):
    out = str(tmp_path / "bronze")
    df = spark.createDataFrame([("o", "c", "2024-01-01", 1), ("o", "c", "2024-01-02", 2)], "operateur string, category string, dt string, v int")
    writers.land_partitioned(df, out)
    writers.land_partitioned(df.filter("v = 2").withColumn("v", F.lit(3)), out)
    assert sorted(r.v for r in spark.read.parquet(out).collect()) == [1, 3]


def _raw_files(raw):
    raw.mkdir()
    _write(raw / "regularite_tgv.csv", S.TGV_MONTHLY, TGV, bom=True)
    _write(raw / "regularite_ter.csv", S.TER_MONTHLY, TER)
    _write(raw / "regularite_intercites.csv", S.INTERCITES_MONTHLY, INTERCITES)
    _write(raw / "gares.csv", S.GARES, GARES)
    _write(raw / "tarifs_tgv_ouigo.csv", S.TARIFS, TARIFS_TGV)
    _write(raw / "tarifs_intercites.csv", S.TARIFS, TARIFS_IC, extra="Type de place")
    _write(raw / "ch_stops.csv", S.GTFS_STOPS_CH, [("ch:1", "Bern", "46.9", "7.4", "8507000")], sep=",")
    _write(raw / "ch_routes.csv", S.GTFS_ROUTES, [("r1", "1", "IC1", "102")], sep=",")
    _write(raw / "ch_agency.csv", S.GTFS_AGENCY, [("1", "SBB")], sep=",")
    _write(raw / "pl_stop_times.csv", S.GTFS_STOP_TIMES, [("t", "1", "s", "24:00:00", None)], sep=",")
    (raw / "fi_stations.json").write_text(json.dumps([
        {"stationName": "Helsinki", "stationShortCode": "HKI", "stationUICCode": 1, "countryCode": "FI", "longitude": 24.9, "latitude": 60.1}
    ]))


def test_whole_build(spark, tmp_path):
    raw = tmp_path / "raw"
    _raw_files(raw)
    env = build.Environment("test", str(tmp_path / "gold"))
    tables = build.build(spark, str(raw), env, datetime.date(2024, 5, 1))
    assert tables["fact_regularite"].count() == 11
    counts = build.station_counts(tables["dim_stations_multipays"]).head()
    assert (counts.gares, counts.fr, counts.ch, counts.fi, counts.de) == (6, 4, 1, 1, 0)
    assert tables["fact_fares"].filter("prix_moyen_km IS NOT NULL").count() == 3
    assert tables["dim_rail_trips_de"].isEmpty()
    assert tables["dim_stop_sequence_pl"].head().arrival_seconds == 86400
    summary = {r.table_name: (r.total, r.renseignes) for r in build.build_summary(
        tables["fact_regularite"], tables["dim_stations_multipays"], tables["dim_liaisons"], tables["fact_fares"]
    ).collect()}
    assert summary["dim_liaisons"] == (3, 2)
    again = build.build(spark, str(raw), build.Environment("dev", str(tmp_path / "dev"), 1, 2), datetime.date(2024, 5, 1))
    assert again["fact_regularite"].count() == 6


def test_landing_and_staging(spark, tmp_path):
    raw = tmp_path / "raw"
    _raw_files(raw)
    landed = writers.land_bronze(spark, str(raw), str(tmp_path / "bronze"), datetime.date(2024, 5, 1))
    assert len(landed) == 11
    assert any(p.endswith("sncf/tarifs/dt=2024-05-01/tarifs_intercites") for p in landed)
    spark.sql(f"CREATE DATABASE staging LOCATION '{tmp_path / 'staging'}'")
    names = writers.stage_tables(spark, str(raw), "staging")
    assert len(names) == 25
    assert spark.table("staging.regularite_tgv").count() == 4
    writers.stage_tables(spark, str(raw), "staging")
    assert sorted(spark.table("staging.gares").columns) == sorted(S.GARES.names)
    spark.sql("DROP DATABASE staging CASCADE")


def test_commands(spark, tmp_path):
    from barorail.__main__ import run

    raw, gold = tmp_path / "raw", str(tmp_path / "gold")
    _raw_files(raw)
    summary = run(spark, ["build", "--env", "prod", "--raw", str(raw), "--gold", gold, "--day", "2024-05-01"])
    assert {r.table_name: r.total for r in summary.collect()}["fact_regularite"] == 11
    assert run(spark, ["export", "--gold", gold]) == 0  # three months are too short a history
    report = run(spark, ["profile", "--raw", str(raw)])
    rows = {(r.source, r.mesure, r.colonne): r.valeur for r in report.collect()}
    assert rows[("regularite_tgv.csv", "lignes", "")] == 4
    assert rows[("regularite_tgv.csv", "nuls", "Retard moyen de tous les trains à l'arrivée")] == 1
    assert len(run(spark, ["land", "--raw", str(raw), "--out", str(tmp_path / "bronze")])) == 11


def test_columns_nobody_declared_are_kept(spark, tmp_path):
    from barorail.__main__ import run

    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "regularite_ter.csv").write_text("Date;Extra;Région\n2024-01;a;X\n2024-01;b;X\n2024-01;b;X\n")
    (raw / "ch_routes.csv").write_text("route_id,colour\n")
    (path, empty) = writers.land_bronze(spark, str(raw), str(tmp_path / "bronze"), datetime.date(2024, 5, 1))
    assert spark.read.parquet(path).columns == ["Date", "Extra", "Région"]
    assert spark.read.parquet(empty).columns == ["route_id", "colour"]
    report = {(r.mesure, r.colonne): r.valeur for r in run(spark, ["profile", "--raw", str(raw), "--split"]).collect()}
    assert report[("colonnes", "")] == 3 and report[("doublons", "")] == 1


def test_variants_keep_what_nobody_declared(spark, tmp_path):
    documents = {
        "a.json": json.dumps([{"id": 1, "name": {"fr": "x"}, "zz": [1, 2]}, {"id": "2", "name": 5}, {"other": True}, None], indent=1),
        "b.json": json.dumps({"id": 7, "name": {"fr": "y"}}),
        "c.json": "no json [",
        "d.json": "[]",
    }
    for name, text in documents.items():
        (tmp_path / name).write_text(text)
    read = readers.read_json_variants(spark, str(tmp_path), "id bigint, name struct<fr: string>")
    assert read.columns == ["id", "name", "brut"]
    rows = sorted(((r.id, r.name and r.name.fr, r.j) for r in read.select("id", "name", F.to_json("brut").alias("j")).collect()), key=str)
    assert rows == sorted(
        [(1, "x", '{"id":1,"name":{"fr":"x"},"zz":[1,2]}'), (2, None, '{"id":"2","name":5}'), (None, None, '{"other":true}'),
         (None, None, "null"), (7, "y", '{"id":7,"name":{"fr":"y"}}')], key=str
    )
    assert [r[0] for r in read.where("id = 1").select(F.try_variant_get("brut", "$.zz[1]", "int")).collect()] == [2]


def test_a_box_reads_few_files(spark, tmp_path):
    rng = random.Random(3)
    rows = [(f"t{i}", rng.uniform(41, 55), rng.uniform(-5, 16)) for i in range(4000)] + [("nowhere", None, None)]
    df = spark.createDataFrame(rows, "trip_id string, latitude double, longitude double")
    out = str(tmp_path / "live")
    writers.replace_by_place(df, out, 32)
    south, west, north, east = 48.0, 1.0, 49.5, 3.5
    files = [pq.ParquetFile(p) for p in (tmp_path / "live").glob("part-*.parquet")]
    met, groups = 0, 0
    for f in files:
        for g in range(f.metadata.num_row_groups):
            lat, lon = (f.metadata.row_group(g).column(i).statistics for i in (1, 2))
            groups += 1
            met += lat.has_min_max and lat.max >= south and lat.min <= north and lon.max >= west and lon.min <= east
    assert groups >= 30 and 0 < met <= 6
    inside = sorted(t for t, a, b in rows if a is not None and south <= a <= north and west <= b <= east)
    found = spark.read.parquet(out)
    assert found.count() == len(rows)
    assert sorted(r.trip_id for r in realtime.in_view(found, south, west, north, east).collect()) == inside


def test_the_curve_interleaves_rows_and_columns(spark):
    places = [(0.0, 0.0), (-90.0, -180.0), (90.0, 180.0), (48.85, 2.35), (-12.3, 170.0), (None, 1.0)]
    df = spark.createDataFrame(places, "a double, b double")

    def want(a, b):
        cells = [max(0, min(65535, int((x + s / 2) // (s / 65536)))) for x, s in ((a, 180.0), (b, 360.0))]
        return sum(((cells[0] >> i & 1) << 2 * i + 1) | ((cells[1] >> i & 1) << 2 * i) for i in range(16))

    got = [r.z for r in df.select(geo.z_order(F.col("a"), F.col("b")).alias("z")).collect()]
    assert got == [None if a is None else want(a, b) for a, b in places]
