import random

import pytest

from pyspark.sql import functions as F

from barorail import schemas as S
from barorail.operators.polylines import nearest_points, numbered_points, polyline_parts, polylines
from barorail.plans import gtfs, stations


def _values(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_swiss_stations_share_a_code(spark):
    stops = spark.createDataFrame(
        [
            ("a:1", "Bern", "46.0", "7.0", "8507000"),
            ("a:2", "Bern Gl. 2", "47.0", "8.0", "8507000"),
            ("b", "Bus", "46.5", "7.5", ""),
            ("c", "Tram", "46.5", "7.5", None),
            ("d", "Thun", "x", None, "8507100"),
        ],
        S.GTFS_STOPS_CH,
    )
    rows = {r.station_id: r for r in stations.stations_ch(stops).collect()}
    assert set(rows) == {"8507000", "8507100"}
    assert (rows["8507000"].nom_gare, rows["8507000"].latitude, rows["8507000"].longitude) == ("Bern", 46.5, 7.5)
    assert rows["8507100"].latitude is None
    assert _values(gtfs.stop_uic(stops), "stop_id") == [("a:1",), ("a:2",), ("d",)]


def test_stops_without_a_position_are_left_out(spark):
    stops = spark.createDataFrame([("1", "A", "50.1", "8.2"), ("2", "B", None, "8.2"), ("3", "C", "bad", "8.2")], S.GTFS_STOPS)
    rows = {r.station_id: r.latitude for r in stations.stations_gtfs(stops, "DE").collect()}
    assert rows == {"1": 50.1, "3": None}


def test_finnish_stations_skip_foreign_codes(spark):
    rows = [("Ahvenus", "AHV", 1000, "FI", 22.5, 61.3), ("Petroskoi", "PTS", 1000, "RU", 34.3, 61.8), ("X", "X", 5, "FI", None, 1.0)]
    df = spark.createDataFrame(rows, S.FI_STATIONS)
    assert _values(stations.stations_fi(df), "station_id", "nom_gare", "trigramme") == [("1000", "Ahvenus", "AHV")]


def test_ids_may_repeat_across_countries_but_not_composite_ids(spark):
    stops = spark.createDataFrame([("1", "A", "50.1", "8.2")], S.GTFS_STOPS)
    both = stations.stations_all([stations.stations_gtfs(stops, c) for c in ("DE", "FI")])
    assert _values(both, "id_gare") == [("DE:1",), ("FI:1",)]


def test_lookup_keeps_one_row_per_key(spark):
    stops = spark.createDataFrame([("1", "A", "50.1", "8.2"), ("2", "B", "50.2", "8.3")], S.GTFS_STOPS)
    dim = stations.stations_all([stations.stations_gtfs(stops, "IT")]).withColumn("code_uic", F.lit("9"))
    assert _values(stations.station_lookup(dim), "cle", "nom_gare") == [("IT:9", "B")]


ROUTES = [("r1", "1", "IC1", "102"), ("r2", "2", "", "700"), ("r3", "9", None, "2"), ("r4", "1", "S1", "117"), ("r5", "1", "S2", "118")]
TRIPS = [("r1", "t1", "Intercity", "s1"), ("r3", "t2", "Sprinter", "s2"), ("r3", "t3", "", None), ("zz", "t4", "X", "s4")]


def test_route_filters_and_labels(spark):
    routes = spark.createDataFrame(ROUTES, S.GTFS_ROUTES)
    trips = spark.createDataFrame(TRIPS, S.GTFS_TRIPS)
    agency = spark.createDataFrame([("1", "SBB"), ("2", "BLS")], S.GTFS_AGENCY)
    assert _values(gtfs.rail_routes(routes), "route_id") == [("r1",), ("r4",)]
    assert _values(gtfs.rail_trips(trips, routes, extended=True), "trip_id") == [("t1",)]
    assert _values(gtfs.rail_trips(trips, routes, extended=False), "trip_id") == [("t2",), ("t3",)]
    assert _values(gtfs.route_labels(routes), "route_id", "label") == [("r1", "IC1"), ("r4", "S1"), ("r5", "S2")]
    assert len(_values(gtfs.route_operators(routes, agency), "route_id", "operateur")) == 4
    assert _values(gtfs.trip_labels(trips, routes), "trip_id", "label") == [("t2", "Sprinter")]
    assert _values(gtfs.trip_shapes(trips, routes), "trip_id", "shape_id") == [("t2", "s2")]


def test_rail_operators_are_distinct(spark):
    routes = spark.createDataFrame([("r", "1", "", "2"), ("r", "1", "", "2"), ("q", "1", "", "3")], S.GTFS_ROUTES)
    agency = spark.createDataFrame([("1", "NS")], S.GTFS_AGENCY)
    assert _values(gtfs.route_operators(routes, agency, rail_only=True), "route_id", "operateur") == [("r", "NS")]


def test_stop_sequence_map(spark):
    df = spark.createDataFrame([("t", "3", "s", "24:10:00", ""), ("t", "4", "q", None, "01:00:01")], S.GTFS_STOP_TIMES)
    assert sorted(map(tuple, gtfs.stop_sequence_map(df).collect())) == [
        ("t", 3, "s", 87000, None), ("t", 4, "q", None, 3601),
    ]


def test_shape_lists_only_for_used_shapes(spark):
    points = spark.createDataFrame(
        [("s2", "10", "52.3", "4.3"), ("s2", "2", "52.1", "4.1"), ("s9", "1", "50.0", "4.0")], S.GTFS_SHAPES
    )
    used = spark.createDataFrame([("t2", "s2")], "trip_id string, shape_id string")
    (row,) = gtfs.shape_polylines(points, used).collect()
    assert row.shape_id == "s2"
    assert [tuple(p) for p in row.points] == [(52.1, 4.1), (52.3, 4.3)]
    assert gtfs.shape_points(points).count() == 3


def test_a_line_is_one_list_whatever_its_numbers(spark):
    rng = random.Random(1)
    rows = [("a", 6000 * i, float(i), -float(i)) for i in range(2500)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "shape_id string, seq int, latitude double, longitude double")
    (line,) = polylines(df, ["shape_id"], "seq").collect()
    assert [p.lat for p in line.points] == [float(i) for i in range(2500)]


def test_tracks_are_numbered_across_partitions(spark):
    rng = random.Random(2)
    sizes = {"hot": 4000, "b": 7, "c": 1, None: 12}
    rows = [(k, rng.choice([i, i // 2]), rng.random(), rng.random()) for k, n in sizes.items() for i in range(n)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, seq int, latitude double, longitude double")
    settings = {"spark.sql.shuffle.partitions": "9", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        placed = numbered_points(df, ["k"], "seq")
        plan = placed._jdf.queryExecution().executedPlan().toString()
        assert "collect_list" not in plan
        found = placed.collect()
        parts = polyline_parts(df, ["k"], "seq", part=100).collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    for k, n in sizes.items():
        want = sorted(r[1:] for r in rows if r[0] == k)
        own = sorted((r for r in found if r.k == k), key=lambda r: r.rang)
        assert [r.rang for r in own] == list(range(n))
        assert [(r.seq, r.latitude, r.longitude) for r in own] == want
        lists = sorted((r for r in parts if r.k == k), key=lambda r: r.part)
        assert max(len(r.points) for r in lists) <= 100
        assert [(p.lat, p.lon) for r in lists for p in r.points] == [w[1:] for w in want]
    assert numbered_points(df.limit(0), ["k"], "seq").collect() == []


def test_nearest_points_look_around_only(spark):
    rng = random.Random(4)
    tracks, places = [], []
    for trip in range(30):
        lat, lon = 45 + rng.random(), 4 + rng.random()
        for seq in range(600):
            tracks.append((f"t{trip}", seq, lat, lon))
            lat, lon = lat + rng.uniform(-0.004, 0.01), lon + rng.uniform(-0.004, 0.01)
        _, _, a, b = tracks[-rng.randint(1, 600)]
        far = 5.0 if trip == 7 else 0.3 if trip == 8 else 0.003
        places.append((f"t{trip}", a + rng.uniform(-far, far), b + rng.uniform(-far, far)))
    tracks += [("t0", 9000, None, None), ("t3", 700, 50.0, 8.0), ("t3", 701, 50.0, 8.0)]
    places[3] = ("t3", 50.0, 8.0)
    places += [("nowhere", 45.0, 4.0), ("unplaced", None, None)]
    tracks += [("unplaced", 3, 45.0, 4.0), ("unplaced", 4, 45.0, 4.1)]
    track = spark.createDataFrame(tracks, "trip_id string, seq int, latitude double, longitude double")
    positions = spark.createDataFrame(places, "trip_id string, _latitude double, _longitude double")
    found = {r.trip_id: r for r in nearest_points(track, positions, "trip_id", "seq").collect()}
    for trip, lat, lon in places[:30]:
        own = [(((a - lat) ** 2 + (b - lon) ** 2), s) for t, s, a, b in tracks if t == trip and a is not None]
        assert (found[trip].cut, pytest.approx(found[trip].d2)) == (min(own)[1], min(own)[0])
    assert found["t3"].cut == 700 and found["unplaced"].cut == 3 and "nowhere" not in found
    near = sorted(r.compared for t, r in found.items() if t not in ("t7", "t8"))
    assert near[len(near) // 2] < 60 and found["t7"].compared >= 600


def test_nearest_points_do_not_multiply_positions(spark):
    track = spark.createDataFrame([("t", 1, 45.0, 4.0), ("t", 2, 45.1, 4.1)], "trip_id string, seq int, latitude double, longitude double")
    positions = spark.createDataFrame([("t", 45.09, 4.1)], "trip_id string, _latitude double, _longitude double")
    found = nearest_points(track, positions, "trip_id", "seq")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # The cells around a position are no rows: there may be a thousand, and a join would broadcast them.
    assert "Generate" not in plan and plan.count("Join") == 1
    assert [(r.cut, r.compared) for r in found.collect()] == [(2, 1)]
