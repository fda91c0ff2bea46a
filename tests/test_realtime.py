import json
import random

import pytest
from pyspark.sql import functions as F

from barorail import schemas as S
from barorail.plans import messages, realtime


def _stop(name, a=None, ad=None, d=None, dd=None):
    return (name, a, ad, d, dd)


def _trips(spark, trips):
    return spark.createDataFrame(
        [(i, s) for i, s in trips.items()], f"trip_id string, stops {S.STOPS}"
    )


def _where(spark, stops, now, **options):
    rows = realtime.interpolate(_trips(spark, {"t": stops}), F.lit(now), **options).collect()
    return rows[0] if rows else None


def test_between_two_stops(spark):
    row = _where(spark, [_stop("A", d=2000), _stop("B", a=2400, ad=180)], 2100)
    assert (row.statut, row.stop_id_precedent, row.stop_id_suivant) == ("en_route", "A", "B")
    assert (row.progression, row.retard_s, row.index_restant) == (0.25, 180, 0)


def test_waiting_standing_and_finished(spark):
    stops = [_stop("A", d=1000, dd=60), _stop("B", a=1100, d=1200, ad=30, dd=0), _stop("C", a=1300)]
    waiting = _where(spark, stops, 900)
    assert (waiting.statut, waiting.stop_id_suivant, waiting.retard_s) == ("a_quai", "A", 60)
    standing = _where(spark, stops, 1150)
    assert (standing.statut, standing.stop_id_precedent, standing.index_restant) == ("a_quai", "B", 1)
    assert standing.retard_s == 30  # a departure delay of 0 falls through
    assert _where(spark, stops, 1150, zero_is_value=True).retard_s == 0
    assert _where(spark, stops, 1301) is None


def test_too_little_schedule(spark):
    assert _where(spark, [], 5) is None
    assert _where(spark, [_stop("A")], 5) is None
    assert _where(spark, [_stop("A", d=10)], 5) is None
    assert _where(spark, [_stop("A", a=0, d=0), _stop("B", a=10)], 5) is None
    assert _where(spark, [_stop("A", a=1, d=9)], 5).statut == "a_quai"


def test_index_counts_usable_stops(spark):
    row = _where(spark, [_stop("X"), _stop("A", d=10), _stop("Y"), _stop("B", a=20), _stop("C", a=30)], 25)
    assert (row.stop_id_precedent, row.stop_id_suivant, row.index_restant) == ("B", "C", 1)


def _expected(stops, now):
    """The rules as ranked candidates: standing, moving, waiting; the earliest stop of the best rank."""
    known = [s for s in stops if s[1] or s[3]]
    candidates = [
        (0, i, "a_quai", name, name, 0.0, d_delay or a_delay)
        for i, (name, a, a_delay, d, d_delay) in enumerate(known)
        if None not in (a, d) and a <= now < d
    ]
    for i, ((name, a, _, d, _), (nxt, a2, delay, d2, other)) in enumerate(zip(known, known[1:])):
        span = (d or a, a2 or d2)
        if None not in span and span[0] <= now <= span[1]:
            length = span[1] - span[0]
            share = round((now - span[0]) / length, 3) if length > 0 else 0.0
            candidates.append((1, i, "en_route", name, nxt, share, delay or other))
    if len(known) > 1:
        name, a, a_delay, d, d_delay = known[0]
        if (d or a) is not None and now < (d or a):
            candidates.append((2, 0, "a_quai", name, name, 0.0, d_delay or a_delay))
    if not candidates:
        return None
    _, i, *rest = min(candidates, key=lambda c: c[:2])
    return (*rest, i)


def test_interpolation_equals_the_rules_on_random_trips(spark):
    rng = random.Random(11)

    def some(values):
        return rng.choice([None, *values])

    trips = {}
    for t in range(3000):
        clock, stops = rng.randrange(0, 40), []
        for i in range(rng.randrange(0, 7)):
            a, d = clock + rng.randrange(0, 9), clock + rng.randrange(0, 12)
            stops.append(_stop(f"s{i}", some([a, a, 0]), some([0, 30, -5]), some([d, d, 0]), some([0, 45])))
            clock = max(a, d) + rng.randrange(0, 6) - 1
        trips[f"t{t}"] = stops
    for now in (17, 30):
        got = {r.trip_id: tuple(r)[2:] for r in realtime.interpolate(_trips(spark, trips), F.lit(now)).collect()}
        want = {t: e for t, s in trips.items() if (e := _expected(s, now)) is not None}
        assert got == want


@pytest.fixture(scope="module")
def lookup(spark):
    rows = [
        ("FR:87000001", "Un", 45.0, 1.0), ("FR:87000002", "Deux", 46.0, 3.0), ("CH:8500001", "Eins", 47.0, 7.0),
        ("CH:8500002", "Zwei", 47.5, 8.0), ("DE:1", "Berlin", 52.0, 13.0), ("FI:1", "Helsinki", 60.0, 25.0),
        ("NL:1000001", "Een", 52.0, 4.0), ("NL:1000002", "Twee", 53.0, 5.0), ("SE:2", "Malmö", 55.0, 13.0), ("SE:3", "Lund", 56.0, 13.0),
    ]
    return spark.createDataFrame(rows, "cle string, nom_gare string, latitude double, longitude double")


@pytest.fixture(scope="module")
def swiss(spark):
    return spark.createDataFrame([("ch:1:sloid:1", "8500001"), ("ch:1:sloid:2", "8500002")], "stop_id string, code_uic string")


def test_stop_resolution(spark, lookup, swiss):
    cases = [
        ("FR", "x-87000001", "FR:87000001"), ("FR", "x-99999999", "FR:99999999"), ("FR", "", None), ("FR", None, None),
        ("CH", "ch:1:sloid:1", "CH:8500001"), ("CH", "ch:1:sloid:9", None), ("DE", "1", "DE:1"), ("FI", "1", "FI:1"),
        ("PL", "1", None), ("SE", "2", "SE:2"), ("XX", "1", None), (None, "1", None),
    ]
    df = spark.createDataFrame([(i, p, s) for i, (p, s, _) in enumerate(cases)], "id int, pays string, stop_id string")
    got = {r.id: r.cle for r in realtime.resolve_stops(df, swiss, lookup).collect()}
    assert [got[i] for i in range(len(cases))] == [c[2] for c in cases]


def _state(spark, rows):
    schema = f"trip_id string, route_id string, pays string, stops {S.STOPS}, at bigint"
    return spark.createDataFrame(rows, schema).withColumn("updated_at", F.timestamp_seconds("at")).drop("at")


def _live(spark, lookup, swiss, rows, now=1000, **options):
    text = "trip_id string, cause string"
    return realtime.live_trains(
        _state(spark, rows), lookup, swiss,
        spark.createDataFrame([("77", "Panne", "X")], "numero_train string, cause string, gravite string"),
        spark.createDataFrame([("c1", "Travaux")], text),
        {
            "CH": spark.createDataFrame([("r1", "S10")], "route_id string, label string"),
            "NL": spark.createDataFrame([("n1", "Intercity")], "trip_id string, label string"),
            "IT": spark.createDataFrame([], "route_id string, label string"),
        },
        {
            "CH": spark.createDataFrame([("r1", "THURBO")], "route_id string, operateur string"),
            "NL": spark.createDataFrame([("r2", "NS")], "route_id string, operateur string"),
        },
        F.lit(now), **options,
    )


def _ride(a, b, pays_id=""):
    return [_stop(a, d=900), _stop(b, a=1100, ad=240)]


RIDES = [
    ("OCESN77F1", None, "FR", _ride("x-87000001", "x-87000002"), 990),
    ("c1", "r1", "CH", _ride("ch:1:sloid:1", "a8500002"), 990),
    ("n1", "r2", "NL", _ride("1000001", "1000002"), 990),
    ("s1", None, "SE", _ride("2", "3"), 990),
    ("same", None, "FR", _ride("x-87000001", "y-87000001"), 990),
    ("lost", None, "FR", _ride("x-87000001", "x-87999999"), 990),
    ("old", None, "SE", _ride("2", "3"), 300),
    ("nobody", None, "FR", None, 990),
]


def test_live_trains(spark, lookup, swiss):
    rows = {r.trip_id: r for r in _live(spark, lookup, swiss, RIDES).collect()}
    assert set(rows) == {"OCESN77F1", "c1", "n1", "s1"}
    fr = rows["OCESN77F1"]
    assert (fr.latitude, fr.longitude, fr.progression, fr.retard_s) == (45.5, 2.0, 0.5, 240)
    assert (fr.cause_retard, fr.operateur, fr.ligne) == ("Panne", "SNCF", None)
    assert (rows["c1"].cause_retard, rows["c1"].ligne, rows["c1"].operateur) == ("Travaux", "S10", "THURBO")
    assert (rows["n1"].ligne, rows["n1"].operateur, rows["n1"].cause_retard) == ("Intercity", "NS", None)
    assert (rows["s1"].operateur, rows["s1"].ligne) == ("Skånetrafiken", None)


def test_dwell_and_age_options(spark, lookup, swiss):
    kept = _live(spark, lookup, swiss, RIDES, max_age_s=3600, include_dwell=True)
    assert {r.trip_id for r in kept.collect()} == {"OCESN77F1", "c1", "n1", "s1", "same", "old"}
    with pytest.raises(ValueError):
        _live(spark, lookup, swiss, RIDES, max_age_s=10)


def test_duplicate_dimension_rows_do_not_multiply_trains(spark, lookup, swiss):
    twice = swiss.unionByName(swiss)
    assert _live(spark, lookup, twice, RIDES).count() == 4


def test_summary_and_view(spark, lookup, swiss):
    live = _live(spark, lookup, swiss, RIDES)
    row = realtime.live_summary(live).head()
    assert (row.trains, row.ok, row.warn, row.crit, row.idle, row.retard_moyen_min) == (4, 0, 4, 0, 0, 4)
    assert [r.trip_id for r in realtime.map_markers(live, 40, 0, 50, 10).collect()] == ["OCESN77F1", "c1"]
    assert [r.trip_id for r in realtime.map_markers(live, 40, 0, 60, 20, limit=1).collect()] == ["OCESN77F1"]
    assert realtime.live_summary(live.limit(0)).head().retard_moyen_min is None


def test_station_route_skips_unknown_and_repeated_stops(spark, lookup, swiss):
    stops = [
        _stop("1000001", d=800), _stop("p1000001", d=850), _stop("123", d=880), _stop("q1000001", d=900),
        _stop("1000002", a=1100), _stop("1000001", a=1200),
    ]
    live = _live(spark, lookup, swiss, [("n1", "r2", "NL", stops, 990)])
    rows = realtime.station_route(live, swiss, lookup).orderBy("troncon", "rang").collect()
    assert [(r.troncon, r.rang, r.latitude) for r in rows] == [
        ("parcouru", 1, 52.0), ("restant", 1, 52.0), ("restant", 2, 53.0), ("restant", 3, 52.0),
    ]


def test_itinerary_prefers_a_known_track(spark, lookup, swiss):
    live = _live(spark, lookup, swiss, RIDES)
    trip_shapes = spark.createDataFrame([("n1", "h1"), ("s1", "h2")], "trip_id string, shape_id string")
    # The train is at (52.5, 4.5); points 3 and 4 are equally near, so the first of them splits.
    track = [(1, 52.0, 4.0), (2, 52.2, 4.2), (3, 52.4, 4.5), (4, 52.6, 4.5), (5, 53.0, 5.0)]
    points = spark.createDataFrame([("h1", *p) for p in track], "shape_id string, shape_pt_sequence int, latitude double, longitude double")
    route = realtime.itinerary(live, swiss, lookup, trip_shapes, points, "n1")
    sides = {s: [r.rang for r in route.filter(F.col("troncon") == s).orderBy("rang").collect()] for s in ("parcouru", "restant")}
    assert sides == {"parcouru": [1, 2, 3], "restant": [3, 4, 5]}
    other = realtime.itinerary(live, swiss, lookup, trip_shapes, points, "s1")  # its track has no points, and no Dutch trip
    assert sorted((r.troncon, r.rang) for r in other.collect()) == [("parcouru", 1), ("restant", 1), ("restant", 2)]
    lists = {r.troncon: [tuple(p) for p in r.points] for r in realtime.itinerary_lists(route).collect()}
    assert lists["parcouru"][0] == (52.0, 4.0)
    assert lists["parcouru"][-1] == lists["restant"][0]
    every = realtime.itinerary(live, swiss, lookup, trip_shapes, points)
    assert {r.trip_id for r in every.collect()} == {"OCESN77F1", "c1", "n1", "s1"}


def test_disruption_causes(spark, tmp_path):
    document = {
        "disruptions": [
            {"messages": [{"text": ""}, {"text": "Neige"}], "severity": {"effect": "DELAY"},
             "impacted_objects": [{"pt_object": {"trip": {"name": "10"}}}, {"pt_object": {"trip": {"name": "11"}}}]},
            {"messages": [{"text": "Grève"}, {"text": "b"}], "severity": {},
             "impacted_objects": [{"pt_object": {"trip": {"name": "11"}}}, {"pt_object": {}}, {"pt_object": {"trip": {"name": ""}}}]},
            {"messages": [], "impacted_objects": [{"pt_object": {"trip": {"name": "10"}}}]},
            {"messages": [{"text": "sans train"}]},
        ]
    }
    path = tmp_path / "d.json"
    path.write_text(json.dumps(document))
    from barorail.sources.readers import read_disruptions

    rows = {r.numero_train: (r.cause, r.gravite) for r in realtime.disruption_causes(read_disruptions(spark, str(path))).collect()}
    assert rows == {"10": ("Neige", "DELAY"), "11": ("Grève", None)}


def test_alert_causes(spark, tmp_path):
    def alert(pairs, trips):
        return {"alert": {"headerText": {"translation": [{"language": a, "text": b} for a, b in pairs]},
                          "informedEntity": [{"trip": {"tripId": t}} for t in trips]}}

    document = {"entity": [
        alert([("de", "Bau"), ("fr", "Travaux")], ["a", "b"]), alert([("de", "Sturm")], ["b", ""]),
        alert([("de", "")], ["a"]), {"alert": {"informedEntity": [{"trip": {"tripId": "c"}}]}}, {"alert": {}},
    ]}
    path = tmp_path / "a.json"
    path.write_text(json.dumps(document))
    from barorail.sources.readers import read_alerts

    assert {r.trip_id: r.cause for r in realtime.alert_causes(read_alerts(spark, str(path))).collect()} == {"a": "Travaux", "b": "Sturm"}


def _feed(updates, trip="t1", route="", day="20240110", at=1704900000):
    return {"header": {"timestamp": at}, "entity": [
        {"id": "1", "trip_update": {"trip": {"trip_id": trip, "route_id": route, "start_date": day}, "stop_time_update": updates}},
        {"id": "2", "vehicle": {}},
        {"id": "3", "trip_update": {"trip": {"trip_id": "empty"}, "stop_time_update": []}},
    ]}


def _read_feed(spark, tmp_path, *feeds):
    from barorail.sources.readers import read_feeds

    path = tmp_path / "feed"
    path.mkdir()
    for i, feed in enumerate(feeds):
        (path / f"{i}.json").write_text(json.dumps(feed) + "\n")
    return read_feeds(spark, str(path))


def test_feed_to_messages(spark, tmp_path):
    feeds = _read_feed(spark, tmp_path, _feed([{"stop_id": "A", "departure": {"time": 5}}, {"arrival": {"delay": 7}}]))
    (row,) = messages.trip_messages(feeds, "FR", captured_at=F.lit(9).cast("bigint")).collect()
    assert (row.trip_id, row.route_id, row.pays, row.feed_timestamp, row.captured_at) == ("t1", None, "FR", 1704900000, 9)
    assert [tuple(s) for s in row.stops] == [("A", None, None, 5, None), ("", None, 7, None, None)]


def test_allowlists(spark, tmp_path):
    feeds = _read_feed(spark, tmp_path, _feed([{"stop_id": "A"}], "t1", "r1"), _feed([{"stop_id": "A"}], "t2", "r2"))
    routes = spark.createDataFrame([("r1",), ("r1",)], "route_id string")
    trips = spark.createDataFrame([("t2",)], "trip_id string")
    assert [r.trip_id for r in messages.trip_messages(feeds, "CH", rail_routes=routes).collect()] == ["t1"]
    assert [r.trip_id for r in messages.trip_messages(feeds, "DE", rail_trips=trips).collect()] == ["t2"]
    assert messages.trip_messages(feeds, "FR").count() == 2


def test_stop_sequences_are_resolved(spark, tmp_path):
    midnight = 1704841200  # 2024-01-10 00:00 in Warsaw
    updates = [
        {"stop_sequence": 2, "arrival": {"time": midnight + 3700}, "departure": {"time": midnight + 3800, "delay": 5}},
        {"stop_sequence": 1, "departure": {"time": midnight + 90_060}},
        {"stop_sequence": 9, "arrival": {"time": midnight}},
        {"stop_id": "own", "stop_sequence": 2, "arrival": {"delay": 3}},
    ]
    feeds = _read_feed(spark, tmp_path, _feed(updates), _feed(updates[:1], trip="t1", at=1704900120))
    stop_map = spark.createDataFrame(
        [("t1", 1, "S1", None, 90_000), ("t1", 2, "S0", 1, 1), ("t1", 2, "S2", 3600, None)], S.STOP_SEQUENCE_MAP
    )
    rows = messages.trip_messages(feeds, "PL", stop_map=stop_map).orderBy("feed_timestamp").collect()
    assert [tuple(s) for s in rows[0].stops] == [
        ("S2", midnight + 3700, 100, midnight + 3800, 5),
        ("S1", None, None, midnight + 90_060, 60),
        ("", midnight, None, None, None),
        ("own", None, 3, None, None),
    ]
    assert len(rows[1].stops) == 1


def test_finnish_trains(spark, tmp_path):
    def row(code, kind, scheduled, actual=None, late=None, cancelled=False):
        return {"stationUICCode": code, "type": kind, "scheduledTime": scheduled, "actualTime": actual,
                "differenceInMinutes": late, "cancelled": cancelled}

    day = "2024-01-01T10:%02d:00.000Z"
    trains = [
        {"trainNumber": 27, "departureDate": "2024-01-01", "timeTableRows": [
            row(1, "DEPARTURE", day % 0, day % 3, 3), row(5, "ARRIVAL", day % 10), row(7, "ARRIVAL", day % 12, cancelled=True),
            row(5, "DEPARTURE", day % 11, None, -1), row(None, "ARRIVAL", day % 13), row(1, "ARRIVAL", day % 20, "", 2),
        ]},
        {"trainNumber": 28, "departureDate": "2024-01-01", "timeTableRows": [row(1, "ARRIVAL", day % 1, cancelled=True)]},
        {"trainNumber": 29, "departureDate": "2024-01-01"},
    ]
    path = tmp_path / "fi.json"
    path.write_text(json.dumps(trains))
    from barorail.sources.readers import read_live_trains

    (message,) = messages.finnish_messages(read_live_trains(spark, str(path)), F.lit(1).cast("bigint")).collect()
    base = 1704103200
    assert (message.trip_id, message.route_id, message.pays) == ("27_20240101", None, "FI")
    assert [tuple(s) for s in message.stops] == [
        ("1", base + 1200, 120, base + 180, 180), ("5", base + 600, 0, base + 660, -60),
    ]


def test_missing_country_is_french(spark):
    df = spark.createDataFrame([("a", None), ("b", "IT")], "trip_id string, pays string")
    assert {r.trip_id: r.pays for r in messages.with_default_country(df).collect()} == {"a": "FR", "b": "IT"}
    assert messages.with_default_country(df.drop("pays")).select("pays").distinct().head()[0] == "FR"


def test_equal_snapshots_stay_two_messages(spark, tmp_path):
    feed = _feed([{"stop_sequence": 1, "arrival": {"time": 5}}])
    feeds = _read_feed(spark, tmp_path, feed)
    feeds = feeds.unionByName(feeds)
    stop_map = spark.createDataFrame([], S.STOP_SEQUENCE_MAP)
    for timetable in (None, stop_map):
        rows = messages.trip_messages(feeds, "PL", stop_map=timetable).collect()
        assert [len(r.stops) for r in rows] == [1, 1]


def test_a_timetable_in_buckets_stays_where_it_is(spark, tmp_path):
    long_trip = spark.range(1_000_000).select(
        F.lit("t1").alias("trip_id"), F.col("id").cast("int").alias("stop_sequence"),
        F.concat(F.lit("S"), "id").alias("stop_id"), F.col("id").alias("arrival_seconds"), F.lit(None).cast("bigint").alias("departure_seconds"),
    )
    table = messages.write_timetable(long_trip, "long_timetable", str(tmp_path / "timetable"), buckets=6)
    sizes = [r["count"] for r in table.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 6 and max(sizes) < 200_000
    updates = [{"stop_sequence": n, "arrival": {"delay": 1}} for n in (5, 999_999, 1_000_000, 5)] + [{"stop_id": "x"}]
    feeds = _read_feed(spark, tmp_path, _feed(updates), _feed(updates), _feed(updates[:1], trip="t2"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = messages.trip_messages(feeds, "PL", stop_map=table, map_is_reduced=True)
        plan = found._jdf.queryExecution().executedPlan().toString()
        timetable = plan[plan.index("SortMergeJoin") :].split("Scan parquet")
        # The side of the timetable goes from its scan to the join without an exchange.
        (side,) = [i for i, part in enumerate(timetable) if "long_timetable" in part[:200]]
        above = timetable[side - 1].rsplit("\n", 8)[-8:]
        assert "Bucketed: true" in timetable[side] and not any("Exchange" in line for line in above[-4:])
        rows = sorted(found.collect(), key=lambda r: r.trip_id)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE long_timetable")
    assert [r.trip_id for r in rows] == ["t1", "t1", "t2"]  # equal messages stay apart
    assert [s.stop_id for s in rows[0].stops] == ["S5", "S999999", "", "S5", "x"]
    assert [s.stop_id for s in rows[2].stops] == [""]


def test_messages_leave_behind_what_they_do_not_carry(spark, tmp_path):
    feeds = _read_feed(spark, tmp_path, _feed([{"stop_sequence": 1, "arrival": {"time": 5}}]))
    feeds = feeds.withColumn("source_file", F.lit("a long path"))
    stop_map = spark.createDataFrame([("t1", 1, "B", 2, 3), ("t1", 1, "A", 9, 9)], S.STOP_SEQUENCE_MAP)
    found = messages.trip_messages(feeds, "PL", stop_map=stop_map, captured_at=F.lit(1).cast("bigint"))
    assert [s.stop_id for s in found.head().stops] == ["B"]
    written = spark.read.parquet(*found.inputFiles())  # the numbered messages, which are moved twice more
    assert not {"source_file", "entity_pos"} & set(written.columns)
    whole = messages.resolved_stops(messages.feed_entities(feeds), stop_map)
    assert {"source_file", "entity_pos", "start_date"} <= set(whole.columns)


def test_buckets_grow_with_the_timetable(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(messages, "BUCKET_ROWS", 100)
    stop_map = spark.range(2_000).selectExpr(
        "'t' AS trip_id", "CAST(id AS int) AS stop_sequence", "'S' AS stop_id", "id AS arrival_seconds", "id AS departure_seconds"
    )
    for rows, buckets in ((2_000, 20), (10, 8)):
        messages.write_timetable(stop_map.limit(rows), f"grown_{rows}", str(tmp_path / f"t{rows}"))
        told = spark.sql(f"DESCRIBE EXTENDED grown_{rows}").where("col_name = 'Num Buckets'").head()
        spark.sql(f"DROP TABLE grown_{rows}")
        assert told.data_type == str(buckets)
