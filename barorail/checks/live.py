"""Queries on timetables, messages, positions and the access log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ids, labels
from ..operators import sketches
from ..operators.polylines import PART
from ..plans import accesslog, gtfs, messages, quality, realtime
from ..schemas import COUNTRIES, LINE_TYPES, TRIP_MESSAGE
from ..session import scratch_dir
from ..sinks import writers
from .registry import add
from .sql import CTES, station_key
from .views import NOW

# Timetables
add(
    "dp7_stop_uic",
    lambda v: gtfs.stop_uic(v.ch_stops),
    "SELECT stop_id, didok AS code_uic FROM ch_stops WHERE didok IS NOT NULL AND didok <> ''",
)
add(
    "dp8_route_labels",
    lambda v: gtfs.route_labels(v.routes),
    "SELECT route_id, route_short_name AS label FROM routes WHERE route_short_name <> ''",
)
add(
    "dp9_route_operators",
    lambda v: gtfs.route_operators(v.routes, v.agency),
    "SELECT route_id, agency_name AS operateur FROM routes JOIN agency USING (agency_id)",
)
add(
    "dp9_rail_route_operators",
    lambda v: gtfs.route_operators(v.basic_routes, v.agency, rail_only=True),
    """SELECT DISTINCT route_id, agency_name AS operateur FROM basic_routes JOIN agency USING (agency_id)
        WHERE route_type = 2""",
)
add(
    "dp10_trip_labels",
    lambda v: gtfs.trip_labels(v.trips, v.basic_routes),
    "SELECT trip_id, trip_long_name AS label FROM rail WHERE trip_long_name <> ''",
)
add(
    "dp11_trip_shapes",
    lambda v: gtfs.trip_shapes(v.trips, v.basic_routes),
    "SELECT trip_id, shape_id FROM rail WHERE shape_id <> ''",
)
add(
    "dp12_shape_points",
    lambda v: gtfs.shape_points(v.shapes),
    "SELECT shape_id, seq AS shape_pt_sequence, latitude, longitude FROM shape_pts",
)


def _shape_lists(v) -> DataFrame:
    lists = gtfs.shape_polylines(v.shapes, gtfs.trip_shapes(v.trips, v.basic_routes))
    return lists.select("shape_id", "part", F.posexplode("points").alias("pos", "p")).select(
        "shape_id", (F.col("part") * PART + F.col("pos")).alias("rang"), "p.lat", "p.lon"
    )


def _numbered_points(v) -> DataFrame:
    placed = gtfs.numbered_shape_points(v.shapes, gtfs.trip_shapes(v.trips, v.basic_routes))
    return placed.select("shape_id", F.col("rang").cast("int").alias("rang"), F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))


_NUMBERED = """SELECT shape_id, CAST(row_number() OVER (PARTITION BY shape_id ORDER BY seq) - 1 AS INTEGER) AS rang,
        latitude AS lat, longitude AS lon FROM shape_pts WHERE shape_id IN (SELECT shape_id FROM rail)"""
add("dp12_shape_points_numbered", _numbered_points, _NUMBERED)


add(
    "dp12_shape_lists",
    _shape_lists,
    _NUMBERED,
)
add(
    "dp13_rail_routes",
    lambda v: gtfs.rail_routes(v.routes),
    "SELECT route_id FROM routes WHERE route_type BETWEEN 100 AND 117",
)
add(
    "dp14_rail_trips_basic",
    lambda v: gtfs.rail_trips(v.trips, v.basic_routes, extended=False),
    "SELECT trip_id FROM rail",
)
add(
    "dp14_rail_trips_extended",
    lambda v: gtfs.rail_trips(v.trips, v.routes, extended=True),
    "SELECT t.trip_id FROM trips t JOIN routes r ON r.route_id = t.route_id WHERE r.route_type BETWEEN 100 AND 117",
)
add(
    "dp15_stop_sequence_map",
    lambda v: v.stop_map,
    "SELECT trip_id, stop_sequence, stop_id, arrival_seconds, departure_seconds FROM stop_map",
)
add(
    "jn12_last_map_entries",
    lambda v: messages.last_map_entries(v.stop_map),
    """SELECT trip_id, stop_sequence, stop_id, arrival_seconds, departure_seconds FROM (
        SELECT *, row_number() OVER (PARTITION BY trip_id, stop_sequence ORDER BY stop_id DESC NULLS LAST,
          arrival_seconds DESC NULLS LAST, departure_seconds DESC NULLS LAST) AS rn FROM stop_map) WHERE rn = 1""",
)


# Messages
def _stop_rows(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(*keep, F.posexplode("stops").alias("rang", "s")).select(*keep, "rang", "s.*")


_FEED = """SELECT CAST(l_orderkey AS VARCHAR) AS trip_id, CAST(NULL AS VARCHAR) AS route_id,
    strftime(l_shipdate,'%Y%m%d') AS start_date, l_linenumber AS seq,
    CASE WHEN l_returnflag = 'R' THEN 'X'||l_suppkey ELSE '' END AS stop_id,
    CAST(epoch(l_shipdate) AS BIGINT) + CAST(l_quantity AS BIGINT) * 1800 AS instant,
    CASE WHEN l_linestatus = 'F' THEN 30 END AS d_delay, l_shipdate FROM lineitem"""
add(
    "rt1_trip_messages",
    lambda v: _stop_rows(
        messages.trip_messages(v.feeds, "PL", captured_at=F.lit(NOW).cast("bigint")),
        "trip_id", "route_id", "pays", "feed_timestamp", "captured_at",
    ),
    f"""SELECT trip_id, route_id, 'PL' AS pays, instant AS feed_timestamp, CAST({NOW} AS BIGINT) AS captured_at,
        0 AS rang, stop_id, instant AS arrival_time, CAST(NULL AS BIGINT) AS arrival_delay, instant + 60 AS departure_time,
        CAST(d_delay AS BIGINT) AS departure_delay FROM ({_FEED})""",
)
add(
    "jn11_allowed_trips",
    lambda v: messages.allow(
        messages.feed_entities(v.feeds),
        v.table("orders").filter(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").cast("string").alias("trip_id")),
        "trip_id",
    ).select("trip_id", "feed_timestamp"),
    f"""SELECT trip_id, instant AS feed_timestamp FROM ({_FEED}) WHERE trip_id IN (
        SELECT CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'F')""",
)
add(
    "rt1_resolved_messages",
    lambda v: _stop_rows(
        messages.trip_messages(v.feeds, "PL", stop_map=v.stop_map, captured_at=F.lit(NOW).cast("bigint")),
        "trip_id", "feed_timestamp",
    ),
    f"""SELECT f.trip_id, f.instant AS feed_timestamp, 0 AS rang,
        CASE WHEN f.stop_id <> '' THEN f.stop_id ELSE COALESCE(m.stop_id, '') END AS stop_id, f.instant AS arrival_time,
        f.instant - (CAST(epoch(timezone('Europe/Warsaw', l_shipdate)) AS BIGINT) + m.arrival_seconds) AS arrival_delay,
        f.instant + 60 AS departure_time,
        COALESCE(f.d_delay, f.instant + 60 - (CAST(epoch(timezone('Europe/Warsaw', l_shipdate)) AS BIGINT) + m.departure_seconds))
          AS departure_delay
        FROM ({_FEED}) f LEFT JOIN (SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY trip_id, stop_sequence ORDER BY stop_id DESC NULLS LAST,
          arrival_seconds DESC NULLS LAST, departure_seconds DESC NULLS LAST) AS rn FROM stop_map) WHERE rn = 1) m
        ON m.trip_id = f.trip_id AND m.stop_sequence = f.seq""",
)
FINNISH_SQL = """SELECT trip_id, 'FI' AS pays, CAST(row_number() OVER (PARTITION BY trip_id ORDER BY premier) - 1 AS INTEGER) AS rang,
        stop_id, arrival_time, arrival_delay, departure_time, departure_delay FROM (
        SELECT user_id||'_'||strftime(make_timestamp(block * 604800000000), '%Y%m%d') AS trip_id, CAST(k AS VARCHAR) AS stop_id, MIN(event_id) AS premier,
          arg_max(sec, event_id) FILTER (WHERE event_type = 'view') AS arrival_time,
          arg_max(d, event_id) FILTER (WHERE event_type = 'view') AS arrival_delay,
          arg_max(sec, event_id) FILTER (WHERE event_type <> 'view') AS departure_time,
          arg_max(d, event_id) FILTER (WHERE event_type <> 'view') AS departure_delay
        FROM (SELECT *, CASE WHEN event_type = 'click' THEN 0 ELSE (late // 15 + 20) * 15 END AS d FROM ev)
        WHERE event_type <> 'error' GROUP BY 1, 2)"""
add(
    "rt2_finnish_messages",
    lambda v: _stop_rows(messages.finnish_messages(v.live_fi, F.lit(NOW).cast("bigint")), "trip_id", "pays"),
    FINNISH_SQL,
)
add(
    "str6_default_country",
    lambda v: messages.with_default_country(
        v.messages.withColumn("pays", F.when(F.col("pays") != "IT", F.col("pays")))
    ).groupBy("pays").agg(F.count("*").alias("n")),
    """SELECT CASE WHEN pays = 'IT' THEN 'FR' ELSE pays END AS pays, COUNT(DISTINCT trip_id) AS n FROM stops GROUP BY 1""",
)
add(
    "snk9_keyed_messages",
    lambda v: _stop_rows(
        writers.keyed_messages(v.messages).select("key", F.from_json("value", TRIP_MESSAGE).alias("m")).select("key", "m.*"),
        "key", "trip_id", "pays", "feed_timestamp",
    ),
    """SELECT trip_id AS key, trip_id, pays, MAX(sec) OVER (PARTITION BY trip_id, route_id, pays) AS feed_timestamp,
        CAST(row_number() OVER (PARTITION BY trip_id, route_id, pays ORDER BY event_id) - 1 AS INTEGER) AS rang, stop_id,
        a_time AS arrival_time, a_delay AS arrival_delay, d_time AS departure_time, d_delay AS departure_delay FROM stops""",
)

# Positions
add("rt3_interpolate", lambda v: v.positions.drop("stops", "feed_timestamp", "captured_at"), "SELECT * FROM positions")


def _resolved(v) -> DataFrame:
    rows = v.stop_events.select("event_id", "pays", "stop_id")
    return realtime.resolve_stops(rows, gtfs.stop_uic(v.ch_stops), v.lookup)


add(
    "rt4_resolve_stops",
    _resolved,
    f"""SELECT event_id, pays, stop_id, CASE WHEN pays IN ('FR','CH','NL') OR l.cle IS NOT NULL THEN k.cle END AS cle
        FROM (SELECT s.event_id, s.pays, s.stop_id, {station_key('s.stop_id', 's.pays', 'm.code_uic')} AS cle
          FROM stops s LEFT JOIN sloid m ON s.pays = 'CH' AND m.stop_id = s.stop_id) k
        LEFT JOIN lookup l ON l.cle = k.cle""",
)


def _located(v) -> DataFrame:
    placed = realtime.located(v.positions, gtfs.stop_uic(v.ch_stops), v.lookup)
    return placed.select(
        "trip_id", "pays", "statut", "gare_precedente", "gare_suivante", "progression",
        F.bround("_latitude", 5).alias("latitude"), F.bround("_longitude", 5).alias("longitude"),
    )


add(
    "rt6_positions",
    _located,
    """SELECT trip_id, pays, statut, gare_precedente, gare_suivante, progression, round_even(lat_,5) AS latitude,
        round_even(lon_,5) AS longitude FROM placed""",
)


def _with_dwell(v) -> DataFrame:
    placed = realtime.located(v.positions, gtfs.stop_uic(v.ch_stops), v.lookup, include_dwell=True)
    return placed.groupBy("pays", "statut").agg(F.count("*").alias("n"))


_ANYWHERE = CTES["placed"].replace(" WHERE cle_prev <> cle_next", "")
add(
    "rt6_positions_with_dwell",
    _with_dwell,
    f"SELECT pays, statut, COUNT(*) AS n FROM ({_ANYWHERE}) GROUP BY pays, statut",
)
add(
    "rt10_disruption_causes",
    lambda v: realtime.disruption_causes(v.disruptions, ["event_id"]),
    "SELECT numero_train, cause, gravite FROM causes",
)
add("rt11_alert_causes", lambda v: realtime.alert_causes(v.alerts, ["event_id"]), "SELECT trip_id, cause FROM avis")
_LIVE = [
    "trip_id", "route_id", "pays", "ligne", "operateur", "statut", "gare_precedente", "gare_suivante",
    "progression", "latitude", "longitude", "retard_s", "cause_retard",
]
add(
    "rt12_live_trains",
    lambda v: v.live.select(*_LIVE, F.unix_timestamp("maj").alias("maj")),
    f"SELECT {', '.join(_LIVE)}, maj FROM live",
)
add("rt14_live_summary", lambda v: realtime.live_summary(v.live), """
    SELECT COUNT(*) AS trains, COUNT(*) FILTER (WHERE retard_s < 120) AS ok,
      COUNT(*) FILTER (WHERE retard_s BETWEEN 120 AND 600) AS warn, COUNT(*) FILTER (WHERE retard_s > 600) AS crit,
      COUNT(*) FILTER (WHERE retard_s IS NULL) AS idle, CAST(floor(AVG(retard_s) / 60 + 0.5) AS BIGINT) AS retard_moyen_min
    FROM live""")


_MARKERS = """SELECT trip_id, latitude, longitude FROM live WHERE latitude BETWEEN -60 AND 60 AND longitude BETWEEN -150 AND 150
        ORDER BY trip_id LIMIT 500"""


def _markers_by_place(v) -> DataFrame:
    """The markers of a box, out of a live view that is laid out by place."""
    path = scratch_dir(v.spark, "live")
    writers.replace_by_place(v.live_table.drop("stops"), path, 8)
    read = v.spark.read.parquet(path)
    return realtime.map_markers(read, -60.0, -150.0, 60.0, 150.0).select("trip_id", "latitude", "longitude")


add(
    "sl5_map_markers",
    lambda v: realtime.map_markers(v.live, -60.0, -150.0, 60.0, 150.0).select("trip_id", "latitude", "longitude"),
    _MARKERS,
)
add("sl5_markers_by_place", _markers_by_place, _MARKERS)
add(
    "fn13_delay_texts",
    lambda v: v.stop_events.select(
        "event_id",
        labels.delay_status(F.col("arrival_delay")).alias("statut"),
        labels.delay_text(F.col("arrival_delay")).alias("texte"),
        labels.route_label(F.lit(None).cast("string"), F.col("route_id"), F.concat(F.lit("x:TER:"), "trip_id")).alias("ligne"),
    ),
    """SELECT event_id, CASE WHEN a_delay IS NULL THEN 'idle' WHEN a_delay < 120 THEN 'ok' WHEN a_delay <= 600 THEN 'warn'
        ELSE 'crit' END AS statut, CASE WHEN a_delay IS NULL THEN 'inconnu' WHEN floor(a_delay / 60 + 0.5) = 0 THEN 'à l''heure'
        ELSE '+' || CAST(floor(a_delay / 60 + 0.5) AS BIGINT) || ' min' END AS texte, COALESCE(route_id, 'TER') AS ligne FROM stops""",
)
_USABLE_KEYS = f"""SELECT u.trip_id, u.pays, u.i, p.index_restant,
    {station_key('u.stop_id', 'u.pays', 'm.code_uic')} AS cle FROM usable u JOIN live p ON p.trip_id = u.trip_id
    LEFT JOIN sloid m ON u.pays = 'CH' AND m.stop_id = u.stop_id"""
_SIDES = f"""SELECT k.trip_id, k.troncon, k.i, k.cle, l.latitude, l.longitude FROM (
    SELECT trip_id, 'parcouru' AS troncon, i, cle FROM ({_USABLE_KEYS}) WHERE i <= index_restant UNION ALL
    SELECT trip_id, 'restant', i, cle FROM ({_USABLE_KEYS}) WHERE i >= index_restant) k JOIN lookup l ON l.cle = k.cle"""
_ROUTE = f"""SELECT trip_id, troncon, CAST(row_number() OVER (PARTITION BY trip_id, troncon ORDER BY i) AS INTEGER) AS rang,
    latitude, longitude FROM (SELECT *, lag(cle) OVER (PARTITION BY trip_id, troncon ORDER BY i) AS avant FROM ({_SIDES}))
    WHERE avant IS NULL OR avant <> cle"""
add(
    "rt7_station_route",
    lambda v: realtime.station_route(v.live_table, gtfs.stop_uic(v.ch_stops), v.lookup),
    _ROUTE,
)


def _train_shapes(v) -> tuple[DataFrame, DataFrame]:
    """Dutch trains with a track: trips of the timetable that carry the train's id."""
    shapes_of_trips = v.live_table.select("trip_id", F.concat(F.lit("SH"), F.split_part("trip_id", F.lit("-"), F.lit(1))).alias("shape_id"))
    return shapes_of_trips.filter(F.col("trip_id").rlike("^[0-9]+-")), gtfs.shape_points(v.shapes)


def _trip_shape(v) -> DataFrame:
    shapes_of_trips, points = _train_shapes(v)
    return realtime.trip_shape(v.live_table, shapes_of_trips, points)


_TRACK = """SELECT p.trip_id, s.seq, s.latitude, s.longitude, p.lat_, p.lon_ FROM live p
    JOIN shape_pts s ON s.shape_id = 'SH'||split_part(p.trip_id,'-',1) WHERE p.pays = 'NL'"""
add(
    "rt9_trip_shape",
    _trip_shape,
    f"SELECT trip_id, seq AS shape_pt_sequence, latitude, longitude FROM ({_TRACK})",
)
_CUT = f"""SELECT *, first_value(seq) OVER (PARTITION BY trip_id ORDER BY
    power(latitude - lat_, 2) + power(longitude - lon_, 2), seq) AS cut FROM ({_TRACK})"""
_SPLIT = f"""SELECT trip_id, 'parcouru' AS troncon, seq AS rang, latitude, longitude FROM ({_CUT}) WHERE seq <= cut UNION ALL
    SELECT trip_id, 'restant', seq, latitude, longitude FROM ({_CUT}) WHERE seq >= cut"""
add("rt8_split_shape", lambda v: realtime.split_shape(_trip_shape(v), v.live_table), _SPLIT)


def _itinerary(v) -> DataFrame:
    shapes_of_trips, points = _train_shapes(v)
    return realtime.itinerary(v.live_table, gtfs.stop_uic(v.ch_stops), v.lookup, shapes_of_trips, points)


add(
    "rt12_itineraries",
    _itinerary,
    f"""SELECT * FROM ({_SPLIT}) UNION ALL SELECT * FROM ({_ROUTE})
        WHERE trip_id NOT IN (SELECT trip_id FROM ({_TRACK}))""",
)

# Access log
add("lg1_request_counts", lambda v: accesslog.request_counts(v.log),
    "SELECT method, template AS path, status, COUNT(*) AS n FROM log GROUP BY ALL")
add("lg2_totals", lambda v: accesslog.totals(v.log),
    "SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE status >= 400) AS erreurs FROM log")
add("lg3_by_status", lambda v: accesslog.by_status(v.log), "SELECT status, COUNT(*) AS n FROM log GROUP BY 1")
_BOUNDS = ", ".join(f"({b}e0)" for b in accesslog.LATENCY_BOUNDS)
add(
    "lg4_latency_histogram",
    lambda v: accesslog.latency_histogram(v.log),
    f"""SELECT method, path, borne_s, COUNT(*) FILTER (WHERE duration_s <= borne_s) AS n FROM (
        SELECT method, template AS path, duration_s, b.borne_s FROM log,
          (VALUES {_BOUNDS}, (CAST('infinity' AS DOUBLE))) b(borne_s)) GROUP BY ALL""",
)
_MASKED = "split_part(ip,'.',1)||'.'||split_part(ip,'.',2)||'.0.0'"
add(
    "lg5_anonymized_log",
    lambda v: accesslog.anonymized(v.log).select("ip", "path", "status", "api_key"),
    f"SELECT {_MASKED} AS ip, path, status, api_key FROM log",
)


def _v6(v) -> DataFrame:
    """Callers by IPv6 address, some in short form, and by what is no address."""
    user, event = F.hex(F.pmod("user_id", F.lit(65_536))), F.hex(F.pmod("event_id", F.lit(65_536)))
    ip = (
        F.when(F.col("event_type") == "view", F.concat(F.lit("2001:db8:"), user, F.lit(":0:0:"), event, F.lit(":1:2")))
        .when(F.col("event_type") == "click", F.concat(F.lit("fe80::"), user))
        .when(F.col("event_type") == "purchase", F.concat(user, F.lit("::")))
        .when(F.col("event_type") == "error", F.concat(F.lit("host-"), user))
    )
    return accesslog.anonymized(v.table("events").select("event_id", ip.alias("ip")))


add(
    "lg5_anonymized_v6",
    _v6,
    """SELECT event_id, CASE event_type WHEN 'view' THEN '2001:db8:'||upper(hex(user_id % 65536))||':0:0:0:0:0'
        WHEN 'click' THEN 'fe80::'||upper(hex(user_id % 65536)) WHEN 'purchase' THEN upper(hex(user_id % 65536))||'::'
        ELSE 'unknown' END AS ip FROM events""",
)
add(
    "lg5_log_lines",
    lambda v: accesslog.log_lines(v.log).select("ligne"),
    f"""SELECT {_MASKED}||' - "'||method||' '||path||'" '||status AS ligne FROM log""",
)
_MINUTE = "CAST(epoch(date_trunc('minute', ts)) AS BIGINT)"


def _start(df: DataFrame) -> DataFrame:
    return df.withColumn("debut", F.unix_timestamp("debut"))


add(
    "str10_request_rate",
    lambda v: _start(accesslog.request_rate(v.log)),
    f"SELECT {_MINUTE} AS debut, template AS path, COUNT(*) / 60e0 AS par_seconde FROM log GROUP BY ALL",
)


def _p95(v) -> DataFrame:
    out = accesslog.latency_quantiles(v.log, 0.95, "1 day", "12 hours")
    return _start(out).select("debut", "path", "latence_s")


def quantile_sql(slots: str = "(0), (43200)", slide: int = 43200, keep: str = "true") -> str:
    bounds = accesslog.LATENCY_BOUNDS
    cumulative = ", ".join(f"COUNT(*) FILTER (WHERE duration_s <= {b}) AS le{i}" for i, b in enumerate(bounds))
    cases = " ".join(
        f"WHEN le{i} >= 0.95e0 * n THEN {bounds[i - 1] if i else 0}e0 + ({b}e0 - {bounds[i - 1] if i else 0}e0) * "
        f"((0.95e0 * n - {f'le{i - 1}' if i else 0}) / NULLIF(le{i} - {f'le{i - 1}' if i else 0}, 0))"
        for i, b in enumerate(bounds)
    )
    return f"""SELECT debut, path, CASE {cases} ELSE {bounds[-1]}e0 END AS latence_s FROM (
        SELECT debut, path, COUNT(*) AS n, {cumulative} FROM (
          SELECT CAST(floor(epoch(ts)) AS BIGINT) // {slide} * {slide} - o AS debut, template AS path, duration_s
          FROM log, (VALUES {slots}) d(o)) WHERE {keep} GROUP BY debut, path)"""


add("str11_latency_p95", _p95, quantile_sql())


def ranked_right(latency: DataFrame, log: DataFrame, slot: int, slots: int) -> DataFrame:
    """Each window and path of the sketches or of the log, the requests of the sketch, and whether the rank of
    its latency is what it should be, give or take twice the published error."""
    keys = ["debut", "path"]
    first = F.floor(F.unix_timestamp("ts") / slot) * slot
    starts = F.sequence(first - slot * (slots - 1), first, F.lit(slot))
    rows = log.select(F.explode(starts).alias("debut"), accesslog.path_template(F.col("path")).alias("path"), "duration_s")
    met = rows.join(_start(latency), keys, "full").groupBy(*keys).agg(
        F.max("n").alias("n"),
        F.count("duration_s").alias("all"),
        F.count_if(F.col("duration_s") <= F.col("latence_s")).alias("upto"),
        F.count_if(F.col("duration_s") < F.col("latence_s")).alias("below"),
    )
    slack = F.col("all") * 2 * sketches.rank_error() + 1
    right = (F.col("upto") >= 0.95 * F.col("all") - slack) & (F.col("below") <= 0.95 * F.col("all") + slack)
    return met.select(*keys, "n", (right & F.col("n").isNotNull()).alias("juste"))


def _sketched(v) -> DataFrame:
    slots = accesslog.latency_sketches(v.log, 43_200)
    return ranked_right(accesslog.sketched_latency(slots, 0.95, 43_200, 2), v.log, 43_200, 2)


add(
    "str11_latency_p95_sketch",
    _sketched,
    """SELECT CAST(floor(epoch(ts)) AS BIGINT) // 43200 * 43200 - o AS debut, template AS path, COUNT(*) AS n, true AS juste
        FROM log, (VALUES (0), (43200)) d(o) GROUP BY ALL""",
)
add(
    "str12_quota_breaches",
    lambda v: _start(accesslog.quota_breaches(v.log, "api_key", 2, "1 day")),
    """SELECT CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS debut, api_key AS appelant, template AS path, COUNT(*) AS n
        FROM log GROUP BY ALL HAVING COUNT(*) > 2""",
)
add(
    "fn6_train_numbers",
    lambda v: v.messages.select("trip_id", ids.train_number(F.col("trip_id")).alias("numero")),
    """SELECT DISTINCT trip_id, CAST(CASE WHEN pays = 'FR' THEN user_id END AS VARCHAR) AS numero FROM stops""",
)

# Data quality
_DOC = ["doc_id", "text", "lang", "source", "n_chars"]
add(
    "dq1_row_and_null_counts",
    lambda v: quality.row_and_null_counts(v.trips.withColumn("trip_long_name", F.nullif("trip_long_name", F.lit(""))), "trips"),
    """SELECT 'trips' AS source, 'lignes' AS mesure, '' AS colonne, COUNT(*) AS valeur FROM trips UNION ALL
        SELECT 'trips', 'colonnes', '', 4 UNION ALL
        SELECT 'trips', 'nuls', 'trip_long_name', COUNT(*) FROM trips WHERE trip_long_name = ''""",
)
add(
    "dq3_duplicates",
    lambda v: quality.duplicate_count(v.table("documents").select("text", "lang"), "documents"),
    """SELECT 'documents' AS source, 'doublons' AS mesure, '' AS colonne,
        (SELECT COUNT(*) FROM documents) - (SELECT COUNT(*) FROM (SELECT DISTINCT text, lang FROM documents)) AS valeur""",
)
add(
    "dq4_outliers",
    lambda v: quality.outlier_count(v.table("lineitem"), "l_extendedprice", "lineitem"),
    """SELECT 'lineitem' AS source, 'aberrants_p99' AS mesure, 'l_extendedprice' AS colonne, COUNT(*) AS valeur FROM lineitem
        WHERE l_extendedprice > (SELECT quantile_cont(l_extendedprice, 0.99) FROM lineitem)""",
)


def _outliers_by_sketch(v) -> DataFrame:
    """The exact count, and whether that of the sketch is near it."""
    items, keys = v.table("lineitem"), ["source", "mesure", "colonne"]
    exact = quality.outlier_count(items, "l_extendedprice", "lineitem").withColumnRenamed("valeur", "exact")
    near = quality.outlier_count(items, "l_extendedprice", "lineitem", accuracy=4_000)
    # A hundredth of the rows lies above; the error is a share of all of them.
    slack = 1 + F.col("exact") * 100 * 2 * sketches.rank_error(4_000)
    return exact.join(near, keys).select(*keys, "exact", (F.abs(F.col("valeur") - F.col("exact")) <= slack).alias("proche"))


add(
    "dq4_outliers_sketch",
    _outliers_by_sketch,
    """SELECT 'lineitem' AS source, 'aberrants_p99' AS mesure, 'l_extendedprice' AS colonne, COUNT(*) AS exact, true AS proche
        FROM lineitem WHERE l_extendedprice > (SELECT quantile_cont(l_extendedprice, 0.99) FROM lineitem)""",
)


def _profile(v) -> DataFrame:
    return quality.profile_sources(
        [
            ("regularite_tgv.csv", v.tgv, None),
            ("regularite_ter.csv", v.ter, None),
            ("regularite_intercites.csv", v.intercites, None),
            ("gares.csv", v.gares, None),
            ("tarifs_tgv_ouigo.csv", v.tgv_fares, "Prix maximum"),
            ("tarifs_intercites.csv", v.ic_fares, "Prix maximum"),
        ]
    )


def _profile_sql() -> str:
    tgv = "(SELECT * FROM fact WHERE type_ligne = 'grande_vitesse')"
    ter = "(SELECT * FROM fact WHERE type_ligne = 'regional')"
    ic = "(SELECT * FROM fact WHERE type_ligne = 'intercite')"
    fare = "(SELECT transporteur, gare_origine, gare_destination, classe, profil_tarifaire, prix_minimum, prix_maximum FROM fares_base WHERE source_file = '%s')"
    parts = []
    for name, src, columns in (
        ("regularite_tgv.csv", tgv, 7),
        ("regularite_ter.csv", ter, 6),
        ("regularite_intercites.csv", ic, 7),
        ("gares.csv", "dim_fr", 7),
        ("tarifs_tgv_ouigo.csv", fare % "tarifs_tgv_ouigo.csv", 7),
        ("tarifs_intercites.csv", fare % "tarifs_intercites.csv", 7),
    ):
        parts.append(f"SELECT '{name}' AS source, 'lignes' AS mesure, '' AS colonne, COUNT(*) AS valeur FROM {src}")
        parts.append(f"SELECT '{name}', 'colonnes', '', {columns}")
        parts.append(f"SELECT '{name}', 'doublons', '', (SELECT COUNT(*) FROM {src}) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM {src}))")
        if name.startswith("tarifs"):
            parts.append(
                f"""SELECT '{name}', 'aberrants_p99', 'Prix maximum', COUNT(*) FROM {src}
                    WHERE prix_maximum > (SELECT quantile_cont(prix_maximum, 0.99) FROM {src})"""
            )
    parts.append(
        f"""SELECT * FROM (SELECT 'regularite_tgv.csv', 'nuls', 'Retard moyen de tous les trains à l''arrivée', COUNT(*) AS n FROM {tgv}
            WHERE retard_moyen_tous_trains_arrivee_min IS NULL) WHERE n > 0"""
    )
    return " UNION ALL ".join(parts)


add("dq8_profile_sources", _profile, _profile_sql())
add(
    "dq6_unique_violations",
    lambda v: quality.unique_violations(v.trips, "trip_id"),
    "SELECT trip_id, COUNT(*) AS n FROM trips GROUP BY 1 HAVING COUNT(*) > 1",
)
add(
    "dq5_not_null_violations",
    lambda v: quality.not_null_violations(v.ch_stops, "didok").select("stop_id"),
    "SELECT stop_id FROM ch_stops WHERE didok IS NULL",
)
add(
    "dq7_accepted_values",
    lambda v: quality.accepted_values_violations(v.table("events"), "event_type", ["view", "click", "purchase"]),
    "SELECT event_type, COUNT(*) AS n FROM events WHERE event_type NOT IN ('view','click','purchase') GROUP BY 1",
)


def _column_tests(v) -> DataFrame:
    return quality.column_tests(
        v.dim_stations, gtfs.stop_uic(v.ch_stops), gtfs.shape_points(v.shapes), v.fact_table, COUNTRIES, LINE_TYPES
    )


add(
    "dq5_to_7_column_tests",
    _column_tests,
    """SELECT 'unique_dim_stations_id_gare' AS test, COUNT(*) AS violations FROM (
          SELECT id_gare FROM dim WHERE id_gare IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1)
        UNION ALL SELECT 'not_null_dim_stop_uic_stop_id', COUNT(*) FROM ch_stops WHERE didok <> '' AND stop_id IS NULL
        UNION ALL SELECT 'not_null_dim_shapes_shape_id', COUNT(*) FROM shape_pts WHERE shape_id IS NULL
        UNION ALL SELECT 'accepted_dim_stations_pays', COUNT(*) FROM (SELECT DISTINCT pays FROM dim
          WHERE pays NOT IN ('FR','CH','NL','IT','FI','PL','DE','SE'))
        UNION ALL SELECT 'accepted_fact_type_ligne', COUNT(*) FROM (SELECT DISTINCT type_ligne FROM fact
          WHERE type_ligne NOT IN ('grande_vitesse','regional','intercite'))
        UNION ALL SELECT 'not_null_dim_stations_id_gare', COUNT(*) FROM dim WHERE id_gare IS NULL
        UNION ALL SELECT 'not_null_dim_stations_station_id', COUNT(*) FROM dim WHERE station_id IS NULL
        UNION ALL SELECT 'not_null_dim_stations_pays', COUNT(*) FROM dim WHERE pays IS NULL
        UNION ALL SELECT 'not_null_fact_mois', COUNT(*) FROM fact WHERE mois IS NULL
        UNION ALL SELECT 'not_null_fact_type_ligne', COUNT(*) FROM fact WHERE type_ligne IS NULL""",
)
