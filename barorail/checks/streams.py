"""Streaming queries and exports, run on the given tables and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import gtfs, harmonize, messages
from ..plans.analytics import consolidated
from ..plans.realtime import alert_causes, disruption_causes, fresh
from ..plans.stations import stations_fi, stations_fr
from ..schemas import (
    ALERTS,
    DISRUPTIONS,
    FI_STATIONS,
    GARES,
    GTFS_ROUTES,
    GTFS_TRIPS,
    INTERCITES_MONTHLY,
    TER_MONTHLY,
    TGV_MONTHLY,
    TRIP_MESSAGE,
)
from ..session import scratch_dir
from ..sinks import writers
from ..sources import readers
from ..sources.snapshots import snapshot_feeds
from ..streaming import ingest, state, telemetry
from .facts import CONSOLIDATED, FACT, SLICE
from .live import _FEED, FINNISH_SQL, _start, _stop_rows, quantile_sql, ranked_right
from .registry import add
from .views import NOW, Views


class StreamViews(Views):
    """The same inputs with one table read as a stream."""

    def __init__(self, spark: SparkSession, sf_dir: str, streamed: str):
        super().__init__(spark, sf_dir)
        schema = self.table(streamed).schema
        # As a pattern: the stream source takes a folder or a pattern, and the table may be a file.
        self._tables[streamed] = self.spark.readStream.schema(schema).parquet(f"{sf_dir}/{{{streamed}}}.parquet")


def _streamed(v: Views, table: str) -> StreamViews:
    return StreamViews(v.spark, v.sf_dir, table)


def _published(v: Views) -> DataFrame:
    """Snapshots to resolved message lines, through a stream."""
    out = scratch_dir(v.spark, "messages")
    stop_map = messages.write_timetable(v.stop_map, f"timetable_{uuid.uuid4().hex}", scratch_dir(v.spark, "timetable"))

    def to_messages(feeds: DataFrame) -> DataFrame:
        return messages.trip_messages(
            feeds, "PL", stop_map=stop_map, captured_at=F.lit(NOW).cast("bigint"), map_is_reduced=True
        )

    ingest.publish_stream(
        _streamed(v, "lineitem").feeds, to_messages, out, scratch_dir(v.spark, "checkpoint"), once=True
    ).awaitTermination()
    return _stop_rows(v.spark.read.schema(TRIP_MESSAGE).json(f"{out}/batch=*"), "trip_id", "feed_timestamp")


_MAP_LAST = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY trip_id, stop_sequence ORDER BY stop_id DESC NULLS LAST,
    arrival_seconds DESC NULLS LAST, departure_seconds DESC NULLS LAST) AS rn FROM stop_map) WHERE rn = 1"""
_MIDNIGHT = "CAST(epoch(timezone('Europe/Warsaw', l_shipdate)) AS BIGINT)"
add(
    "str3_published_messages",
    _published,
    f"""SELECT f.trip_id, f.instant AS feed_timestamp, 0 AS rang,
        CASE WHEN f.stop_id <> '' THEN f.stop_id ELSE COALESCE(m.stop_id, '') END AS stop_id, f.instant AS arrival_time,
        f.instant - ({_MIDNIGHT} + m.arrival_seconds) AS arrival_delay, f.instant + 60 AS departure_time,
        COALESCE(f.d_delay, f.instant + 60 - ({_MIDNIGHT} + m.departure_seconds)) AS departure_delay
        FROM ({_FEED}) f LEFT JOIN ({_MAP_LAST}) m ON m.trip_id = f.trip_id AND m.stop_sequence = f.seq""",
)


def _polled(v: Views) -> DataFrame:
    """Snapshots of two countries, polled by a stream that stops after the first ones and goes on with the others."""
    root, out, checkpoint = (scratch_dir(v.spark, name) for name in ("snapshots", "messages", "checkpoint"))
    folders = {pays: f"{root}/{pays}" for pays in ("PL", "SE")}
    turn = F.pmod(F.floor(F.col("header.timestamp") / 1800), F.lit(4))  # country and snapshot of a feed
    feeds = v.feeds.select("header", "entity")

    def land(names: dict[str, tuple[int, str]]) -> None:
        for pays, (which, name) in names.items():
            feeds.where(turn == which).write.json(f"{folders[pays]}/{name}", compression="gzip")

    def poll() -> None:
        stream = snapshot_feeds(v.spark, folders)
        shape = lambda batch: ingest.country_messages(batch, {}, {}, {}, F.lit(NOW).cast("bigint"))
        ingest.publish_stream(stream, shape, out, checkpoint, once=True).awaitTermination()

    land({"PL": (0, "001"), "SE": (1, "001")})
    poll()
    poll()  # nothing new
    land({"PL": (2, "002")})
    poll()
    land({"SE": (3, "002")})
    poll()
    read = v.spark.read.schema(TRIP_MESSAGE).json(f"{out}/batch=*")
    return _stop_rows(read, "trip_id", "pays", "feed_timestamp").select("trip_id", "pays", "feed_timestamp", "stop_id", "arrival_time")


add(
    "str1_polled_snapshots",
    _polled,
    f"""SELECT trip_id, CASE WHEN instant // 1800 % 2 = 0 THEN 'PL' ELSE 'SE' END AS pays, instant AS feed_timestamp,
        stop_id, instant AS arrival_time FROM ({_FEED})""",
)


def _latest(v: Views) -> DataFrame:
    """Latest state per trip, through a stream; the arrival order is the order of the stop events."""
    path = scratch_dir(v.spark, "state")
    stop = ["stop_id", "arrival_time", "arrival_delay", "departure_time", "departure_delay"]
    rows = _streamed(v, "events").stop_events
    arriving = rows.select(
        "trip_id",
        "route_id",
        F.when(F.col("pays") != "SE", F.col("pays")).alias("pays"),
        F.array(F.struct(*stop)).alias("stops"),
        F.col("at").alias("feed_timestamp"),
        (F.col("at") + 5).alias("captured_at"),
        F.struct("event_id").alias("arrivee"),
    )
    state.upsert_stream(
        arriving, path, scratch_dir(v.spark, "checkpoint"), once=True,
        clock=lambda: F.timestamp_seconds(F.lit(NOW)),
    ).awaitTermination()
    state.compact(v.spark, path, upto=0)
    return _stop_rows(state.current_state(v.spark, path), "trip_id", "route_id", "pays", "feed_timestamp")


add(
    "str7_latest_state",
    _latest,
    """SELECT trip_id, route_id, CASE WHEN pays = 'SE' THEN 'FR' ELSE pays END AS pays, sec AS feed_timestamp, 0 AS rang,
        stop_id, a_time AS arrival_time, a_delay AS arrival_delay, d_time AS departure_time, d_delay AS departure_delay
        FROM (SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY event_id DESC) AS rn FROM stops) WHERE rn = 1""",
)
def _replayed(v: Views) -> DataFrame:
    """The state after messages, their replays with a newer message for every second trip, and very late ones.

    Each of the three comes as a folder of its own and a micro-batch, or several, of its own. Trips last
    updated before the expiry are gone.
    """
    folders, path, checkpoint = (scratch_dir(v.spark, name) for name in ("arriving", "state", "checkpoint"))
    first = v.messages.where("trip_id IS NOT NULL")
    even = F.pmod(F.xxhash64("trip_id"), F.lit(2)) == 0
    own = F.col("feed_timestamp") - F.when(even, 60).otherwise(0)
    newer = first.where(even).withColumn("feed_timestamp", F.col("feed_timestamp") + 60)
    late = first.withColumn("feed_timestamp", F.col("feed_timestamp") - 800 * 86_400)
    for name, sent in (("1", first), ("2", first.unionByName(newer)), ("3", late)):
        writers.publish_json(sent, f"{folders}/{name}")
        stream = v.spark.readStream.schema(TRIP_MESSAGE).json(f"{folders}/*").withColumn("arrivee", readers.arrival_order())
        # Of one trip's messages the newest comes last here; replays are no messages.
        ordered = state.once_each(stream, "400 days").withColumn("arrivee", F.struct("feed_timestamp"))
        query = state.upsert_stream(ordered, path, checkpoint, once=True, clock=lambda: F.timestamp_seconds(own))
        query.awaitTermination()
    batches = [int(r[0]) for r in v.spark.read.parquet(f"{path}/changes").select("batch_id").distinct().collect()]
    state.compact(v.spark, path, max(batches), expired_before=F.timestamp_seconds(F.lit(EXPIRY)))
    now = state.current_state(v.spark, path)
    return now.select("trip_id", "pays", own.alias("premier"), F.size("stops").alias("arrets"))


EXPIRY = NOW - 14 * 86_400
add(
    "str9_replayed_state",
    _replayed,
    f"""SELECT trip_id, pays, MAX(sec) AS premier, CAST(COUNT(*) AS INTEGER) AS arrets FROM stops
        WHERE trip_id IS NOT NULL GROUP BY 1, 2 HAVING MAX(sec) >= {EXPIRY}""",
)
add(
    "str8_fresh_state",
    lambda v: fresh(v.state, F.lit(NOW), 3600).select("trip_id", "pays", "feed_timestamp"),
    f"""SELECT trip_id, pays, MAX(sec) AS feed_timestamp FROM stops GROUP BY 1, 2 HAVING MAX(sec) > {NOW} - 3600""",
)


def _windows(v: Views, shape) -> DataFrame:
    """Windows of the access log stream that the watermark has closed."""
    out = scratch_dir(v.spark, "windows")
    log = _streamed(v, "events").log.withColumn("ts", F.col("ts").cast("timestamp"))
    windows = shape(log)
    telemetry.write_windows(windows, out, scratch_dir(v.spark, "checkpoint"), once=True).awaitTermination()
    return _start(v.spark.read.schema(windows.schema).parquet(out))


_CLOSED = "(SELECT CAST(floor(epoch(MAX(ts)) * 1000) AS BIGINT) / 1000e0 - 120 FROM events)"
_MINUTE = "CAST(epoch(date_trunc('minute', ts)) AS BIGINT)"
add(
    "str10_request_rate_stream",
    lambda v: _windows(v, telemetry.request_rate),
    f"""SELECT debut, path, COUNT(*) / 60e0 AS par_seconde FROM (SELECT {_MINUTE} AS debut, template AS path FROM log)
        WHERE debut + 60 <= {_CLOSED} GROUP BY debut, path""",
)
add(
    "str11_latency_p95_stream",
    lambda v: _windows(v, telemetry.latency_p95).drop("fin"),
    quantile_sql("(0), (60), (120), (180), (240)", 60, f"debut + 300 <= {_CLOSED}"),
)
def _sketch_stream(v: Views) -> DataFrame:
    """Sliding windows of five minutes from the sketches of closed minutes that a stream has left."""
    out = scratch_dir(v.spark, "sketches")
    log = _streamed(v, "events").log.withColumn("ts", F.col("ts").cast("timestamp"))
    slots = telemetry.latency_sketches(log)
    telemetry.write_windows(slots, out, scratch_dir(v.spark, "checkpoint"), once=True).awaitTermination()
    left = v.spark.read.schema(slots.schema).parquet(out)
    closed = F.floor(F.unix_timestamp("ts") / 60) * 60 + 60 <= v.log.agg(F.max(F.unix_millis(F.col("ts").cast("timestamp"))) / 1000 - 120).scalar()
    return ranked_right(telemetry.accesslog.sketched_latency(left), v.log.where(closed), 60, 5)


add(
    "str11_latency_p95_sketch_stream",
    _sketch_stream,
    f"""SELECT slot - o AS debut, path, COUNT(*) AS n, true AS juste
        FROM (SELECT {_MINUTE} AS slot, template AS path FROM log), (VALUES (0), (60), (120), (180), (240)) d(o)
        WHERE slot + 60 <= {_CLOSED} GROUP BY ALL""",
)
add(
    "str12_quota_breaches_stream",
    lambda v: _windows(v, lambda log: telemetry.accesslog.quota_breaches(telemetry.watched(log), "api_key", 1, "1 hour")),
    f"""SELECT debut, appelant, path, COUNT(*) AS n FROM (
        SELECT CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS debut, api_key AS appelant, template AS path FROM log)
        WHERE debut + 3600 <= {_CLOSED} GROUP BY debut, appelant, path HAVING COUNT(*) > 1""",
)


# Exports read back with the library's own readers
def _monthly_files(v: Views) -> DataFrame:
    """The three monthly sources as semicolon files, harmonised from there."""
    raw = {}
    for name, df, schema in (
        ("tgv", v.tgv, TGV_MONTHLY), ("ter", v.ter, TER_MONTHLY), ("ic", v.intercites, INTERCITES_MONTHLY)
    ):
        path = scratch_dir(v.spark, name)
        writers.export_csv(df, path, sep=";")
        raw[name] = readers.read_semicolon_csv(v.spark, path, schema)
    return harmonize.harmonize(raw["tgv"], raw["ter"], raw["ic"])


add("src1_monthly_files", _monthly_files, f"SELECT {FACT} FROM fact")


def _station_file(v: Views) -> DataFrame:
    path = scratch_dir(v.spark, "gares")
    writers.export_csv(v.gares, path, sep=";", order_by=["Id_Gare"])
    return stations_fr(readers.read_semicolon_csv(v.spark, path, GARES))


add("src1_station_file", _station_file, f"SELECT {SLICE} FROM dim_fr")


def _station_export(v: Views) -> DataFrame:
    path = scratch_dir(v.spark, "stations")
    writers.export_stations(v.dim_stations, path)
    return v.spark.read.schema(v.dim_stations.schema).csv(path, header=True, sep=";", escape='"')


add("snk3_station_export", _station_export, f"SELECT id_gare, {SLICE} FROM dim")


def _gtfs_files(v: Views) -> DataFrame:
    paths = {name: scratch_dir(v.spark, name) for name in ("trips", "routes")}
    writers.export_csv(v.trips, paths["trips"])
    writers.export_csv(v.routes, paths["routes"])
    return gtfs.rail_trips(
        readers.read_gtfs_csv(v.spark, paths["trips"], GTFS_TRIPS),
        readers.read_gtfs_csv(v.spark, paths["routes"], GTFS_ROUTES),
        extended=True,
    )


add(
    "src2_timetable_files",
    _gtfs_files,
    "SELECT t.trip_id FROM trips t JOIN routes r ON r.route_id = t.route_id WHERE r.route_type BETWEEN 100 AND 117",
)


def _map_file(v: Views) -> DataFrame:
    path = scratch_dir(v.spark, "map")
    writers.export_csv(v.stop_map, path)
    return readers.read_stop_sequence_map(v.spark, path)


add(
    "src9_stop_sequence_file",
    _map_file,
    "SELECT trip_id, stop_sequence, stop_id, arrival_seconds, departure_seconds FROM stop_map",
)


def _allowlist(v: Views) -> DataFrame:
    path = scratch_dir(v.spark, "allowlist")
    writers.export_allowlist(gtfs.rail_trips(v.trips, v.basic_routes, extended=False), "trip_id", path)
    return readers.read_allowlist(v.spark, path, "trip_id")


add("src8_allowlist_file", _allowlist, "SELECT DISTINCT trip_id FROM rail")


def _fi_json(v: Views) -> DataFrame:
    path = scratch_dir(v.spark, "fi")
    v.fi_stations.write.json(path)
    return stations_fi(readers.read_json_lines(v.spark, path, FI_STATIONS))


def _array_files(v: Views, df: DataFrame, label: str) -> str:
    """Files of one JSON array each, of at most a thousand objects."""
    path = scratch_dir(v.spark, label)
    rows = df.select(F.to_json(F.struct(*df.columns)).alias("value"))
    rows = v.written(label, rows.withColumn("at", F.monotonically_increasing_id()))
    whole = F.concat(F.lit("["), F.array_join(F.collect_list("value"), ","), F.lit("]"))
    files = rows.groupBy(F.floor(F.col("at") / 1000).alias("file")).agg(whole.alias("value"))
    files.repartition("file").write.partitionBy("file").text(path)
    return path


add(
    "src3_station_json_array",
    lambda v: stations_fi(readers.read_json_array(v.spark, _array_files(v, v.fi_stations, "fi"), FI_STATIONS)),
    f"SELECT {SLICE} FROM dim_fi",
)
add(
    "src12_live_train_files",
    lambda v: _stop_rows(
        messages.finnish_messages(
            readers.read_live_trains(v.spark, _array_files(v, v.live_fi, "trains")), F.lit(NOW).cast("bigint")
        ),
        "trip_id",
        "pays",
    ),
    FINNISH_SQL,
)
add("src3_station_json_lines", _fi_json, f"SELECT {SLICE} FROM dim_fi")


def _message_files(v: Views) -> DataFrame:
    path = scratch_dir(v.spark, "published")
    writers.publish_json(v.messages, path)
    return _stop_rows(readers.read_messages(v.spark, path), "trip_id", "route_id", "pays").drop("arrivee")


add(
    "src10_message_files",
    _message_files,
    """SELECT trip_id, route_id, pays, CAST(row_number() OVER (PARTITION BY trip_id ORDER BY event_id) - 1 AS INTEGER) AS rang,
        stop_id, a_time AS arrival_time, a_delay AS arrival_delay, d_time AS departure_time, d_delay AS departure_delay FROM stops""",
)


def _feed_files(v: Views) -> DataFrame:
    """Snapshots as files, read back with the file as their source."""
    path = scratch_dir(v.spark, "feeds")
    v.feeds.select("header", "entity").write.json(path)
    entities = messages.feed_entities(readers.read_feeds(v.spark, path))
    return entities.select("trip_id", "feed_timestamp", F.col("source_file").isNotNull().alias("a_source"))


add(
    "src11_feed_files",
    _feed_files,
    f"SELECT trip_id, instant AS feed_timestamp, true AS a_source FROM ({_FEED})",
)


def _cause_files(v: Views) -> DataFrame:
    path = scratch_dir(v.spark, "disruptions")
    v.disruptions.write.json(path)
    # One document per line here; the event number ranks them.
    documents = readers.read_json_lines(v.spark, path, f"event_id bigint, {DISRUPTIONS}")
    return disruption_causes(documents, ["event_id"])


add("src13_disruption_files", _cause_files, "SELECT numero_train, cause, gravite FROM causes")
add(
    "src13_disruption_arrays",
    lambda v: disruption_causes(
        readers.read_json_array(
            v.spark, _array_files(v, v.disruptions, "disruptions"), f"event_id bigint, {DISRUPTIONS}"
        ),
        ["event_id"],
    ),
    "SELECT numero_train, cause, gravite FROM causes",
)


def _undeclared(v: Views) -> DataFrame:
    """Disruptions of arrays with a field that no schema names, and that field beside the causes."""
    zoned = v.disruptions.withColumn("zone", F.struct(F.concat(F.lit("Z"), F.pmod("event_id", F.lit(7))).alias("code")))
    read = readers.read_json_variants(v.spark, _array_files(v, zoned, "zones"), f"event_id bigint, {DISRUPTIONS}")
    zones = read.select("event_id", F.try_variant_get("brut", "$.zone.code", "string").alias("zone"))
    causes = disruption_causes(read.drop("brut"), ["event_id"]).agg(F.count("*").alias("causes"))
    per_zone = zones.groupBy("zone").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))
    return per_zone.withColumn("causes", causes.scalar())


add(
    "src13_disruption_variants",
    _undeclared,
    """SELECT 'Z'||(event_id % 7) AS zone, COUNT(*) AS n, CAST(SUM(event_id) AS BIGINT) AS ids,
        (SELECT COUNT(*) FROM causes) AS causes FROM events WHERE event_type = 'error' GROUP BY 1""",
)
add(
    "src14_alert_arrays",
    lambda v: alert_causes(
        readers.read_json_array(v.spark, _array_files(v, v.alerts, "alerts"), f"event_id bigint, {ALERTS}"), ["event_id"]
    ),
    "SELECT trip_id, cause FROM avis",
)


def _gold(v: Views) -> DataFrame:
    path = scratch_dir(v.spark, "gold")
    writers.replace_table(v.dim_stations, path)
    return readers.read_gold(v.spark, path, ["pays", "code_uic"]).groupBy("pays", "code_uic").agg(F.count("*").alias("n"))


add("src7_gold_read", _gold, "SELECT pays, code_uic, COUNT(*) AS n FROM dim GROUP BY ALL")


def _bronze(v: Views) -> DataFrame:
    """Landed twice: the second run of a day replaces the first."""
    path = scratch_dir(v.spark, "bronze")
    rows = v.log.select(
        F.concat(F.lit("gtfs-"), F.lower("method")).alias("operateur"),
        F.col("status").cast("string").alias("category"),
        F.date_format("ts", "yyyy-MM-dd").alias("dt"),
        "api_key",
    )
    for _ in range(2):
        writers.land_partitioned(rows, path)
    landed = v.spark.read.schema(rows.schema).parquet(path)
    return landed.groupBy("operateur", "category", "dt", "api_key").agg(F.count("*").alias("n"))


add(
    "snk7_partitioned_landing",
    _bronze,
    """SELECT 'gtfs-get' AS operateur, CAST(status AS VARCHAR) AS category, strftime(ts,'%Y-%m-%d') AS dt, api_key,
        COUNT(*) AS n FROM log GROUP BY ALL""",
)


def _result_export(v: Views) -> DataFrame:
    path = scratch_dir(v.spark, "result")
    result = consolidated(v.fact_table, v.lines_table, v.fares_table)
    n = writers.export_result(result, path)
    back = v.spark.read.schema(result.schema).csv(path, header=True, escape='"')
    return back.withColumn("annoncees", F.lit(n).cast("bigint"))


add("snk4_result_export", _result_export, f"SELECT *, (SELECT COUNT(*) FROM axes) AS annoncees FROM ({CONSOLIDATED})")
