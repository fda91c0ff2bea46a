"""From feed records to trip messages: one row per trip with its ordered stops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import iso_epoch, midnight_epoch, minutes_to_seconds
from ..functions.ids import dated_trip_id
from ..schemas import STOPS
from ..session import written

SEQUENCE_TZ = "Europe/Warsaw"
#: Rows of a timetable in one of its buckets.
BUCKET_ROWS = 500_000
FEWEST_BUCKETS = 8


def feed_entities(feeds: DataFrame) -> DataFrame:
    """One row per trip update of each feed, with its position in the feed.

    Columns of the feed row other than ``header`` and ``entity`` are kept; entities without a trip
    update or without stops are dropped.
    """
    kept = [c for c in feeds.columns if c not in ("header", "entity")]
    update = F.col("_e.trip_update")
    return (
        feeds.select(*kept, "header", F.posexplode("entity").alias("entity_pos", "_e"))
        .filter(F.size(F.coalesce(update["stop_time_update"], F.array())) > 0)
        .select(
            *kept,
            "entity_pos",
            F.col("header.timestamp").alias("feed_timestamp"),
            update["trip"]["trip_id"].alias("trip_id"),
            update["trip"]["route_id"].alias("route_id"),
            update["trip"]["start_date"].alias("start_date"),
            update["stop_time_update"].alias("updates"),
        )
    )


def _stop(stop_id: Column, a_time: Column, a_delay: Column, d_time: Column, d_delay: Column) -> Column:
    return F.struct(
        stop_id.alias("stop_id"),
        a_time.cast("bigint").alias("arrival_time"),
        a_delay.cast("bigint").alias("arrival_delay"),
        d_time.cast("bigint").alias("departure_time"),
        d_delay.cast("bigint").alias("departure_delay"),
    )


def published_stops(entities: DataFrame) -> DataFrame:
    """``stops`` straight from the feed."""
    stops = F.transform(
        "updates",
        lambda u: _stop(
            F.coalesce(u["stop_id"], F.lit("")),
            u["arrival"]["time"],
            u["arrival"]["delay"],
            u["departure"]["time"],
            u["departure"]["delay"],
        ),
    )
    return entities.withColumn("stops", stops).drop("updates")


def last_map_entries(stop_map: DataFrame) -> DataFrame:
    """One timetable entry per trip and stop number; of repeated ones the highest stop id stays."""
    keys = ["trip_id", "stop_sequence"]
    # An entry is its own order, so it moves once, not as value and as order.
    entry = F.max(F.struct("stop_id", "arrival_seconds", "departure_seconds")).alias("_entry")
    return stop_map.groupBy(*keys).agg(entry).select(*keys, "_entry.*")


def write_timetable(stop_map: DataFrame, table: str, path: str, buckets: int | None = None) -> DataFrame:
    """The reduced timetable as a table in buckets of trip and stop number, for joins that do not move it.

    A trip's entries lie in all buckets, however many it has. Batches of messages come to the buckets, one
    task each: without a number there is one for every ``BUCKET_ROWS`` rows of the timetable, ``FEWEST_BUCKETS``
    at least. The files lie below ``path``.
    """
    if buckets is None:
        buckets = max(FEWEST_BUCKETS, -(-stop_map.count() // BUCKET_ROWS))
    known = last_map_entries(stop_map).filter(F.col("stop_sequence").isNotNull())
    keys = ("trip_id", "stop_sequence")
    dealt = known.repartition(buckets, *keys)
    writer = dealt.write.mode("overwrite").option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    return stop_map.sparkSession.table(table)


def trip_timetables(stop_map: DataFrame) -> DataFrame:
    """One row per trip with its timetable as a map from stop number to entry: for trips of ordinary length."""
    entry = F.struct("stop_id", "arrival_seconds", "departure_seconds")
    entries = F.collect_list(F.struct(F.col("stop_sequence"), entry))
    known = last_map_entries(stop_map).filter(F.col("stop_sequence").isNotNull())
    return known.groupBy("trip_id").agg(F.map_from_entries(entries).alias("timetable"))


def resolved_stops(
    entities: DataFrame,
    stop_map: DataFrame,
    tz: str = SEQUENCE_TZ,
    map_is_reduced: bool = False,
    keep: list[str] | None = None,
) -> DataFrame:
    """``stops`` with ids and delays filled from the timetable.

    Every stop of a message meets the timetable on trip and stop number, so neither a trip nor its
    timetable is ever one row here; messages are numbered in a written table first, and get their stops
    back by that number, so they stay apart however equal they are. A stream reduces the timetable once,
    with ``write_timetable``, and says so by ``map_is_reduced``; one made by ``trip_timetables`` meets
    whole messages on the trip. All columns but ``updates`` stay, or those to ``keep``: what is not asked for
    is neither written nor moved.
    """
    if keep is not None:
        entities = entities.select(*{c: None for c in (*keep, "trip_id", "start_date", "updates")})
    # Midnight is worked out once per message, not for every time of every stop.
    dated = entities.withColumn("_midnight", midnight_epoch(F.col("start_date"), tz))
    if "timetable" in stop_map.columns:
        met = dated.join(stop_map.withColumnRenamed("timetable", "_timetable"), "trip_id", "left")

        def filled(update: Column) -> Column:
            return _filled(update, F.try_element_at("_timetable", F.coalesce(update["stop_sequence"], F.lit(0))))

        met = met.withColumn("stops", F.transform("updates", filled).cast(STOPS)).drop("updates", "_midnight", "_timetable")
        return met if keep is None else met.select(*keep, "stops")
    known = stop_map if map_is_reduced else last_map_entries(stop_map)
    entry = ["stop_id", "arrival_seconds", "departure_seconds"]
    known = known.select("trip_id", "stop_sequence", F.struct(*entry).alias("_entry"))
    kept = [c for c in (entities.columns if keep is None else keep) if c != "updates"]
    messages = written(dated.withColumn("_message", F.monotonically_increasing_id()), "entities")
    rows = messages.select(
        "_message", "trip_id", F.struct(*[c for c in kept if c != "trip_id"]).alias("_kept"), "_midnight",
        F.posexplode("updates").alias("_pos", "_update"),
    )
    rows = rows.withColumn("stop_sequence", F.coalesce(F.col("_update.stop_sequence"), F.lit(0)))
    met = rows.join(known, ["trip_id", "stop_sequence"], "left")
    stop = F.struct("_pos", _filled(F.col("_update"), F.col("_entry")).alias("s"))
    # All rows of a message carry the same trip and envelope.
    whole = met.groupBy("_message").agg(
        F.any_value("trip_id").alias("trip_id"), F.any_value("_kept").alias("_kept"), F.sort_array(F.collect_list(stop)).alias("_stops")
    )
    stops = F.transform("_stops", lambda s: s["s"]).cast(STOPS)
    return whole.select(*[F.col(c) if c == "trip_id" else F.col(f"_kept.{c}") for c in kept], stops.alias("stops"))


def _filled(update: Column, entry: Column) -> Column:
    """A stop of a message whose timetable entry is ``entry``, NULL if it has none."""

    def delay(event: str, seconds: str) -> Column:
        planned = F.col("_midnight") + entry[seconds]
        return F.coalesce(update[event]["delay"], update[event]["time"] - planned)

    published = update["stop_id"]
    return _stop(
        F.when(published != "", published).otherwise(F.coalesce(entry["stop_id"], F.lit(""))),
        update["arrival"]["time"],
        delay("arrival", "arrival_seconds"),
        update["departure"]["time"],
        delay("departure", "departure_seconds"),
    )


def as_messages(entities: DataFrame, country: str | None, captured_at: Column | None = None) -> DataFrame:
    """The message envelope; ``country`` None keeps a ``pays`` column already there."""
    pays = F.col("pays") if country is None else F.lit(country)
    captured = F.unix_timestamp(F.current_timestamp()) if captured_at is None else captured_at
    return entities.select(
        "trip_id",
        F.nullif(F.col("route_id"), F.lit("")).alias("route_id"),
        pays.alias("pays"),
        "stops",
        "feed_timestamp",
        captured.alias("captured_at"),
    )


def allow(df: DataFrame, allowlist: DataFrame | None, column: str) -> DataFrame:
    """Keep listed ids; without a list the feed is already limited to trains."""
    if allowlist is None:
        return df
    return df.join(allowlist.select(column), column, "left_semi")


def trip_messages(
    feeds: DataFrame,
    country: str | None,
    rail_routes: DataFrame | None = None,
    rail_trips: DataFrame | None = None,
    stop_map: DataFrame | None = None,
    tz: str = SEQUENCE_TZ,
    captured_at: Column | None = None,
    map_is_reduced: bool = False,
) -> DataFrame:
    """Feed snapshots to trip messages of one country."""
    entities = allow(allow(feed_entities(feeds), rail_routes, "route_id"), rail_trips, "trip_id")
    if stop_map is None:
        with_stops = published_stops(entities)
    else:
        envelope = ["trip_id", "route_id", "feed_timestamp", *(["pays"] if country is None else [])]
        with_stops = resolved_stops(entities, stop_map, tz, map_is_reduced, envelope)
    return as_messages(with_stops, country, captured_at)


def _last(rows: Column, kind: str, field: str) -> Column:
    """``field`` of the last row of that event type; the later event replaces the earlier one."""
    return F.try_element_at(F.filter(rows, lambda r: r["type"] == kind), F.lit(-1))[field]


def finnish_messages(trains: DataFrame, captured_at: Column | None = None) -> DataFrame:
    """Live trains to trip messages.

    The source has a row per arrival or departure. They become one stop per station, in order of
    first appearance, all inside the array the train came with.
    """
    events = F.transform(
        F.filter(
            F.coalesce("timeTableRows", F.array()),
            lambda r: ~F.coalesce(r["cancelled"], F.lit(False)) & r["stationUICCode"].isNotNull(),
        ),
        lambda r: F.struct(
            r["stationUICCode"].cast("string").alias("station"),
            r["type"].alias("type"),
            iso_epoch(
                F.coalesce(F.nullif(r["actualTime"], F.lit("")), r["scheduledTime"])
            ).alias("at"),
            minutes_to_seconds(r["differenceInMinutes"]).alias("delay"),
        ),
    )

    def rows_at(station: Column) -> Column:
        return F.filter("_events", lambda r: r["station"] == station)

    def stop(rows: Column) -> Column:
        return _stop(
            F.get(rows, F.lit(0))["station"],
            _last(rows, "ARRIVAL", "at"),
            _last(rows, "ARRIVAL", "delay"),
            _last(rows, "DEPARTURE", "at"),
            _last(rows, "DEPARTURE", "delay"),
        )

    stations = F.array_distinct(F.transform("_events", lambda r: r["station"]))
    clock = F.unix_timestamp(F.current_timestamp()) if captured_at is None else captured_at
    return (
        trains.withColumn("_events", events)
        .filter(F.size("_events") > 0)
        .select(
            dated_trip_id(F.col("trainNumber"), F.col("departureDate")).alias("trip_id"),
            F.lit(None).cast("string").alias("route_id"),
            F.lit("FI").alias("pays"),
            F.transform(F.transform(stations, rows_at), stop).alias("stops"),
            clock.alias("feed_timestamp"),
            clock.alias("captured_at"),
        )
    )


def with_default_country(messages: DataFrame) -> DataFrame:
    """Old messages carry no country: they are French."""
    if "pays" not in messages.columns:
        return messages.withColumn("pays", F.lit("FR"))
    return messages.withColumn("pays", F.coalesce("pays", F.lit("FR")))
