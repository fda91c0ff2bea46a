"""Positions, routes and causes of the trains under way."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from ..functions.ids import station_key, train_number
from ..functions.labels import delay_status, whole_minutes
from ..functions.text import first_filled, preferred_translation
from ..functions.times import present
from ..operators.keyed import spread_nulls
from ..operators.polylines import nearest_points, polylines

MAX_AGE_S = 600
MAP_MARKERS = 500

# Operators known for a whole country.
COUNTRY_OPERATORS = {"IT": "Trenitalia", "SE": "Skånetrafiken"}
NO_OPERATOR = ("FI", "PL", "DE")
DEFAULT_OPERATOR = "SNCF"

ROUTE_POINTS = "trip_id string, troncon string, rang int, latitude double, longitude double"


def usable_stops(stops: Column) -> Column:
    """Stops with a time; an epoch of 0 is none."""
    return F.filter(
        stops, lambda s: present(s["arrival_time"]).isNotNull() | present(s["departure_time"]).isNotNull()
    )


def _delay(first: Column, second: Column, zero_is_value: bool) -> Column:
    return F.coalesce(first if zero_is_value else present(first), second)


def _leaving(stop: Column) -> Column:
    return F.coalesce(present(stop["departure_time"]), stop["arrival_time"])


def _reaching(stop: Column) -> Column:
    return F.coalesce(present(stop["arrival_time"]), stop["departure_time"])


def _position(
    status: str, at: Column, to: Column, progress: Column, delay: Column, index: Column
) -> Column:
    return F.struct(
        F.lit(status).alias("statut"),
        at["stop_id"].alias("stop_id_precedent"),
        to["stop_id"].alias("stop_id_suivant"),
        progress.alias("progression"),
        delay.alias("retard_s"),
        index.cast("int").alias("index_restant"),
    )


def interpolate(
    trips: DataFrame, now: Column, zero_is_value: bool = False, stops: str = "stops"
) -> DataFrame:
    """Add where each trip is at ``now``; trips that are over or lack times are dropped.

    In order of preference: standing at a stop, on the first segment that contains ``now``, or
    waiting at the first stop. Segments and waiting need two usable stops. A delay of 0 falls
    through to the other event, unless ``zero_is_value``. ``index_restant`` counts usable stops.
    Everything stays inside the stop array of the trip: no explode and no exchange.
    """
    u = F.col("_usable")

    def standing(n: Column) -> Column:
        s = n["s"]
        here = (s["arrival_time"] <= now) & (now < s["departure_time"])
        delay = _delay(s["departure_delay"], s["arrival_delay"], zero_is_value)
        return F.when(here, _position("a_quai", s, s, F.lit(0.0), delay, n["i"]))

    def moving(n: Column, m: Column) -> Column:
        here, nxt = n["s"], m["s"]
        leaves, reaches = _leaving(here), _reaching(nxt)
        share = F.when(reaches <= leaves, F.lit(0.0)).otherwise(
            F.try_divide((now - leaves).cast("double"), (reaches - leaves).cast("double"))
        )
        delay = _delay(nxt["arrival_delay"], nxt["departure_delay"], zero_is_value)
        return F.when(
            (leaves <= now) & (now <= reaches),
            _position("en_route", here, nxt, F.bround(share, 3), delay, n["i"]),
        )

    def first_of(candidates: Column) -> Column:
        return F.get(F.array_compact(candidates), F.lit(0))

    first = F.get(u, F.lit(0))["s"]
    waiting = F.when(
        now < _leaving(first),
        _position(
            "a_quai",
            first,
            first,
            F.lit(0.0),
            _delay(first["departure_delay"], first["arrival_delay"], zero_is_value),
            F.lit(0),
        ),
    )
    # Neighbours are paired by zipping, not by looking the next stop up inside a lambda: that would
    # walk the list once per stop.
    segments = F.zip_with(u, F.slice(u, F.lit(2), F.size(u)), moving)
    position = F.coalesce(
        first_of(F.transform(u, standing)),
        F.when(F.size(u) >= 2, F.coalesce(first_of(segments), waiting)),
    )
    numbered = F.transform(
        usable_stops(F.col(stops)), lambda s, i: F.struct(s.alias("s"), i.alias("i"))
    )
    # Rows without a position go by inlining an empty array. A filter would be pushed below the
    # projection and work the position out a second time.
    return trips.withColumn("_usable", numbered).select(
        *trips.columns, F.inline(F.array_compact(F.array(position)))
    )


def with_station_keys(df: DataFrame, swiss_stops: DataFrame, columns: dict[str, str], spread_by: str) -> DataFrame:
    """Resolve stop id columns to station keys; ``columns`` maps a stop column to the key's name.

    Only Swiss ids without a code in them look into ``swiss_stops``; all other rows take part in
    the join under a key that matches nothing and differs from row to row.
    """
    unique = swiss_stops.groupBy("stop_id").agg(F.max("code_uic").alias("code_uic"))
    out = df
    for stop, key in columns.items():
        mapped = unique.select(F.col("stop_id").alias("_ch_key"), F.col("code_uic").alias("_ch_code"))
        # Keys of the other countries are NULL here and so never equal a Swiss stop id.
        lookup = spread_nulls(F.when(F.col("pays") == "CH", F.col(stop)), F.col(spread_by))
        out = (
            out.withColumn("_ch_key", lookup)
            .join(mapped, "_ch_key", "left")
            .withColumn(key, station_key(F.col(stop), F.col("pays"), F.col("_ch_code")))
            .drop("_ch_key", "_ch_code")
        )
    return out


def resolve_stops(stops: DataFrame, swiss_stops: DataFrame, lookup: DataFrame) -> DataFrame:
    """Add ``cle`` to ``pays, stop_id`` rows; NULL also where an identity key is no known station."""
    keyed = with_station_keys(stops.withColumn("_id", F.col("stop_id")), swiss_stops, {"stop_id": "cle"}, "_id").drop("_id")
    known = lookup.select(F.col("cle").alias("_known"), F.lit(True).alias("_is_known"))
    digits = F.col("pays").isin("FR", "CH", "NL")
    return (
        keyed.join(known, F.col("cle") == F.col("_known"), "left")
        .withColumn("cle", F.when(digits | F.col("_is_known"), F.col("cle")))
        .drop("_known", "_is_known")
    )


def located(positions: DataFrame, swiss_stops: DataFrame, lookup: DataFrame, include_dwell: bool = False) -> DataFrame:
    """Add both stations and the interpolated position.

    Trips with an unknown station are dropped, as are those whose two stations are the same one;
    ``include_dwell`` keeps the latter.
    """
    keyed = with_station_keys(
        positions, swiss_stops, {"stop_id_precedent": "_prev", "stop_id_suivant": "_next"}, "trip_id"
    )
    if not include_dwell:
        keyed = keyed.filter(F.col("_prev") != F.col("_next"))

    def end(key: str, tag: str) -> DataFrame:
        return lookup.select(
            F.col("cle").alias(key),
            F.col("nom_gare").alias(f"gare_{tag}"),
            F.col("latitude").alias(f"_lat_{tag}"),
            F.col("longitude").alias(f"_lon_{tag}"),
        )

    met = keyed.join(end("_prev", "precedente"), "_prev").join(end("_next", "suivante"), "_next")
    share = F.col("progression")
    return met.select(
        *positions.columns,
        "gare_precedente",
        "gare_suivante",
        geo.between_points(F.col("_lat_precedente"), F.col("_lat_suivante"), share).alias("_latitude"),
        geo.between_points(F.col("_lon_precedente"), F.col("_lon_suivante"), share).alias("_longitude"),
    )


def disruption_causes(documents: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Cause and severity per train number; the last disruption naming a train wins.

    ``order`` names columns that rank the documents where there are several.
    """
    ranked = list(order or [])
    per_disruption = (
        documents.select(*ranked, F.posexplode("disruptions").alias("_d_pos", "_d"))
        .withColumn("cause", first_filled(F.transform("_d.messages", lambda m: m["text"])))
        .filter(F.col("cause").isNotNull())
    )
    per_train = (
        per_disruption.select(
            *ranked,
            "_d_pos",
            "cause",
            F.col("_d.severity.effect").alias("gravite"),
            F.posexplode("_d.impacted_objects").alias("_i_pos", "_i"),
        )
        .withColumn("numero_train", F.col("_i.pt_object.trip.name"))
        .filter(F.col("numero_train") != "")
    )
    return per_train.groupBy("numero_train").agg(
        F.max_by(F.struct("cause", "gravite"), F.struct(*ranked, "_d_pos", "_i_pos")).alias("_last")
    ).select("numero_train", "_last.cause", "_last.gravite")


def alert_causes(documents: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Alert text per trip id; the last alert naming a trip wins."""
    ranked = list(order or [])
    per_alert = (
        documents.select(*ranked, F.posexplode("entity").alias("_a_pos", "_a"))
        .withColumn("cause", preferred_translation(F.col("_a.alert.headerText.translation")))
        .filter(F.col("cause").isNotNull())
    )
    per_trip = (
        per_alert.select(*ranked, "_a_pos", "cause", F.posexplode("_a.alert.informedEntity").alias("_i_pos", "_i"))
        .withColumn("trip_id", F.col("_i.trip.tripId"))
        .filter(F.col("trip_id") != "")
    )
    return per_trip.groupBy("trip_id").agg(
        F.max_by("cause", F.struct(*ranked, "_a_pos", "_i_pos")).alias("cause")
    )


def with_causes(trains: DataFrame, disruptions: DataFrame, alerts: DataFrame) -> DataFrame:
    """Add ``cause_retard``: Swiss trains by trip, all others by the train number in the trip id.

    The two sources share one lookup, so the trains are joined once.
    """
    causes = disruptions.select(F.concat(F.lit("n:"), "numero_train").alias("_cause_key"), "cause").unionByName(
        alerts.select(F.concat(F.lit("t:"), "trip_id").alias("_cause_key"), "cause")
    )
    key = F.when(F.col("pays") == "CH", F.concat(F.lit("t:"), "trip_id")).otherwise(
        F.concat(F.lit("n:"), train_number(F.col("trip_id")))
    )
    return (
        trains.withColumn("_cause_key", spread_nulls(key, F.col("trip_id")))
        .join(causes, "_cause_key", "left")
        .withColumnRenamed("cause", "cause_retard")
        .drop("_cause_key")
    )


def line_lookup(tables: dict[str, DataFrame], value: str) -> DataFrame:
    """One ``cle, value`` lookup out of per-country tables; of duplicates the highest stays.

    The first column of each table is the id, the second its label or operator.
    """
    parts = [
        df.select(
            F.concat(F.lit(f"{country}:"), F.col(df.columns[0])).alias("cle"),
            F.col(df.columns[1]).alias(value),
        )
        for country, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts).groupBy("cle").agg(F.max(value).alias(value))


def with_lines(trains: DataFrame, labels: dict[str, DataFrame], operators: dict[str, DataFrame]) -> DataFrame:
    """Add ``ligne`` and ``operateur``.

    ``labels`` holds the label tables of CH and IT (by route) and NL (by trip), ``operators`` those
    of CH and NL (by route); the other countries have constants or nothing.
    """
    pays = F.col("pays")
    label_id = F.when(pays.isin("CH", "IT"), F.col("route_id")).when(pays == "NL", F.col("trip_id"))
    operator_id = F.when(pays.isin("CH", "NL"), F.col("route_id"))
    named = (
        trains.withColumn("_key", spread_nulls(F.concat(pays, F.lit(":"), label_id), F.col("trip_id")))
        .join(line_lookup(labels, "ligne").withColumnRenamed("cle", "_key"), "_key", "left")
        .withColumn("_key", spread_nulls(F.concat(pays, F.lit(":"), operator_id), F.col("trip_id")))
        .join(line_lookup(operators, "_operateur").withColumnRenamed("cle", "_key"), "_key", "left")
        .drop("_key")
    )
    return named.withColumn("operateur", operator_of(pays, F.col("_operateur"))).drop("_operateur")


def operator_of(pays: Column, looked_up: Column) -> Column:
    """Operator: looked up for CH and NL, constant or unknown elsewhere."""
    out = F.when(pays.isin("CH", "NL"), looked_up).when(pays.isin(*NO_OPERATOR), F.lit(None).cast("string"))
    for country, name in COUNTRY_OPERATORS.items():
        out = out.when(pays == country, F.lit(name))
    return out.otherwise(F.lit(DEFAULT_OPERATOR))


def fresh(state: DataFrame, now: Column, max_age_s: int = MAX_AGE_S) -> DataFrame:
    """Trips updated within ``max_age_s`` (30 to 3600) before ``now``, an epoch."""
    if not 30 <= max_age_s <= 3600:
        raise ValueError("max_age_s is 30 to 3600")
    return state.filter(F.col("updated_at") > F.timestamp_seconds(now - max_age_s))


def live_trains(
    state: DataFrame,
    lookup: DataFrame,
    swiss_stops: DataFrame,
    disruptions: DataFrame,
    alerts: DataFrame,
    labels: dict[str, DataFrame],
    operators: dict[str, DataFrame],
    now: Column,
    max_age_s: int = MAX_AGE_S,
    include_dwell: bool = False,
) -> DataFrame:
    """The trains under way: stations, position, delay, cause, line and operator.

    Keeps ``stops`` and ``index_restant`` so that ``itinerary`` can start from the result.
    """
    positions = interpolate(fresh(state, now, max_age_s), now)
    trains = located(positions, swiss_stops, lookup, include_dwell)
    named = with_lines(with_causes(trains, disruptions, alerts), labels, operators)
    return named.select(
        "trip_id",
        "route_id",
        "pays",
        "ligne",
        "operateur",
        "statut",
        "gare_precedente",
        "gare_suivante",
        "progression",
        F.bround("_latitude", 5).alias("latitude"),
        F.bround("_longitude", 5).alias("longitude"),
        "retard_s",
        "cause_retard",
        F.col("updated_at").alias("maj"),
        "stops",
        "index_restant",
        "_latitude",
        "_longitude",
    )


def station_route(trains: DataFrame, swiss_stops: DataFrame, lookup: DataFrame) -> DataFrame:
    """Stations of each train behind and ahead of it, one row per point.

    ``troncon`` is ``parcouru`` up to the current segment and ``restant`` from it on. Unknown stops
    and repeats of the station before are left out.
    """
    u, i = F.col("_usable"), F.col("index_restant")
    sides = F.array(
        F.struct(F.lit("parcouru").alias("troncon"), F.slice(u, F.lit(1), i + 1).alias("part")),
        F.struct(F.lit("restant").alias("troncon"), F.slice(u, i + 1, F.size(u)).alias("part")),
    )
    points = (
        trains.select("trip_id", "pays", "index_restant", usable_stops(F.col("stops")).alias("_usable"))
        .select("trip_id", "pays", F.inline(sides))
        .select("trip_id", "pays", "troncon", F.posexplode("part").alias("_pos", "_s"))
        .select("trip_id", "pays", "troncon", "_pos", F.col("_s.stop_id").alias("stop_id"))
    )
    keyed = with_station_keys(points, swiss_stops, {"stop_id": "cle"}, "trip_id")
    met = keyed.join(lookup.select("cle", "latitude", "longitude"), "cle")
    # A window over one side of one trip: never more rows than the trip has stops.
    along = Window.partitionBy("trip_id", "troncon").orderBy("_pos")
    kept = met.withColumn("_before", F.lag("cle").over(along)).filter(~F.col("cle").eqNullSafe(F.col("_before")))
    return kept.select(
        "trip_id",
        "troncon",
        F.row_number().over(along).alias("rang"),
        "latitude",
        "longitude",
    )


def trip_shape(trip_ids: DataFrame, shapes_of_trips: DataFrame, points: DataFrame) -> DataFrame:
    """Track points of the chosen trips."""
    return (
        trip_ids.select("trip_id")
        .join(shapes_of_trips, "trip_id")
        .join(points, "shape_id")
        .select("trip_id", "shape_pt_sequence", "latitude", "longitude")
    )


def split_shape(shape: DataFrame, positions: DataFrame) -> DataFrame:
    """Split each track at the point nearest to the train; both halves keep that point.

    ``positions`` holds ``trip_id, _latitude, _longitude``, and is read several times. The nearest point
    (the first of equally near ones) is looked for among those around the train (``nearest_points``).
    """
    found = nearest_points(shape, positions, "trip_id", "shape_pt_sequence")
    nearest = found.select("trip_id", F.col("cut").alias("_cut"))
    sides = F.array_compact(
        F.array(
            F.when(F.col("shape_pt_sequence") <= F.col("_cut"), F.lit("parcouru")),
            F.when(F.col("shape_pt_sequence") >= F.col("_cut"), F.lit("restant")),
        )
    )
    return shape.join(nearest, "trip_id").select(
        "trip_id",
        F.explode(sides).alias("troncon"),
        F.col("shape_pt_sequence").alias("rang"),
        "latitude",
        "longitude",
    )


def itinerary(
    trains: DataFrame,
    swiss_stops: DataFrame,
    lookup: DataFrame,
    shapes_of_trips: DataFrame,
    points: DataFrame,
    trip_id: str | None = None,
) -> DataFrame:
    """Way behind and ahead of the live trains, or of the one chosen train, one row per point.

    Dutch trains with a known track follow it; all others go from station to station. ``trains`` is
    read several times: for more than one train, write the live view first.
    """
    chosen = trains if trip_id is None else trains.filter(F.col("trip_id") == trip_id)
    # A shape counts once here, not with every point: Spark may take the ids for small and broadcast them.
    known = shapes_of_trips.join(points.select("shape_id").distinct(), "shape_id", "left_semi")
    tracked = chosen.filter(F.col("pays") == "NL").join(known, "trip_id", "left_semi")
    by_track = split_shape(trip_shape(tracked, shapes_of_trips, points), tracked)
    by_station = station_route(
        chosen.join(tracked.select("trip_id"), "trip_id", "left_anti"), swiss_stops, lookup
    )
    return by_station.unionByName(by_track)


def itinerary_lists(route: DataFrame) -> DataFrame:
    """The itinerary as point lists, one row per train and side."""
    return polylines(route, ["trip_id", "troncon"], "rang")


def in_view(trains: DataFrame, south: float, west: float, north: float, east: float) -> DataFrame:
    return trains.filter(F.col("latitude").between(south, north) & F.col("longitude").between(west, east))


def map_markers(
    trains: DataFrame, south: float, west: float, north: float, east: float, limit: int = MAP_MARKERS
) -> DataFrame:
    """The trains drawn on the map: those in view, in id order, up to the marker limit."""
    return in_view(trains, south, west, north, east).orderBy("trip_id").limit(limit)


def live_summary(trains: DataFrame) -> DataFrame:
    """One row: trains per delay status and the mean known delay in minutes."""
    status = delay_status(F.col("retard_s"))
    return trains.agg(
        F.count("*").alias("trains"),
        *[F.count_if(status == s).alias(s) for s in ("ok", "warn", "crit", "idle")],
        whole_minutes(F.avg("retard_s")).alias("retard_moyen_min"),
    )
