"""Lookups out of static timetable files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import safe_double, safe_int
from ..functions.text import not_blank
from ..functions.times import clock_seconds
from ..operators.polylines import numbered_points, polyline_parts

# The rail family of the extended route types, and rail among the basic ones.
EXTENDED_RAIL = (100, 117)
BASIC_RAIL = 2


def is_rail(route_type: Column, extended: bool) -> Column:
    code = safe_int(route_type)
    return code.between(*EXTENDED_RAIL) if extended else code == BASIC_RAIL


def stop_uic(stops: DataFrame) -> DataFrame:
    """Stop id to station code, for stop ids that do not contain it."""
    return stops.filter(not_blank(F.col("didok"))).select("stop_id", F.col("didok").alias("code_uic"))


def rail_routes(routes: DataFrame) -> DataFrame:
    """Route ids of the rail family."""
    return routes.filter(is_rail(F.col("route_type"), extended=True)).select("route_id")


def rail_trips(trips: DataFrame, routes: DataFrame, extended: bool) -> DataFrame:
    """Trip ids that run on a rail route."""
    rail = routes.filter(is_rail(F.col("route_type"), extended)).select("route_id")
    return trips.select("trip_id", "route_id").join(rail, "route_id").select("trip_id")


def route_labels(routes: DataFrame) -> DataFrame:
    return routes.filter(not_blank(F.col("route_short_name"))).select(
        "route_id", F.col("route_short_name").alias("label")
    )


def route_operators(routes: DataFrame, agency: DataFrame, rail_only: bool = False) -> DataFrame:
    """Operator per route; the rail-only form is also free of duplicates."""
    if rail_only:
        routes = routes.filter(is_rail(F.col("route_type"), extended=False))
    named = (
        routes.select("route_id", "agency_id")
        .join(agency.select("agency_id", F.col("agency_name").alias("operateur")), "agency_id")
        .select("route_id", "operateur")
    )
    return named.distinct() if rail_only else named


def _rail_trip_attribute(trips: DataFrame, routes: DataFrame, attribute: str) -> DataFrame:
    rail = routes.filter(is_rail(F.col("route_type"), extended=False)).select("route_id")
    return (
        trips.filter(not_blank(F.col(attribute)))
        .select("trip_id", "route_id", attribute)
        .join(rail, "route_id")
        .select("trip_id", attribute)
    )


def trip_labels(trips: DataFrame, routes: DataFrame) -> DataFrame:
    return _rail_trip_attribute(trips, routes, "trip_long_name").withColumnRenamed("trip_long_name", "label")


def trip_shapes(trips: DataFrame, routes: DataFrame) -> DataFrame:
    return _rail_trip_attribute(trips, routes, "shape_id")


def shape_points(points: DataFrame) -> DataFrame:
    """Track points of every shape, one row each."""
    return points.select(
        "shape_id",
        safe_int(F.col("shape_pt_sequence")).alias("shape_pt_sequence"),
        safe_double(F.col("shape_pt_lat")).alias("latitude"),
        safe_double(F.col("shape_pt_lon")).alias("longitude"),
    )


def shape_polylines(points: DataFrame, shapes_of_trips: DataFrame) -> DataFrame:
    """Ordered point lists of the shapes that rail trips use: ``shape_id, part, points``, long ones in parts."""
    return polyline_parts(used_shape_points(points, shapes_of_trips), ["shape_id"], "shape_pt_sequence")


def numbered_shape_points(points: DataFrame, shapes_of_trips: DataFrame) -> DataFrame:
    """The same points one row each, with their place ``rang`` along the shape."""
    return numbered_points(used_shape_points(points, shapes_of_trips), ["shape_id"], "shape_pt_sequence")


def used_shape_points(points: DataFrame, shapes_of_trips: DataFrame) -> DataFrame:
    return shape_points(points).join(shapes_of_trips, "shape_id", "left_semi")


def stop_sequence_map(stop_times: DataFrame) -> DataFrame:
    """Timetable entry per trip and stop number, times as seconds after midnight."""
    return stop_times.select(
        "trip_id",
        safe_int(F.col("stop_sequence")).alias("stop_sequence"),
        "stop_id",
        clock_seconds(F.col("arrival_time")).alias("arrival_seconds"),
        clock_seconds(F.col("departure_time")).alias("departure_seconds"),
    )
