"""Tracks: numbered points, lists of them for export, and the point nearest to a position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from .ordered import numbered_within

#: Most points in a row of ``polyline_parts``.
PART = 10_000
#: Side of a cell of the grid of ``nearest_points``, in degrees.
CELL = 0.02
#: How many cells around a position are searched, one ring after the other; then the whole track.
RINGS = (1, 4, 16)


def _point(p: Column) -> Column:
    return F.struct(p["latitude"].alias("lat"), p["longitude"].alias("lon"))


def polylines(points: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """Points in sequence order as ``points`` arrays, one row per key: for lines that are drawn at once.

    Tracks of any length go through ``polyline_parts``; whoever needs no list works on the points themselves.
    """
    rows = points.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(seq, "latitude", "longitude"))).alias("_points")
    )
    return rows.select(*keys, F.transform("_points", _point).alias("points"))


def numbered_points(points: DataFrame, keys: list[str], seq: str, name: str = "rang") -> DataFrame:
    """Points with 0, 1, 2, ... along each track; equal sequence numbers follow by latitude and longitude."""
    return numbered_within(points, keys, [seq, "latitude", "longitude"], name)


def polyline_parts(points: DataFrame, keys: list[str], seq: str, part: int = PART) -> DataFrame:
    """Tracks as lists of at most ``part`` points: ``keys``, ``part`` (0, 1, 2, ... along the track), ``points``."""
    placed = numbered_points(points, keys, seq, "_place")
    rows = placed.withColumn("part", F.floor(F.col("_place") / F.lit(part)).cast("int")).groupBy(*keys, "part")
    listed = rows.agg(F.sort_array(F.collect_list(F.struct("_place", "latitude", "longitude"))).alias("_points"))
    return listed.select(*keys, "part", F.transform("_points", _point).alias("points"))


def _cell(degrees: Column, cell: float) -> Column:
    return F.floor(degrees / F.lit(cell)).cast("int")


def nearest_points(
    track: DataFrame, positions: DataFrame, key: str, seq: str, cell: float = CELL, rings: tuple[int, ...] = RINGS
) -> DataFrame:
    """``key, d2, cut, compared``: for each position the sequence number of its track's nearest point.

    ``track`` holds ``key, seq, latitude, longitude``, ``positions`` one row per ``key`` with ``_latitude`` and
    ``_longitude``. Points lie in the cells of a grid, and count in growing squares around a position: one found
    nearer than the square reaches is the nearest of the whole track. ``compared`` counts the points looked at
    in the last square. A position without coordinates, or farther than the last square from its track, is
    compared with all of it. Of equally near points the first counts; points without coordinates do not.

    A point meets the position of its track once and tells by the two cells which squares hold it, so positions
    are never multiplied by the cells around them, and a long track shrinks to a row per task before it moves.
    """
    points = track.where("latitude IS NOT NULL AND longitude IS NOT NULL").select(
        key, F.col(seq).alias("cut"), "latitude", "longitude"
    )

    def steps(point: str, position: str) -> Column:
        return F.abs(_cell(F.col(point), cell).cast("bigint") - _cell(F.col(position), cell))

    away = F.when(
        F.col("_latitude").isNotNull() & F.col("_longitude").isNotNull(),
        F.greatest(steps("latitude", "_latitude"), steps("longitude", "_longitude")),
    )
    d2 = geo.squared_degrees(F.col("latitude"), F.col("longitude"), F.col("_latitude"), F.col("_longitude"))
    met = positions.select(key, "_latitude", "_longitude").join(points, key)
    met = met.select(key, F.struct(d2.alias("d2"), "cut").alias("_n"), away.alias("_away"))
    squares = {f"_in{ring}": F.col("_away") <= ring for ring in rings} | {"_in": F.lit(True)}
    best = met.groupBy(key).agg(
        *[
            F.struct(F.min(F.when(inside, F.col("_n"))).alias("n"), F.count_if(inside).alias("compared")).alias(name)
            for name, inside in squares.items()
        ]
    )
    sure = [F.when(F.col(f"_in{ring}.n.d2") < F.lit((ring * cell) ** 2), F.col(f"_in{ring}")) for ring in rings]
    last = F.coalesce(*sure, F.col("_in")).alias("_last")
    return best.select(key, last).select(key, "_last.n.d2", "_last.n.cut", "_last.compared")
