"""Distances, bearings and positions on the sphere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import round_to

EARTH_RADIUS_KM = 6371


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance, one decimal; NULL when an end has no position."""
    h = F.pow(F.sin(F.radians(lat2 - lat1) / 2), F.lit(2)) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), F.lit(2))
    # Rounding can push h a hair above 1, where asin is NaN. Not least(): it would skip a NULL.
    root = F.sqrt(F.when(h > 1, F.lit(1.0)).otherwise(h))
    return round_to(F.lit(EARTH_RADIUS_KM * 2) * F.asin(root), 1)


def bearing_deg(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Initial bearing from the first point to the second, 0 to 360 degrees."""
    dlon = F.radians(lon2 - lon1)
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    y = F.sin(dlon) * F.cos(phi2)
    x = F.cos(phi1) * F.sin(phi2) - F.sin(phi1) * F.cos(phi2) * F.cos(dlon)
    return F.pmod(F.degrees(F.atan2(y, x)) + F.lit(360.0), F.lit(360.0))


def between_points(start: Column, end: Column, fraction: Column) -> Column:
    """Linear interpolation of one coordinate."""
    return start + (end - start) * fraction


def squared_degrees(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    return F.pow(lat1 - lat2, F.lit(2)) + F.pow(lon1 - lon2, F.lit(2))


def _every_second_bit(x: Column) -> Column:
    """The lower sixteen bits of a number, each with an empty bit above it."""
    for shift in (8, 4, 2, 1):
        mask = sum(((1 << shift) - 1) << at for at in range(0, 32, 2 * shift))
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
    return x


def z_order(latitude: Column, longitude: Column) -> Column:
    """Place on a curve through all cells of a grid of 65,536 by 65,536 on which near places have near numbers."""

    def cell(degrees: Column, span: float) -> Column:
        share = F.floor((degrees + span / 2) / span * 65_536)
        return F.greatest(F.lit(0), F.least(F.lit(65_535), share)).cast("bigint")

    rows, columns = _every_second_bit(cell(latitude, 180.0)), _every_second_bit(cell(longitude, 360.0))
    return F.when(latitude.isNotNull() & longitude.isNotNull(), F.shiftleft(rows, 1).bitwiseOR(columns))
