"""Station slices per country and the multi-country station dimension."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import composite_key
from ..functions.numeric import safe_double
from ..functions.text import name_search, normalize_name, not_blank
from ..operators.keyed import latest_per_key

STATION_COLUMNS = [
    "id_gare",
    "station_id",
    "nom_gare",
    "trigramme",
    "code_uic",
    "latitude",
    "longitude",
    "pays",
]


def _slice(
    df: DataFrame,
    country: str,
    station_id: Column,
    name: Column,
    lat: Column,
    lon: Column,
    short: Column | None = None,
    code: Column | None = None,
    commune: Column | None = None,
    variant: str = "local",
) -> DataFrame:
    nothing = F.lit(None).cast("string")
    return df.select(
        station_id.alias("station_id"),
        name.alias("nom_gare"),
        normalize_name(name, variant).alias("nom_gare_norm"),
        (nothing if short is None else short).alias("trigramme"),
        (station_id if code is None else code).alias("code_uic"),
        (nothing if commune is None else commune).alias("code_commune"),
        lat.alias("latitude"),
        lon.alias("longitude"),
        F.lit(country).alias("pays"),
    )


def split_position(position: Column) -> tuple[Column, Column]:
    """Latitude and longitude out of a ``"lat, lon"`` text."""
    lat, lon = (F.trim(F.split_part(position, F.lit(","), F.lit(i))) for i in (1, 2))
    return safe_double(lat), safe_double(lon)


def stations_fr(gares: DataFrame, variant: str = "local") -> DataFrame:
    lat, lon = split_position(F.col("Position géographique"))
    return _slice(
        gares,
        "FR",
        F.col("Id_Gare"),
        F.col("Nom_Gare"),
        lat,
        lon,
        short=F.col("Trigramme"),
        code=F.col("Code_UIC"),
        commune=F.col("Code commune"),
        variant=variant,
    )


def stations_ch(stops: DataFrame, variant: str = "local") -> DataFrame:
    """One station per ``didok`` code: platforms share a name and the mean position."""
    merged = (
        stops.filter(not_blank(F.col("didok")))
        .groupBy("didok")
        .agg(
            F.min("stop_name").alias("stop_name"),
            F.avg(safe_double(F.col("stop_lat"))).alias("lat"),
            F.avg(safe_double(F.col("stop_lon"))).alias("lon"),
        )
    )
    return _slice(merged, "CH", F.col("didok"), F.col("stop_name"), F.col("lat"), F.col("lon"), variant=variant)


def stations_gtfs(stops: DataFrame, country: str, variant: str = "local") -> DataFrame:
    """A timetable stop list where the stop id is the station code."""
    return _slice(
        stops.filter(F.col("stop_lat").isNotNull() & F.col("stop_lon").isNotNull()),
        country,
        F.col("stop_id"),
        F.col("stop_name"),
        safe_double(F.col("stop_lat")),
        safe_double(F.col("stop_lon")),
        variant=variant,
    )


def stations_fi(stations: DataFrame, variant: str = "local") -> DataFrame:
    """Finnish stations; the source also lists foreign border stations under colliding codes."""
    located = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    return _slice(
        stations.filter(located & (F.col("countryCode") == "FI")),
        "FI",
        F.col("stationUICCode").cast("string"),
        F.col("stationName"),
        F.col("latitude"),
        F.col("longitude"),
        short=F.col("stationShortCode"),
        variant=variant,
    )


def stations_all(slices: Iterable[DataFrame]) -> DataFrame:
    """All countries under ``id_gare``: a station id alone is not unique across countries."""
    everything = reduce(DataFrame.unionByName, slices)
    return everything.select(
        composite_key(F.col("pays"), F.col("station_id")).alias("id_gare"), *everything.columns
    )


def stations_by_name(stations: DataFrame, countries: list[str] | None = None) -> DataFrame:
    """Mean position per normalised name, over all countries unless some are chosen."""
    located = stations.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    if countries:
        located = located.filter(F.col("pays").isin(*countries))
    return (
        located.filter(F.col("nom_gare_norm").isNotNull())
        .groupBy(F.col("nom_gare_norm").alias("nom_norm"))
        .agg(F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude"))
    )


def station_lookup(stations: DataFrame) -> DataFrame:
    """Name and position per ``country:code``; of duplicates the highest station id stays."""
    usable = stations.filter(
        F.col("code_uic").isNotNull() & F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    ).select(
        composite_key(F.col("pays"), F.col("code_uic")).alias("cle"),
        "nom_gare",
        "latitude",
        "longitude",
        "station_id",
    )
    order = F.struct("station_id", "nom_gare", "latitude", "longitude")
    return latest_per_key(usable, ["cle"], order).drop("station_id")


def list_stations(
    stations: DataFrame, q: str | None = None, limit: int = 50, normalize_query: bool = False
) -> DataFrame:
    """Stations by name, optionally matching a search text; at most 500."""
    if limit > 500:
        raise ValueError("limit is at most 500")
    found = stations
    if q:
        found = found.filter(name_search(F.col("nom_gare_norm"), q, normalize_query))
    return found.select(*STATION_COLUMNS).orderBy(F.col("nom_gare").asc_nulls_last(), "id_gare").limit(limit)


def get_station(stations: DataFrame, id_gare: str) -> DataFrame:
    """The station of that id, or no row."""
    return stations.filter(F.col("id_gare") == id_gare).select(*STATION_COLUMNS)
