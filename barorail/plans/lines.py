"""Line distances and fares."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import haversine_km
from ..functions.numeric import round_to, safe_double
from ..functions.text import normalize_name
from .stations import stations_by_name

# Carriers whose fares belong to the high-speed lines.
HIGH_SPEED_CARRIERS = ("TGV INOUI", "OUIGO", "OUIGO TRAIN CLASSIQUE")


def liaisons(fact: DataFrame, stations: DataFrame, countries: list[str] | None = None) -> DataFrame:
    """Each line with both end positions and its distance, NULL where an end is unknown."""
    axes = (
        fact.filter(F.col("axe_type") == "liaison")
        .select("type_ligne", "axe_label", "gare_depart", "gare_arrivee")
        .distinct()
        .withColumns(
            {
                "_from": normalize_name(F.col("gare_depart")),
                "_to": normalize_name(F.col("gare_arrivee")),
            }
        )
    )
    points = stations_by_name(stations, countries)

    def end(key: str, side: str) -> DataFrame:
        return points.select(
            F.col("nom_norm").alias(key),
            F.col("latitude").alias(f"latitude_{side}"),
            F.col("longitude").alias(f"longitude_{side}"),
        )

    located = axes.join(end("_from", "depart"), "_from", "left").join(end("_to", "arrivee"), "_to", "left")
    return located.select(
        "type_ligne",
        "axe_label",
        "gare_depart",
        "gare_arrivee",
        "latitude_depart",
        "longitude_depart",
        "latitude_arrivee",
        "longitude_arrivee",
        haversine_km(
            F.col("latitude_depart"),
            F.col("longitude_depart"),
            F.col("latitude_arrivee"),
            F.col("longitude_arrivee"),
        ).alias("distance_km"),
    )


def carrier_line_type(carrier: Column) -> Column:
    return F.when(carrier.isin(*HIGH_SPEED_CARRIERS), F.lit("grande_vitesse")).otherwise(F.lit("intercite"))


def _fare_rows(df: DataFrame, line_type: Column, source_file: str, as_of: datetime.date) -> DataFrame:
    low, high = safe_double(F.col("Prix minimum")), safe_double(F.col("Prix maximum"))
    return df.select(
        line_type.alias("type_ligne"),
        F.col("Transporteur").alias("transporteur"),
        F.col("Gare origine").alias("gare_origine"),
        F.col("Gare destination").alias("gare_destination"),
        F.col("Classe").alias("classe"),
        F.col("Profil tarifaire").alias("profil_tarifaire"),
        low.alias("prix_minimum"),
        high.alias("prix_maximum"),
        F.lit("EUR").alias("devise"),
        F.lit(as_of).cast("date").alias("date_collecte"),
        F.lit(source_file).alias("source_file"),
        round_to((low + high) / 2, 2).alias("prix_moyen"),
    )


def fares(tgv: DataFrame, intercites: DataFrame, lines: DataFrame, as_of: datetime.date) -> DataFrame:
    """Fares with the line they belong to and their price per kilometre.

    A fare meets every line whose normalised ends and type agree, so labels that differ only in
    spelling give it several rows; a fare without a line keeps one row with NULLs.
    """
    every = _fare_rows(
        tgv, carrier_line_type(F.col("Transporteur")), "tarifs_tgv_ouigo.csv", as_of
    ).unionByName(_fare_rows(intercites, F.lit("intercite"), "tarifs_intercites.csv", as_of))
    keyed = every.withColumns(
        {
            "_from": normalize_name(F.col("gare_origine")),
            "_to": normalize_name(F.col("gare_destination")),
        }
    )
    ends = lines.select(
        "type_ligne",
        normalize_name(F.col("gare_depart")).alias("_from"),
        normalize_name(F.col("gare_arrivee")).alias("_to"),
        F.col("axe_label").alias("axe_label_regularite"),
        "distance_km",
    )
    joined = keyed.join(ends, ["type_ligne", "_from", "_to"], "left")
    per_km = F.when(
        F.col("distance_km") > 0, round_to(F.col("prix_moyen") / F.col("distance_km"), 3)
    )
    return joined.select(
        *every.columns, "axe_label_regularite", "distance_km", per_km.alias("prix_moyen_km")
    )
