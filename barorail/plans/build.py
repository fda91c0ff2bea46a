"""The whole batch build: raw files to gold tables."""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import COUNTRIES
from ..sinks.writers import replace_table
from ..sources.readers import read_source
from . import gtfs, harmonize, lines, stations


@dataclass(frozen=True)
class Environment:
    """Where tables go and whether a small sample is built instead of everything."""

    name: str
    gold_dir: str
    sample_axes: int | None = None
    sample_months: int = 3
    # Off, national exports without quoted line breaks are read in splits.
    multiline: bool = True


# Environment names and their table folders.
ENVIRONMENTS = {
    "dev": Environment("dev", "environments/dev", sample_axes=1, sample_months=3),
    "preprod": Environment("preprod", "environments/preprod"),
    "prod": Environment("prod", "environments/prod"),
}


def station_slices(
    spark: SparkSession, raw_dir: str, variant: str = "local", multiline: bool = True
) -> list[DataFrame]:
    def source(name: str) -> DataFrame:
        return read_source(spark, raw_dir, name, multiline)

    return [
        stations.stations_fr(source("gares"), variant),
        stations.stations_ch(source("ch_stops"), variant),
        *[stations.stations_gtfs(source(f"{c.lower()}_stops"), c, variant) for c in ("NL", "IT", "PL", "DE", "SE")],
        stations.stations_fi(source("fi_stations"), variant),
    ]


def build(
    spark: SparkSession, raw_dir: str, env: Environment, as_of: datetime.date
) -> dict[str, DataFrame]:
    """Write all gold tables and return them, read back.

    Facts and stations feed several tables, so each is written once and read from there.
    """
    out = env.gold_dir.rstrip("/")
    tables: dict[str, DataFrame] = {}

    def source(name: str) -> DataFrame:
        return read_source(spark, raw_dir, name, env.multiline)

    def store(name: str, df: DataFrame, *cluster_by: str) -> DataFrame:
        replace_table(df, f"{out}/{name}", cluster_by)
        tables[name] = spark.read.parquet(f"{out}/{name}")
        return tables[name]

    fact = harmonize.harmonize(
        source("regularite_tgv"), source("regularite_ter"), source("regularite_intercites")
    )
    if env.sample_axes is not None:
        fact = harmonize.dev_sample(fact, env.sample_axes, env.sample_months)
    fact = store("fact_regularite", fact, "type_ligne", "axe_label", "mois")
    dim = store("dim_stations_multipays", stations.stations_all(station_slices(spark, raw_dir, multiline=env.multiline)), "id_gare")

    store("dim_stop_uic_ch", gtfs.stop_uic(source("ch_stops")))
    store("dim_rail_routes_ch", gtfs.rail_routes(source("ch_routes")))
    store("dim_route_label_ch", gtfs.route_labels(source("ch_routes")))
    store("dim_route_operator_ch", gtfs.route_operators(source("ch_routes"), source("ch_agency")))
    store("dim_route_label_it", gtfs.route_labels(source("it_routes")))
    trips, routes = source("nl_trips"), source("nl_routes")
    shapes_of_trips = store("dim_trip_shape_nl", gtfs.trip_shapes(trips, routes), "trip_id", "shape_id")
    store("dim_trip_label_nl", gtfs.trip_labels(trips, routes), "trip_id", "label")
    store("dim_route_operator_nl", gtfs.route_operators(routes, source("nl_agency"), rail_only=True))
    store("dim_shapes_nl", gtfs.shape_points(source("nl_shapes")), "shape_id", "shape_pt_sequence")
    store("dim_shape_lists_nl", gtfs.shape_polylines(source("nl_shapes"), shapes_of_trips))
    store("dim_rail_trips_de", gtfs.rail_trips(source("de_trips"), source("de_routes"), extended=False))
    store("dim_rail_trips_se", gtfs.rail_trips(source("se_trips"), source("se_routes"), extended=True))
    store(
        "dim_stop_sequence_pl", gtfs.stop_sequence_map(source("pl_stop_times")), "trip_id", "stop_sequence"
    )

    dim_lines = store("dim_liaisons", lines.liaisons(fact, dim))
    store(
        "fact_fares",
        lines.fares(source("tarifs_tgv_ouigo"), source("tarifs_intercites"), dim_lines, as_of),
    )
    return tables


def station_counts(dim: DataFrame) -> DataFrame:
    """Stations in all and per country, one row."""
    return dim.agg(
        F.count("*").alias("gares"),
        *[F.count_if(F.col("pays") == c).alias(c.lower()) for c in COUNTRIES],
    )


def coverage(df: DataFrame, column: str) -> DataFrame:
    """Rows in all and rows where ``column`` is known."""
    return df.agg(F.count("*").alias("total"), F.count(column).alias("renseignes"))


def build_summary(fact: DataFrame, dim: DataFrame, dim_lines: DataFrame, fares: DataFrame) -> DataFrame:
    """Size and coverage of each table: ``table_name, total, renseignes``."""
    parts = [
        ("fact_regularite", coverage(fact, "taux_ponctualite")),
        ("dim_stations_multipays", coverage(dim, "latitude")),
        ("dim_liaisons", coverage(dim_lines, "distance_km")),
        ("fact_fares", coverage(fares, "prix_moyen_km")),
    ]
    frames = [df.select(F.lit(name).alias("table_name"), "total", "renseignes") for name, df in parts]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out
