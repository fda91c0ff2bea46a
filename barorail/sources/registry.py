"""The source files: where they come from, how they are written and what they hold."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from .. import schemas as S


@dataclass(frozen=True)
class SourceSpec:
    filename: str
    operator: str
    category: str
    schema: T.StructType
    outlier_column: str | None = None

    @property
    def table(self) -> str:
        """Staging table name: the file stem in capitals."""
        return self.filename.rsplit(".", 1)[0].upper()

    @property
    def semicolon(self) -> bool:
        """National open-data exports use semicolons and quoted line breaks, timetables commas."""
        return self.operator == "sncf"


# File, operator, category, schema and the column checked for outliers.
_SPECS = (
    ("regularite_tgv.csv", "sncf", "regularite", S.TGV_MONTHLY, None),
    ("regularite_ter.csv", "sncf", "regularite", S.TER_MONTHLY, None),
    ("regularite_intercites.csv", "sncf", "regularite", S.INTERCITES_MONTHLY, None),
    ("gares.csv", "sncf", "referentiel", S.GARES, None),
    ("tarifs_tgv_ouigo.csv", "sncf", "tarifs", S.TARIFS, "Prix maximum"),
    ("tarifs_intercites.csv", "sncf", "tarifs", S.TARIFS, "Prix maximum"),
    ("ch_stops.csv", "gtfs-ch", "referentiel", S.GTFS_STOPS_CH, None),
    ("ch_routes.csv", "gtfs-ch", "referentiel", S.GTFS_ROUTES, None),
    ("ch_agency.csv", "gtfs-ch", "referentiel", S.GTFS_AGENCY, None),
    ("nl_stops.csv", "gtfs-nl", "referentiel", S.GTFS_STOPS, None),
    ("nl_routes.csv", "gtfs-nl", "referentiel", S.GTFS_ROUTES, None),
    ("nl_trips.csv", "gtfs-nl", "referentiel", S.GTFS_TRIPS, None),
    ("nl_shapes.csv", "gtfs-nl", "referentiel", S.GTFS_SHAPES, None),
    ("nl_agency.csv", "gtfs-nl", "referentiel", S.GTFS_AGENCY, None),
    ("it_stops.csv", "gtfs-it", "referentiel", S.GTFS_STOPS, None),
    ("it_routes.csv", "gtfs-it", "referentiel", S.GTFS_ROUTES, None),
    ("pl_stops.csv", "gtfs-pl", "referentiel", S.GTFS_STOPS, None),
    ("pl_stop_times.csv", "gtfs-pl", "referentiel", S.GTFS_STOP_TIMES, None),
    ("de_stops.csv", "gtfs-de", "referentiel", S.GTFS_STOPS, None),
    ("de_routes.csv", "gtfs-de", "referentiel", S.GTFS_ROUTES, None),
    ("de_trips.csv", "gtfs-de", "referentiel", S.GTFS_TRIPS, None),
    ("se_stops.csv", "gtfs-se", "referentiel", S.GTFS_STOPS, None),
    ("se_routes.csv", "gtfs-se", "referentiel", S.GTFS_ROUTES, None),
    ("se_trips.csv", "gtfs-se", "referentiel", S.GTFS_TRIPS, None),
    ("fi_stations.json", "gtfs-fi", "referentiel", S.FI_STATIONS, None),
)

SOURCES = {spec[0].rsplit(".", 1)[0]: SourceSpec(*spec) for spec in _SPECS}
