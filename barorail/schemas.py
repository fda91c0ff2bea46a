"""Declared schemas: nothing is sniffed, so a type never depends on the data."""

from __future__ import annotations

from pyspark.sql import types as T


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Column names of the published sources.
TGV_MONTHLY = strings(
    "Date",
    "Gare de départ",
    "Gare d'arrivée",
    "Nombre de circulations prévues",
    "Nombre de trains annulés",
    "Nombre de trains en retard à l'arrivée",
    "Retard moyen de tous les trains à l'arrivée",
)
TER_MONTHLY = strings(
    "Date",
    "Région",
    "Nombre de trains programmés",
    "Nombre de trains ayant circulé",
    "Nombre de trains annulés",
    "Nombre de trains en retard à l'arrivée",
)
INTERCITES_MONTHLY = strings(
    "Date",
    "Départ",
    "Arrivée",
    "Nombre de trains programmés",
    "Nombre de trains ayant circulé",
    "Nombre de trains annulés",
    "Nombre de trains en retard à l'arrivée",
)
GARES = strings(
    "Nom_Gare",
    "Trigramme",
    "Segment(s) DRG",
    "Position géographique",
    "Code commune",
    "Code_UIC",
    "Id_Gare",
)
TARIFS = strings(
    "Transporteur",
    "Gare origine",
    "Gare origine - code UIC",
    "Gare destination",
    "Gare destination - code UIC",
    "Classe",
    "Profil tarifaire",
    "Prix minimum",
    "Prix maximum",
)
GTFS_STOPS = strings("stop_id", "stop_name", "stop_lat", "stop_lon")
GTFS_STOPS_CH = strings("stop_id", "stop_name", "stop_lat", "stop_lon", "didok")
GTFS_ROUTES = strings("route_id", "agency_id", "route_short_name", "route_type")
GTFS_AGENCY = strings("agency_id", "agency_name")
GTFS_TRIPS = strings("route_id", "trip_id", "trip_long_name", "shape_id")
GTFS_SHAPES = strings("shape_id", "shape_pt_sequence", "shape_pt_lat", "shape_pt_lon")
GTFS_STOP_TIMES = strings("trip_id", "stop_sequence", "stop_id", "arrival_time", "departure_time")

FI_STATIONS = T.StructType(
    [
        T.StructField("stationName", T.StringType()),
        T.StructField("stationShortCode", T.StringType()),
        T.StructField("stationUICCode", T.LongType()),
        T.StructField("countryCode", T.StringType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("latitude", T.DoubleType()),
    ]
)

STOP_SEQUENCE_MAP = (
    "trip_id string, stop_sequence int, stop_id string, arrival_seconds int, departure_seconds int"
)

STOPS = "array<struct<stop_id:string,arrival_time:bigint,arrival_delay:bigint,departure_time:bigint,departure_delay:bigint>>"
TRIP_MESSAGE = (
    f"trip_id string, route_id string, pays string, stops {STOPS}, feed_timestamp bigint, captured_at bigint"
)

TRIP_STATE = (
    f"trip_id string, route_id string, pays string, stops {STOPS}, feed_timestamp bigint, "
    "captured_at timestamp, updated_at timestamp, batch_id bigint"
)

_EVENT = "struct<time:bigint,delay:bigint>"
FEED = (
    "header struct<timestamp:bigint>, entity array<struct<id:string,trip_update:struct<"
    "trip:struct<trip_id:string,route_id:string,start_date:string>,"
    "stop_time_update:array<struct<stop_id:string,stop_sequence:int,"
    f"arrival:{_EVENT},departure:{_EVENT}>>>>>"
)
LIVE_TRAINS_FI = (
    "trainNumber bigint, departureDate string, timeTableRows array<struct<stationUICCode:bigint,"
    "type:string,scheduledTime:string,actualTime:string,differenceInMinutes:double,cancelled:boolean>>"
)
DISRUPTIONS = (
    "disruptions array<struct<messages:array<struct<text:string>>,severity:struct<effect:string>,"
    "impacted_objects:array<struct<pt_object:struct<trip:struct<name:string>>>>>>"
)
ALERTS = (
    "entity array<struct<alert:struct<headerText:struct<translation:array<struct<language:string,text:string>>>,"
    "informedEntity:array<struct<trip:struct<tripId:string>>>>>>"
)

# The countries covered and the line types.
COUNTRIES = ("FR", "CH", "NL", "IT", "FI", "PL", "DE", "SE")
LINE_TYPES = ("grande_vitesse", "regional", "intercite")
