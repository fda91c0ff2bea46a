"""Display texts of live trains."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .ids import _match
from .text import not_blank

# Product code inside a trip id and its display name.
PRODUCTS = {"OUI": "TGV INOUI", "OGO": "OUIGO", "TER": "TER", "IC": "Intercités", "CTE": "Intercités"}

# Delay bounds in seconds.
ON_TIME_BELOW_S = 120
MODERATE_UP_TO_S = 600


def delay_status(delay_s: Column) -> Column:
    return (
        F.when(delay_s.isNull(), F.lit("idle"))
        .when(delay_s < ON_TIME_BELOW_S, F.lit("ok"))
        .when(delay_s <= MODERATE_UP_TO_S, F.lit("warn"))
        .otherwise(F.lit("crit"))
    )


def whole_minutes(seconds: Column) -> Column:
    """Nearest minute, halves upwards."""
    return F.floor(seconds / F.lit(60.0) + F.lit(0.5)).cast("long")


def delay_text(delay_s: Column) -> Column:
    minutes = whole_minutes(delay_s)
    return (
        F.when(delay_s.isNull(), F.lit("inconnu"))
        .when(minutes == 0, F.lit("à l'heure"))
        .otherwise(F.concat(F.lit("+"), minutes.cast("string"), F.lit(" min")))
    )


def route_label(label: Column, route_id: Column, trip_id: Column) -> Column:
    """Line label, else the route id, else the product named in the trip id, else ``Train``."""
    code = _match(trip_id, ":(" + "|".join(PRODUCTS) + "):")
    product = F.lit("Train")
    for key, name in PRODUCTS.items():
        product = F.when(code == key, F.lit(name)).otherwise(product)
    return F.coalesce(F.when(not_blank(label), label), F.when(not_blank(route_id), route_id), product)
