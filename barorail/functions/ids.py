"""Identifiers: stops, trains, callers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Countries whose stop id ends in the station code, and those where it is the code.
SUFFIX_COUNTRIES = ("FR", "CH", "NL")
IDENTITY_COUNTRIES = ("IT", "FI", "PL", "DE", "SE")


def _match(c: Column, pattern: str) -> Column:
    """First capture group, NULL without a match."""
    found = F.regexp_extract(c, pattern, 1)
    return F.when(found != "", found)


def trailing_code(stop_id: Column) -> Column:
    """The 7 or 8 digits a stop id ends in."""
    return _match(stop_id, r"(\d{7,8})$")


def train_number(trip_id: Column) -> Column:
    return _match(trip_id, r"^OCESN(\d+)F")


def dated_trip_id(number: Column, day: Column) -> Column:
    """``number_YYYYMMDD``."""
    return F.concat(number.cast("string"), F.lit("_"), F.replace(day, F.lit("-"), F.lit("")))


def composite_key(country: Column, code: Column) -> Column:
    return F.concat(country, F.lit(":"), code)


def station_key(stop_id: Column, country: Column, swiss_code: Column) -> Column:
    """``country:code`` of a stop; ``swiss_code`` is the mapped code for Swiss ids without digits.

    Whether an identity key exists is left to the join with the stations.
    """
    code = (
        F.when(country == "CH", F.coalesce(trailing_code(stop_id), F.when(swiss_code != "", swiss_code)))
        .when(country.isin(*SUFFIX_COUNTRIES), trailing_code(stop_id))
        .when(country.isin(*IDENTITY_COUNTRIES), F.coalesce(stop_id, F.lit("")))
    )
    return composite_key(country, code)


def anonymize_ip(ip: Column) -> Column:
    """Keep half of an IPv4 and three groups of an IPv6 address; anything else is ``unknown``."""
    groups = F.split(ip, ":")
    v6 = F.concat_ws(
        ":",
        F.concat(
            F.slice(groups, 1, 3),
            F.transform(F.slice(groups, F.lit(4), F.size(groups)), lambda _: F.lit("0")),
        ),
    )
    parts = F.split(ip, r"\.")
    v4 = F.concat(F.get(parts, F.lit(0)), F.lit("."), F.get(parts, F.lit(1)), F.lit(".0.0"))
    return (
        F.when(ip.isNull(), F.lit("unknown"))
        .when(F.contains(ip, F.lit(":")), v6)
        .when(F.size(parts) == 4, v4)
        .otherwise(F.lit("unknown"))
    )


def path_template(path: Column) -> Column:
    """Replace the identifier in a request path by its placeholder."""
    return F.regexp_replace(path, r"^/stations/[^/]+$", "/stations/{id_gare}")
