import datetime
import math
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from barorail.functions import geo, ids, labels, numeric, text, times


@pytest.mark.parametrize(
    "name, key",
    [
        ("  Orléans ", "ORLEANS"),
        ("St-Étienne", "SAINT ETIENNE"),
        ("Brest", "BREST"),
        ("Le Mans ST", "LE MANS SAINT"),
        ("Ça-va", "ÇA VA"),
        ("Straße", "STRAẞE"),
        (None, None),
    ],
)
def test_normalize_name(value, name, key):
    assert value(text.normalize_name(F.lit(name).cast("string"))) == key


def test_warehouse_variant_keeps_small_accents(value):
    assert value(text.normalize_name(F.lit("Orléans"), "warehouse")) == "ORLÉANS"
    assert value(text.normalize_name(F.lit("ORLÉANS"), "warehouse")) == "ORLEANS"


@pytest.mark.parametrize(
    "raw, number", [("12", 12), ("12.7", 13), ("2.5", 2), ("3.5", 4), ("x", None), (None, None), ("9999999999", None)]
)
def test_safe_int(value, raw, number):
    assert value(numeric.safe_int(F.lit(raw).cast("string"))) == number


def test_percent_is_null_without_a_base(value):
    assert value(numeric.percent(F.lit(175), F.lit(195))) == 89.74
    assert value(numeric.percent(F.lit(0), F.lit(0))) is None
    assert value(numeric.percent(F.lit(1), F.lit(None).cast("int"))) is None


def test_round_to_follows_the_scaled_double(value):
    assert value(numeric.round_to(F.lit(1.005), 2)) == 1.0
    assert value(numeric.round_to(F.lit(-2.5), 0)) == -3.0


@pytest.mark.parametrize(
    "hms, seconds", [("08:05:09", 29109), ("25:10:00", 90600), ("8:5", None), ("", None), ("a:b:c", None), (None, None)]
)
def test_clock_seconds(value, hms, seconds):
    assert value(times.clock_seconds(F.lit(hms).cast("string"))) == seconds


@pytest.mark.parametrize("day", ["20240110", "20240331", "20241027", "20240701"])
@pytest.mark.parametrize("seconds", [0, 9000, 90_000])
def test_scheduled_epoch_counts_elapsed_seconds(value, day, seconds):
    midnight = datetime.datetime.strptime(day, "%Y%m%d").replace(tzinfo=ZoneInfo("Europe/Warsaw"))
    got = value(times.scheduled_epoch(F.lit(day), F.lit(seconds), "Europe/Warsaw"))
    assert got == int(midnight.timestamp()) + seconds


def test_scheduled_epoch_without_a_day(value):
    assert value(times.scheduled_epoch(F.lit(""), F.lit(5), "Europe/Warsaw")) is None
    assert value(times.scheduled_epoch(F.lit("20240110"), F.lit(None).cast("int"), "UTC")) is None


def test_iso_epoch_and_minutes(value):
    assert value(times.iso_epoch(F.lit("2024-01-01T00:00:10.000Z"))) == 1704067210
    assert value(times.iso_epoch(F.lit("2024-01-01T02:00:10+02:00"))) == 1704067210
    assert value(times.iso_epoch(F.lit(""))) is None
    assert value(times.minutes_to_seconds(F.lit(2.5))) == 150
    assert value(times.minutes_to_seconds(F.lit(None).cast("double"))) == 0


@pytest.mark.parametrize(
    "stop, code",
    [
        ("StopPoint:OCETGV INOUI-87688887", "87688887"),
        ("StopArea:OCE8304501", "8304501"),
        ("x1234567890", "34567890"),
        ("123456", None),
        ("87688887x", None),
        ("", None),
        (None, None),
    ],
)
def test_trailing_code(value, stop, code):
    assert value(ids.trailing_code(F.lit(stop).cast("string"))) == code


def test_train_number_and_dated_id(value):
    assert value(ids.train_number(F.lit("OCESN9852F1234"))) == "9852"
    assert value(ids.train_number(F.lit("XOCESN9852F"))) is None
    assert value(ids.dated_trip_id(F.lit(27), F.lit("2024-05-06"))) == "27_20240506"


@pytest.mark.parametrize(
    "ip, masked",
    [
        ("91.12.4.200", "91.12.0.0"),
        ("2a01:cb00:12:9:8:7:6:5", "2a01:cb00:12:0:0:0:0:0"),
        ("::1", "::1"),
        ("fe80::1", "fe80::1"),
        ("1.2.3", "unknown"),
        ("host", "unknown"),
        (None, "unknown"),
    ],
)
def test_anonymize_ip(value, ip, masked):
    assert value(ids.anonymize_ip(F.lit(ip).cast("string"))) == masked


@pytest.mark.parametrize(
    "stop, country, mapped, key",
    [
        ("a-87688887", "FR", None, "FR:87688887"),
        ("ch:1:sloid:7", "CH", "8500007", "CH:8500007"),
        ("ch:1:sloid:7", "CH", None, None),
        ("ch:1:sloid:7", "CH", "", None),
        ("123456", "NL", "9", None),
        ("1", "FI", None, "FI:1"),
        (None, "DE", None, "DE:"),
        ("1", "XX", None, None),
        ("1", None, None, None),
    ],
)
def test_station_key(value, stop, country, mapped, key):
    columns = [F.lit(x).cast("string") for x in (stop, country, mapped)]
    assert value(ids.station_key(*columns)) == key


@pytest.mark.parametrize(
    "delay, status, shown",
    [
        (None, "idle", "inconnu"),
        (0, "ok", "à l'heure"),
        (29, "ok", "à l'heure"),
        (30, "ok", "+1 min"),
        (119, "ok", "+2 min"),
        (120, "warn", "+2 min"),
        (600, "warn", "+10 min"),
        (601, "crit", "+10 min"),
        (-300, "ok", "+-5 min"),
    ],
)
def test_delay_labels(value, delay, status, shown):
    c = F.lit(delay).cast("bigint")
    assert value(labels.delay_status(c)) == status
    assert value(labels.delay_text(c)) == shown


@pytest.mark.parametrize(
    "label, route, trip, shown",
    [
        ("S10", "r", "t", "S10"),
        ("", "r", "t", "r"),
        (None, None, "a:OUI:b", "TGV INOUI"),
        (None, "", "a:CTE:b", "Intercités"),
        (None, None, "a:ZZZ:b", "Train"),
        (None, None, None, "Train"),
    ],
)
def test_route_label(value, label, route, trip, shown):
    assert value(labels.route_label(*[F.lit(x).cast("string") for x in (label, route, trip)])) == shown


def test_haversine_and_bearing(value):
    paris, lyon = (48.8566, 2.3522), (45.7640, 4.8357)
    points = [F.lit(x) for x in (*paris, *lyon)]
    assert 390 < value(geo.haversine_km(*points)) < 394
    assert value(geo.haversine_km(F.lit(None).cast("double"), *points[1:])) is None
    assert value(geo.haversine_km(F.lit(90.0), F.lit(0.0), F.lit(-90.0), F.lit(0.0))) == round(6371 * math.pi, 1)
    assert value(geo.bearing_deg(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))) == pytest.approx(90.0)
    assert value(geo.bearing_deg(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(-1.0))) == pytest.approx(270.0)


def _translations(*pairs):
    return F.array(*[F.struct(F.lit(a).alias("language"), F.lit(b).alias("text")) for a, b in pairs])


def test_preferred_translation(value):
    assert value(text.preferred_translation(_translations(("de", "Bau"), ("fr", "Travaux")))) == "Travaux"
    assert value(text.preferred_translation(_translations(("de", "Bau"), ("fr", "")))) == "Bau"
    assert value(text.preferred_translation(_translations(("de", ""), ("it", "Lavori")))) == "Lavori"
    assert value(text.preferred_translation(_translations(("de", "")))) is None


def test_first_filled(value):
    assert value(text.first_filled(F.array(F.lit(""), F.lit("b"), F.lit("c")))) == "b"
    assert value(text.first_filled(F.array(F.lit("")))) is None


def test_searches_keep_wildcards_and_backslashes(value):
    name = F.lit("SAINT MALO")
    assert value(text.name_search(name, "malo"))
    assert value(text.name_search(name, "s%o"))
    assert not value(text.name_search(name, "\\"))
    assert value(text.name_search(F.lit("SAINT ETIENNE"), "étienne", normalize_query=True))
    assert not value(text.name_search(F.lit("SAINT ETIENNE"), "étienne"))
    assert value(text.label_search(F.lit("PARIS -> Lyon"), "paris"))


def test_exact_mean_does_not_depend_on_order(spark):
    rows = [(90.01,), (90.02,), (None,)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "x double")
        assert df.agg(numeric.exact_mean(F.col("x")).alias("m")).head()[0] == 90.02
    empty = spark.createDataFrame([(None,)], "x double")
    assert empty.agg(numeric.exact_mean(F.col("x")).alias("m")).head()[0] is None
