"""The given tables seen as the library's inputs.

Names, positions and times follow from the columns by plain arithmetic, so the same inputs can be
stated in SQL (``sql.py``). Every table is read whole; a source that is about some kinds of row only, such
as disruptions or one of the station lists, takes all rows of those kinds.
"""

from __future__ import annotations

import datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..plans import gtfs, harmonize, lines, realtime, stations
from ..schemas import COUNTRIES, STOPS
from ..session import scratch_dir, tune

NOW = 1705363200  # 2024-01-16 00:00 UTC, inside the period of the events
AS_OF = datetime.date(2024, 1, 31)
# A trip is what one user does in one week.
WEEK = 604_800


def _text(*parts) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def _coordinate(key: Column, factor: int, span: int, offset: int) -> Column:
    return (F.pmod(key * factor, F.lit(span)) - offset).cast("string")


def line_name(part_type: Column) -> Column:
    return F.replace(
        F.replace(part_type, F.lit("SMALL"), F.lit("ST-SMALL")), F.lit("LARGE"), F.lit("LÂRGE")
    )


def station_name(part_type: Column) -> Column:
    return F.lower(F.replace(part_type, F.lit("SMALL"), F.lit("SAINT SMALL")))


def position_text(name: Column, key: Column) -> Column:
    """``"lat, lon"`` near a place that follows from the name."""
    milli = F.lpad(F.pmod(key, F.lit(1000)).cast("string"), 3, "0")
    lat = F.lit(40) + F.pmod(F.ascii(F.right(name, F.lit(1))), F.lit(10))
    lon = F.length(name) + F.pmod(F.ascii(F.substring(name, 2, 1)), F.lit(7))
    return _text(lat, ".", milli, ", ", lon, ".", milli)


_SCHEMAS: dict[str, StructType] = {}


class Views:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = tune(spark)
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            path = f"{self.sf_dir}/{name}.parquet"
            # Looking up a schema is a job of its own; once per path is enough.
            if path not in _SCHEMAS:
                _SCHEMAS[path] = self.spark.read.parquet(path).schema
            self._tables[name] = self.spark.read.schema(_SCHEMAS[path]).parquet(path)
        return self._tables[name]

    # Monthly sources

    @cached_property
    def tgv(self) -> DataFrame:
        cancelled = F.col("l_returnflag") == "R"
        n, gone = F.count("*"), F.count_if(cancelled)
        rows = self.table("lineitem").join(self.table("part"), F.col("l_partkey") == F.col("p_partkey"))
        return rows.groupBy(
            F.date_format("l_shipdate", "yyyy-MM").alias("Date"),
            line_name(F.col("p_type")).alias("Gare de départ"),
            F.col("p_brand").alias("Gare d'arrivée"),
        ).agg(
            n.cast("string").alias("Nombre de circulations prévues"),
            gone.cast("string").alias("Nombre de trains annulés"),
            F.count_if(~cancelled & (F.col("l_linestatus") == "O"))
            .cast("string")
            .alias("Nombre de trains en retard à l'arrivée"),
            F.when(n > gone, (F.sum("l_quantity") / n).cast("string")).alias(
                "Retard moyen de tous les trains à l'arrivée"
            ),
        )

    def _order_counts(self, rows: DataFrame, *keys: Column) -> DataFrame:
        status = F.col("o_orderstatus")
        return rows.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("Date"), *keys).agg(
            F.count("*").cast("string").alias("Nombre de trains programmés"),
            F.count_if(status != "P").cast("string").alias("Nombre de trains ayant circulé"),
            F.count_if(status == "P").cast("string").alias("Nombre de trains annulés"),
            F.count_if((status == "O") & (F.col("o_totalprice") > 250000))
            .cast("string")
            .alias("Nombre de trains en retard à l'arrivée"),
        )

    @cached_property
    def ter(self) -> DataFrame:
        return self._order_counts(self.table("orders"), F.col("o_orderpriority").alias("Région"))

    @cached_property
    def customers(self) -> DataFrame:
        return self.table("customer").join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))

    @cached_property
    def intercites(self) -> DataFrame:
        rows = self.table("orders").join(self.customers, F.col("o_custkey") == F.col("c_custkey"))
        return self._order_counts(rows, F.col("c_mktsegment").alias("Départ"), F.col("n_name").alias("Arrivée"))

    @cached_property
    def fact(self) -> DataFrame:
        return harmonize.harmonize(self.tgv, self.ter, self.intercites)

    # Stations

    def _gares(self, df: DataFrame, letter: str, key: str, base: int, name: Column, place: Column) -> DataFrame:
        return df.select(
            name.alias("Nom_Gare"),
            F.upper(F.substring(name, 1, 3)).alias("Trigramme"),
            F.lit("A").alias("Segment(s) DRG"),
            position_text(place, F.col(key)).alias("Position géographique"),
            F.col(key).cast("string").alias("Code commune"),
            (F.col(key) + base).cast("string").alias("Code_UIC"),
            _text(letter, F.col(key)).alias("Id_Gare"),
        )

    @cached_property
    def gares(self) -> DataFrame:
        part = self.table("part")
        suppliers = self.table("supplier").join(
            self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey")
        )
        brand, kind, nation, segment = (F.col(c) for c in ("p_brand", "p_type", "n_name", "c_mktsegment"))
        return (
            self._gares(part, "P", "p_partkey", 80_000_000, brand, brand)
            .unionByName(
                self._gares(
                    part.filter(kind != "PROMO"), "T", "p_partkey", 81_000_000, station_name(kind), kind
                )
            )
            .unionByName(self._gares(suppliers, "S", "s_suppkey", 87_000_000, F.lower(nation), nation))
            .unionByName(self._gares(self.table("customer"), "C", "c_custkey", 82_000_000, segment, segment))
        )

    def _stops(self, df: DataFrame, stop_id: Column, name: str, key: str, *more: Column) -> DataFrame:
        return df.select(
            stop_id.alias("stop_id"),
            F.col(name).alias("stop_name"),
            _coordinate(F.col(key), 37, 170, 85).alias("stop_lat"),
            _coordinate(F.col(key), 73, 360, 180).alias("stop_lon"),
            *more,
        )

    @cached_property
    def ch_stops(self) -> DataFrame:
        key = F.col("c_custkey")
        code = F.when(F.col("c_acctbal") >= 0, (F.floor(key / 3) + 8_500_000).cast("string"))
        return self._stops(
            self.table("customer"), _text("ch:1:sloid:", key, ":0"), "c_name", "c_custkey", code.alias("didok")
        )

    def gtfs_stops(self, country: str) -> DataFrame:
        if country == "NL":
            df = self.table("supplier")
            out = self._stops(df, (F.col("s_suppkey") + 1_000_000).cast("string"), "s_name", "s_suppkey", F.col("s_acctbal"))
            return out.withColumn("stop_lat", F.when(F.col("s_acctbal") >= 0, F.col("stop_lat"))).drop("s_acctbal")
        if country == "IT":
            return self._stops(self.table("nation"), F.col("n_nationkey").cast("string"), "n_name", "n_nationkey")
        if country == "PL":
            return self._stops(self.table("supplier"), _text(F.col("s_suppkey"), "_RAIL_1"), "s_name", "s_suppkey")
        if country == "DE":
            return self._stops(self.table("part"), F.col("p_partkey").cast("string"), "p_name", "p_partkey")
        if country == "SE":
            stop = _text("9022", F.lpad(F.col("s_suppkey").cast("string"), 12, "0"))
            return self._stops(self.table("supplier"), stop, "s_name", "s_suppkey")
        raise ValueError(country)

    @cached_property
    def fi_stations(self) -> DataFrame:
        key = F.col("s_suppkey")
        return self.table("supplier").select(
            F.col("s_name").alias("stationName"),
            _text("F", key).alias("stationShortCode"),
            key.alias("stationUICCode"),
            F.when(F.col("s_nationkey") < 20, F.lit("FI")).otherwise(F.lit("RU")).alias("countryCode"),
            _coordinate(key, 73, 360, 180).cast("double").alias("longitude"),
            _coordinate(key, 37, 170, 85).cast("double").alias("latitude"),
        )

    @cached_property
    def fr_slice(self) -> DataFrame:
        return stations.stations_fr(self.gares)

    @cached_property
    def slices(self) -> list[DataFrame]:
        return [
            self.fr_slice,
            stations.stations_ch(self.ch_stops),
            *[stations.stations_gtfs(self.gtfs_stops(c), c) for c in ("NL", "IT", "PL", "DE", "SE")],
            stations.stations_fi(self.fi_stations),
        ]

    @cached_property
    def dim_stations(self) -> DataFrame:
        return stations.stations_all(self.slices)

    @cached_property
    def dim_table(self) -> DataFrame:
        return self.written("stations", self.dim_stations)

    @cached_property
    def lookup(self) -> DataFrame:
        return stations.station_lookup(self.dim_table)

    # Timetables

    @cached_property
    def routes(self) -> DataFrame:
        return self.table("part").select(
            _text("R", F.col("p_partkey")).alias("route_id"),
            F.col("p_size").cast("string").alias("agency_id"),
            F.when(F.col("p_type") != "PROMO", F.col("p_brand")).otherwise(F.lit("")).alias("route_short_name"),
            (F.col("p_size") + 80).cast("string").alias("route_type"),
        )

    @cached_property
    def basic_routes(self) -> DataFrame:
        """The same routes under basic route types."""
        part = self.table("part")
        return part.select(
            _text("R", F.col("p_partkey")).alias("route_id"),
            F.col("p_size").cast("string").alias("agency_id"),
            F.col("p_brand").alias("route_short_name"),
            F.when(F.col("p_type") == "STANDARD", F.lit("2")).otherwise(F.lit("3")).alias("route_type"),
        )

    @cached_property
    def agency(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey").cast("string").alias("agency_id"), F.col("s_name").alias("agency_name")
        )

    @cached_property
    def trips(self) -> DataFrame:
        return self.table("lineitem").select(
            _text("R", F.col("l_partkey")).alias("route_id"),
            _text(F.col("l_orderkey"), "-", F.col("l_linenumber")).alias("trip_id"),
            F.when(F.col("l_linestatus") == "O", F.concat("l_returnflag", "l_linestatus"))
            .otherwise(F.lit(""))
            .alias("trip_long_name"),
            _text("SH", F.col("l_suppkey")).alias("shape_id"),
        )

    @cached_property
    def shapes(self) -> DataFrame:
        key = F.col("event_id")
        return self.table("events").select(
            _text("SH", F.col("user_id")).alias("shape_id"),
            key.cast("string").alias("shape_pt_sequence"),
            _coordinate(key, 37, 170, 85).alias("shape_pt_lat"),
            _coordinate(key, 73, 360, 180).alias("shape_pt_lon"),
        )

    @cached_property
    def stop_times(self) -> DataFrame:
        hours = F.floor(F.col("l_quantity") / 2).cast("string")
        minutes = F.lpad((F.col("l_tax") * 100).cast("int").cast("string"), 2, "0")
        return self.table("lineitem").select(
            F.col("l_orderkey").cast("string").alias("trip_id"),
            F.col("l_linenumber").cast("string").alias("stop_sequence"),
            F.col("l_suppkey").cast("string").alias("stop_id"),
            F.concat(hours, F.lit(":"), minutes, F.lit(":30")).alias("arrival_time"),
            F.when(F.col("l_returnflag") != "A", F.concat(hours, F.lit(":"), minutes, F.lit(":59"))).alias(
                "departure_time"
            ),
        )

    # Fares

    @cached_property
    def tgv_fares(self) -> DataFrame:
        size, price = F.col("p_size"), F.col("p_retailprice")
        carrier = (
            F.when(size <= 15, "TGV INOUI")
            .when(size <= 30, "OUIGO")
            .when(size <= 40, "OUIGO TRAIN CLASSIQUE")
            .otherwise("TER")
        )
        return self.table("part").select(
            carrier.alias("Transporteur"),
            station_name(F.col("p_type")).alias("Gare origine"),
            F.lower("p_brand").alias("Gare destination"),
            F.when(size >= 14, "2").otherwise("1").alias("Classe"),
            F.when(F.col("p_name").startswith("small"), "Tarif Réglementé")
            .otherwise("Tarif Normal")
            .alias("Profil tarifaire"),
            price.cast("string").alias("Prix minimum"),
            (price + size).cast("string").alias("Prix maximum"),
        )

    @cached_property
    def ic_fares(self) -> DataFrame:
        balance = F.abs("c_acctbal")
        return self.customers.select(
            F.lit("Intercités").alias("Transporteur"),
            F.lower("c_mktsegment").alias("Gare origine"),
            F.lower("n_name").alias("Gare destination"),
            F.lit("2").alias("Classe"),
            F.lit("Tarif Normal").alias("Profil tarifaire"),
            balance.cast("string").alias("Prix minimum"),
            (balance + 25).cast("string").alias("Prix maximum"),
        )

    @cached_property
    def lines(self) -> DataFrame:
        return lines.liaisons(self.fact, self.dim_stations)

    @cached_property
    def fares(self) -> DataFrame:
        return lines.fares(self.tgv_fares, self.ic_fares, self.lines, AS_OF)

    # Written gold tables, for queries that read a table more than once

    def written(self, name: str, df: DataFrame) -> DataFrame:
        path = scratch_dir(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    @cached_property
    def fact_table(self) -> DataFrame:
        return self.written("fact", self.fact)

    @cached_property
    def lines_table(self) -> DataFrame:
        return self.written("liaisons", lines.liaisons(self.fact_table, self.dim_table))

    @cached_property
    def fares_table(self) -> DataFrame:
        return self.written("fares", lines.fares(self.tgv_fares, self.ic_fares, self.lines_table, AS_OF))

    # Live data

    @cached_property
    def stop_events(self) -> DataFrame:
        k = F.floor("value").cast("bigint")
        late = (F.get_json_object("props", "$.k").cast("bigint") - 20) * 15
        at = F.unix_timestamp("ts")
        kind, user = F.col("event_type"), F.col("user_id")
        pays = F.get(F.array(*[F.lit(c) for c in COUNTRIES]), F.pmod(user, F.lit(8)).cast("int"))
        events = self.table("events").select("*", pays.alias("pays"), k.alias("k"))
        k, pays = F.col("k"), F.col("pays")
        stop = (
            F.when(pays == "FR", _text("StopPoint:OCETGV INOUI-", k + 87_000_000))
            .when((pays == "CH") & (kind == "click"), _text("ch:1:sloid:", k, ":0"))
            .when(pays == "CH", _text("stop-", k + 8_500_000))
            .when(pays == "NL", _text("stoparea:", k + 1_000_000))
            .when(pays == "PL", _text(k, "_RAIL_1"))
            .when(pays == "SE", _text("9022", F.lpad(k.cast("string"), 12, "0")))
            .otherwise(k.cast("string"))
        )
        block = F.floor(F.unix_timestamp("ts") / WEEK).cast("bigint")
        trip = (
            F.when(pays == "FR", _text("OCESN", user, "F", block))
            .when(pays == "NL", _text(user, "-", block + 1))
            .otherwise(_text("T", user, "-", block))
        )
        timed = kind != "signup"
        return events.select(
            trip.alias("trip_id"),
            F.when(pays.isin("CH", "NL", "IT"), _text("R", user)).alias("route_id"),
            "pays",
            "event_id",
            at.alias("at"),
            stop.alias("stop_id"),
            F.when(timed & (kind != "click"), at).alias("arrival_time"),
            F.when(kind != "error", late).alias("arrival_delay"),
            F.when(timed, at + 60).alias("departure_time"),
            F.when(kind == "purchase", late).alias("departure_delay"),
        )

    @cached_property
    def messages(self) -> DataFrame:
        stop = ["stop_id", "arrival_time", "arrival_delay", "departure_time", "departure_delay"]
        return (
            self.stop_events.groupBy("trip_id", "route_id", "pays")
            .agg(
                F.sort_array(F.collect_list(F.struct("event_id", F.struct(*stop).alias("s")))).alias("_s"),
                F.max("at").alias("feed_timestamp"),
            )
            .select(
                "trip_id",
                "route_id",
                "pays",
                F.transform("_s", lambda s: s["s"]).cast(STOPS).alias("stops"),
                "feed_timestamp",
                (F.col("feed_timestamp") + 5).alias("captured_at"),
            )
        )

    @cached_property
    def state(self) -> DataFrame:
        return self.messages.withColumn("updated_at", F.timestamp_seconds("feed_timestamp"))

    @cached_property
    def positions(self) -> DataFrame:
        return realtime.interpolate(self.messages, F.lit(NOW))

    @cached_property
    def disruptions(self) -> DataFrame:
        """One document per error event."""
        n = F.get_json_object("props", "$.k").cast("bigint")
        entry = F.struct(
            F.array(F.struct(F.lit("").alias("text")), F.struct(_text("Cause ", n).alias("text"))).alias("messages"),
            F.struct(F.when(n > 50, "NO_SERVICE").otherwise("SIGNIFICANT_DELAYS").alias("effect")).alias("severity"),
            F.array(
                F.struct(F.struct(F.struct(F.col("user_id").cast("string").alias("name")).alias("trip")).alias("pt_object"))
            ).alias("impacted_objects"),
        )
        return self.table("events").filter(F.col("event_type") == "error").select(
            "event_id", F.array(entry).alias("disruptions")
        )

    @cached_property
    def alerts(self) -> DataFrame:
        """One document per view event; some have no French text."""
        n = F.get_json_object("props", "$.k").cast("bigint")
        block = F.floor(F.unix_timestamp("ts") / WEEK).cast("bigint")
        language = F.when(n > 30, "fr").otherwise("it")
        translations = F.array(
            F.struct(F.lit("de").alias("language"), _text("Meldung ", n).alias("text")),
            F.struct(language.alias("language"), _text("Avis ", n).alias("text")),
        )
        informed = F.array(F.struct(F.struct(_text("T", F.col("user_id"), "-", block).alias("tripId")).alias("trip")))
        alert = F.struct(F.struct(translations.alias("translation")).alias("headerText"), informed.alias("informedEntity"))
        return self.table("events").filter(F.col("event_type") == "view").select(
            "event_id", F.array(F.struct(alert.alias("alert"))).alias("entity")
        )

    @cached_property
    def stop_map(self) -> DataFrame:
        return gtfs.stop_sequence_map(self.stop_times)

    @cached_property
    def feeds(self) -> DataFrame:
        """One snapshot per line item: its stop number is published, its stop id is not."""
        at = F.unix_timestamp("l_shipdate") + F.col("l_quantity").cast("bigint") * 1800
        quiet = F.lit(None).cast("bigint")
        update = F.struct(
            F.when(F.col("l_returnflag") == "R", _text("X", F.col("l_suppkey"))).otherwise(F.lit("")).alias("stop_id"),
            F.col("l_linenumber").alias("stop_sequence"),
            F.struct(at.alias("time"), quiet.alias("delay")).alias("arrival"),
            F.struct(
                (at + 60).alias("time"), F.when(F.col("l_linestatus") == "F", F.lit(30)).cast("bigint").alias("delay")
            ).alias("departure"),
        )
        trip = F.struct(
            F.col("l_orderkey").cast("string").alias("trip_id"),
            F.lit("").alias("route_id"),
            F.date_format("l_shipdate", "yyyyMMdd").alias("start_date"),
        )
        entity = F.struct(
            F.lit("0").alias("id"),
            F.struct(trip.alias("trip"), F.array(update).alias("stop_time_update")).alias("trip_update"),
        )
        return self.table("lineitem").select(
            F.struct(at.alias("timestamp")).alias("header"),
            F.array(entity).alias("entity"),
            # What tells one snapshot from another here; the files carry their path instead.
            F.concat_ws("/", *[F.col(c).cast("string") for c in (
                "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_discount"
            )]).alias("source_file"),
        )

    @cached_property
    def live_fi(self) -> DataFrame:
        """Live trains: the stops of each trip as rows of arrivals and departures."""
        stop = F.floor("value").cast("bigint")
        n = F.get_json_object("props", "$.k").cast("double")
        row = F.struct(
            stop.alias("stationUICCode"),
            F.when(F.col("event_type") == "view", "ARRIVAL").otherwise("DEPARTURE").alias("type"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("scheduledTime"),
            F.lit(None).cast("string").alias("actualTime"),
            F.when(F.col("event_type") != "click", n / 4).alias("differenceInMinutes"),
            (F.col("event_type") == "error").alias("cancelled"),
        )
        block = F.floor(F.unix_timestamp("ts") / WEEK).cast("bigint")
        return (
            self.table("events")
            .groupBy("user_id", block.alias("block"))
            .agg(F.sort_array(F.collect_list(F.struct("event_id", row.alias("r")))).alias("_rows"))
            .select(
                F.col("user_id").alias("trainNumber"),
                F.date_format(F.timestamp_seconds(F.col("block") * WEEK), "yyyy-MM-dd").alias("departureDate"),
                F.transform("_rows", lambda r: r["r"]).alias("timeTableRows"),
            )
        )

    @cached_property
    def log(self) -> DataFrame:
        user, kind = F.col("user_id"), F.col("event_type")
        path = (
            F.when(kind == "view", _text("/stations/", user))
            .when(kind == "click", "/stations")
            .when(kind == "purchase", "/regularite")
            .when(kind == "error", "/realtime/trains")
            .otherwise("/health")
        )
        n = F.get_json_object("props", "$.k").cast("int")
        status = F.when((kind == "error") & (n > 50), 500).when(kind == "error", 404).otherwise(200)
        return self.table("events").select(
            "ts",
            _text(F.pmod(user, F.lit(200)), ".", n, ".", F.pmod(F.col("event_id"), F.lit(250)), ".7").alias("ip"),
            F.lit("GET").alias("method"),
            path.alias("path"),
            status.alias("status"),
            (F.col("value") / 100).alias("duration_s"),
            _text("k", user).alias("api_key"),
        )

    @cached_property
    def live(self) -> DataFrame:
        rail_routes = self.routes
        return realtime.live_trains(
            self.state,
            self.lookup,
            gtfs.stop_uic(self.ch_stops),
            realtime.disruption_causes(self.disruptions, ["event_id"]),
            realtime.alert_causes(self.alerts, ["event_id"]),
            {
                "CH": gtfs.route_labels(rail_routes),
                "NL": gtfs.trip_labels(self.trips, self.basic_routes),
                "IT": gtfs.route_labels(rail_routes),
            },
            {
                "CH": gtfs.route_operators(rail_routes, self.agency),
                "NL": gtfs.route_operators(self.basic_routes, self.agency, rail_only=True),
            },
            F.lit(NOW),
            max_age_s=3600,
        )

    @cached_property
    def live_table(self) -> DataFrame:
        return self.written("live", self.live)
