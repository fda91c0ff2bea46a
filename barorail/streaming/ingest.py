"""Feed snapshots to a stream of trip messages."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.messages import trip_messages
from ..sinks.writers import keyed_messages
from ..sources.readers import read_feeds
from .state import POLL_SECONDS

Shape = Callable[[DataFrame], DataFrame]


def publish_stream(
    feeds: DataFrame,
    to_messages: Shape,
    out: str,
    checkpoint: str,
    once: bool = False,
) -> StreamingQuery:
    """Turn each micro-batch of snapshots into message lines below ``out``, in compressed files.

    The conversion runs on the batch rows, so the static lookups join and regroup as in a batch
    job, without stream state. The folder of a batch is replaced when that batch is run again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        keyed_messages(to_messages(batch)).select("value").write.mode("overwrite").text(
            f"{out}/batch={batch_id:09d}", compression="gzip"
        )

    trigger = {"availableNow": True} if once else {"processingTime": f"{POLL_SECONDS} seconds"}
    return (
        feeds.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def country_feeds(spark: SparkSession, folders: dict[str, str]) -> DataFrame:
    """The snapshot streams of several countries as one stream with a ``pays`` column."""
    streams = [
        read_feeds(spark, folder, stream=True).withColumn("pays", F.lit(country))
        for country, folder in folders.items()
    ]
    return reduce(DataFrame.unionByName, streams)


def country_messages(
    feeds: DataFrame,
    rail_routes: dict[str, DataFrame],
    rail_trips: dict[str, DataFrame],
    stop_maps: dict[str, DataFrame],
    captured_at: Column | None = None,
) -> DataFrame:
    """Messages of snapshots that carry ``pays``, each country with its own allowlist and timetable.

    The timetables in ``stop_maps`` are reduced by ``write_timetable`` or ``trip_timetables`` beforehand,
    once, not with every micro-batch.
    """
    special = sorted({*rail_routes, *rail_trips, *stop_maps})
    parts = [
        trip_messages(
            feeds.filter(F.col("pays") == country),
            None,
            rail_routes=rail_routes.get(country),
            rail_trips=rail_trips.get(country),
            stop_map=stop_maps.get(country),
            captured_at=captured_at,
            map_is_reduced=True,
        )
        for country in special
    ]
    parts.append(
        trip_messages(feeds.filter(~F.col("pays").isin(*special)), None, captured_at=captured_at)
        if special
        else trip_messages(feeds, None, captured_at=captured_at)
    )
    return reduce(DataFrame.unionByName, parts)
