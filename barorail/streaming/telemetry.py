"""Access log operators over a stream: the batch operators behind a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..plans import accesslog

LATENESS = "2 minutes"


def watched(log: DataFrame, lateness: str = LATENESS) -> DataFrame:
    return log.withWatermark("ts", lateness)


def request_rate(log: DataFrame, lateness: str = LATENESS) -> DataFrame:
    return accesslog.request_rate(watched(log, lateness))


def latency_p95(log: DataFrame, lateness: str = LATENESS) -> DataFrame:
    return accesslog.latency_quantiles(watched(log, lateness), 0.95)


def latency_sketches(log: DataFrame, slot_seconds: int = 60, lateness: str = LATENESS) -> DataFrame:
    """Sketches of closed slots, for ``accesslog.sketched_latency`` to merge: the state holds open slots only."""
    return accesslog.latency_sketches(watched(log, lateness), slot_seconds)


def quota_breaches(log: DataFrame, caller: str = "ip", lateness: str = LATENESS) -> DataFrame:
    return accesslog.quota_breaches(watched(log, lateness), caller)


def write_windows(windows: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append each window once the watermark has passed it."""
    trigger = {"availableNow": True} if once else {"processingTime": "10 seconds"}
    return (
        windows.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
