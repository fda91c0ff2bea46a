"""Request counts, latencies and quotas from an access log.

A log row has ``ts, ip, method, path, status, duration_s, api_key``. The windowed operators run on
batch rows and, given a watermark, on streams.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import anonymize_ip, path_template
from ..operators import sketches

QUOTA_PER_MINUTE = 30

# Upper bounds of the latency buckets in seconds; a last one is unbounded.
LATENCY_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0)


def _template() -> Column:
    return path_template(F.col("path"))


def request_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("method", _template().alias("path"), "status").agg(F.count("*").alias("n"))


def totals(log: DataFrame) -> DataFrame:
    """All requests and those that failed."""
    return log.agg(
        F.count("*").alias("total"), F.count_if(F.col("status").between(400, 599)).alias("erreurs")
    )


def by_status(log: DataFrame) -> DataFrame:
    return log.groupBy("status").agg(F.count("*").alias("n"))


def anonymized(log: DataFrame) -> DataFrame:
    return log.withColumn("ip", anonymize_ip(F.col("ip")))


def log_lines(log: DataFrame) -> DataFrame:
    """The text of each log entry, address masked."""
    return log.select(
        "ts",
        F.concat(
            anonymize_ip(F.col("ip")),
            F.lit(' - "'),
            "method",
            F.lit(" "),
            "path",
            F.lit('" '),
            F.col("status").cast("string"),
        ).alias("ligne"),
    )


def _bucket_counts() -> list[Column]:
    """Cumulative requests per latency bound, a fixed number of counters per group."""
    return [
        F.count_if(F.col("duration_s") <= bound).alias(f"_le{i}") for i, bound in enumerate(LATENCY_BOUNDS)
    ] + [F.count("duration_s").alias("_all")]


def latency_histogram(log: DataFrame) -> DataFrame:
    """Cumulative request count per method, path and latency bound; the last bound is infinite."""
    bounds = [*LATENCY_BOUNDS, float("inf")]
    names = [f"_le{i}" for i in range(len(LATENCY_BOUNDS))] + ["_all"]
    rows = F.array(
        *[F.struct(F.lit(b).alias("borne_s"), F.col(n).alias("n")) for b, n in zip(bounds, names)]
    )
    return (
        log.groupBy("method", _template().alias("path"))
        .agg(*_bucket_counts())
        .select("method", "path", F.inline(rows))
    )


def histogram_quantile(q: float) -> Column:
    """Quantile out of the bucket counters, linear inside the bucket that holds it.

    Beyond the last finite bound the answer is that bound.
    """
    rank = F.lit(q) * F.col("_all")
    out = F.lit(LATENCY_BOUNDS[-1])
    for i in reversed(range(len(LATENCY_BOUNDS))):
        below = F.col(f"_le{i - 1}") if i else F.lit(0)
        low = LATENCY_BOUNDS[i - 1] if i else 0.0
        width = LATENCY_BOUNDS[i] - low
        inside = F.try_divide((rank - below).cast("double"), (F.col(f"_le{i}") - below).cast("double"))
        out = F.when(F.col(f"_le{i}") >= rank, F.lit(low) + F.lit(width) * inside).otherwise(out)
    return F.when(F.col("_all") > 0, out)


def latency_quantiles(
    log: DataFrame, q: float = 0.95, window: str = "5 minutes", slide: str = "1 minute"
) -> DataFrame:
    """Latency quantile per path over a sliding window, out of bucket counters."""
    grouped = log.groupBy(F.window("ts", window, slide), _template().alias("path"))
    out = grouped.agg(*_bucket_counts()).withColumn("latence_s", histogram_quantile(q))
    return out.select(
        F.col("window.start").alias("debut"), F.col("window.end").alias("fin"), "path", "latence_s"
    )


def latency_sketches(log: DataFrame, slot_seconds: int = 60, size: int = sketches.SIZE) -> DataFrame:
    """``path, slot_start, sketch``: what is kept of the durations of each slot; batch or stream."""
    keys = {"path": _template()}
    return sketches.slot_sketches(log, keys, "ts", "duration_s", f"{slot_seconds} seconds", size)


def sketched_latency(
    slots: DataFrame, q: float = 0.95, slot_seconds: int = 60, window_slots: int = 5
) -> DataFrame:
    """Requests and latency quantile per path over sliding windows of whole slots, out of their sketches.

    Windows begin with every slot that has requests, or up to ``window_slots`` - 1 slots before it.
    """
    merged = sketches.sliding_sketches(slots, ["path"], slot_seconds, window_slots)
    return merged.select(
        F.col("window_start").alias("debut"),
        "path",
        sketches.count_of("sketch").alias("n"),
        sketches.quantile_of("sketch", q).alias("latence_s"),
    )


def request_rate(log: DataFrame, window: str = "1 minute", seconds: int = 60) -> DataFrame:
    """Requests per second and path in each window."""
    return (
        log.groupBy(F.window("ts", window), _template().alias("path"))
        .agg(F.count("*").alias("n"))
        .select(
            F.col("window.start").alias("debut"),
            "path",
            (F.col("n") / F.lit(float(seconds))).alias("par_seconde"),
        )
    )


def quota_breaches(
    log: DataFrame, caller: str = "ip", limit: int = QUOTA_PER_MINUTE, window: str = "1 minute"
) -> DataFrame:
    """Callers above the limit on one endpoint within a fixed minute."""
    return (
        log.groupBy(F.window("ts", window), F.col(caller).alias("appelant"), _template().alias("path"))
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") > limit)
        .select(F.col("window.start").alias("debut"), "appelant", "path", "n")
    )
