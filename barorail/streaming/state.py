"""The latest state of every trip, kept from a stream of messages.

Each micro-batch writes its own folder of changes (the last message per key within the batch).
Writing a batch again replaces just that folder, so a replay after a failure changes nothing. The
current state is the change of highest batch number per key; ``compact`` folds old changes into a
snapshot so that reads stay short.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.keyed import latest_per_key
from ..plans.messages import with_default_country
from ..schemas import TRIP_STATE

POLL_SECONDS = 120
#: How far behind the newest feed time a message may come and still count.
LATENESS = "1 hour"


def batch_changes(messages: DataFrame, keys: list[str], updated_at: Column) -> DataFrame:
    """The last message to arrive for each key, stamped with the time of writing.

    Messages are in order of ``arrivee``, and of their rows where that is equal.
    """
    numbered = with_default_country(messages).withColumn("_row_no", F.monotonically_increasing_id())
    last = latest_per_key(numbered, keys, F.struct("arrivee", "_row_no"))
    return last.select(
        "trip_id",
        "route_id",
        "pays",
        "stops",
        "feed_timestamp",
        F.timestamp_seconds("captured_at").alias("captured_at"),
        updated_at.alias("updated_at"),
    )


def once_each(messages: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """A stream of messages without replays: each message passes once, however often it is sent.

    What has passed is remembered until the watermark, ``lateness`` behind the newest feed time, is beyond
    it; what comes after that is late and does not pass at all. So the memory holds the messages of
    ``lateness``, not of all time, and a replay of any age changes nothing.
    """
    at = F.timestamp_seconds(F.coalesce("feed_timestamp", "captured_at", F.lit(0)))
    named = with_default_country(messages).withColumn("_at", at).withColumn("_said", F.xxhash64("route_id", "stops"))
    watched = named.withWatermark("_at", lateness)
    return watched.dropDuplicatesWithinWatermark(["trip_id", "pays", "feed_timestamp", "_said"]).drop("_at", "_said")


def _write_batch(path: str, keys: list[str], clock: Callable[[], Column]) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch_changes(batch, keys, clock()).write.mode("overwrite").parquet(
            f"{path}/changes/batch_id={batch_id}"
        )

    return write


def upsert_stream(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    keys: list[str] | None = None,
    once: bool = False,
    clock: Callable[[], Column] = F.current_timestamp,
) -> StreamingQuery:
    """Keep the latest state of ``messages`` below ``path``; ``once`` stops when all input is read.

    ``keys`` defaults to the trip id alone; add ``pays`` where ids of countries may collide.
    """
    writer = messages.writeStream.foreachBatch(_write_batch(path, keys or ["trip_id"], clock)).option(
        "checkpointLocation", checkpoint
    )
    trigger = {"availableNow": True} if once else {"processingTime": f"{POLL_SECONDS} seconds"}
    return writer.trigger(**trigger).start()


def _last_snapshot(spark: SparkSession, path: str) -> int | None:
    """Batch number of the newest finished snapshot; it is noted only once it is complete."""
    try:
        return spark.read.schema("upto bigint").parquet(f"{path}/snapshot_log").agg(F.max("upto")).head()[0]
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error.getCondition()):
            raise
        return None


def _versions(spark: SparkSession, path: str, after: int | None = None) -> DataFrame:
    """Every row still needed, with the batch number that wrote it."""
    try:
        changes = spark.read.schema(TRIP_STATE).parquet(f"{path}/changes")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error.getCondition()):
            raise
        return spark.createDataFrame([], TRIP_STATE)  # nothing has arrived yet
    if after is None:
        return changes
    snapshot = spark.read.schema(TRIP_STATE).parquet(f"{path}/snapshots/upto={after}")
    # The filter is on the partition column: older change folders are not read.
    return snapshot.unionByName(changes.filter(F.col("batch_id") > after))


def _latest(versions: DataFrame, keys: list[str]) -> DataFrame:
    return latest_per_key(versions, keys, F.col("batch_id"))


def current_state(
    spark: SparkSession, path: str, keys: list[str] | None = None, updated_after: Column | None = None
) -> DataFrame:
    """The latest row per key, optionally only of keys updated after a time.

    Later batches are written at later times, so the older rows can go before the aggregate; the
    files of old batches are then skipped by their time range.
    """
    versions = _versions(spark, path, _last_snapshot(spark, path))
    if updated_after is not None:
        versions = versions.filter(F.col("updated_at") > updated_after)
    return _latest(versions, keys or ["trip_id"]).drop("batch_id")


def compact(
    spark: SparkSession, path: str, upto: int, keys: list[str] | None = None, expired_before: Column | None = None
) -> None:
    """Fold all changes up to batch ``upto`` into a snapshot. Readers use it once it is noted.

    Keys last updated before ``expired_before`` do not go on into the snapshot: they have left the state,
    until a message brings them back.
    """
    last = _last_snapshot(spark, path)
    if last is not None and last >= upto:
        return
    versions = _versions(spark, path, last).filter(F.col("batch_id") <= upto)
    latest = _latest(versions, keys or ["trip_id"])
    if expired_before is not None:
        latest = latest.filter(F.col("updated_at") >= expired_before)
    latest.write.mode("overwrite").parquet(f"{path}/snapshots/upto={upto}")
    spark.range(1).select(F.lit(upto).cast("bigint").alias("upto")).write.mode("append").parquet(
        f"{path}/snapshot_log"
    )
    if last is not None:
        _remove_folded(spark, path, last)


def _remove_folded(spark: SparkSession, path: str, upto: int) -> None:
    """Remove the changes a snapshot has folded, and the snapshots before it.

    Called with the snapshot before the newest: a reader that began on that one still finds it and all
    changes after it, so a read may last as long as the time between two snapshots.
    """
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for folder, prefix, most in (("changes", "batch_id=", upto), ("snapshots", "upto=", upto - 1)):
        for status in files.globStatus(jvm.org.apache.hadoop.fs.Path(f"{path}/{folder}/{prefix}*")):
            name = status.getPath().getName()
            if int(name[len(prefix) :]) <= most:
                files.delete(status.getPath(), True)
