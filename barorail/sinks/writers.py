"""Tables, exports and messages written out."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import geo
from ..sources.readers import read_raw
from ..sources.registry import SOURCES


def replace_table(df: DataFrame, path: str, cluster_by: tuple[str, ...] = ()) -> None:
    """Replace a table in full.

    ``cluster_by`` orders each file by columns that tell nearly every row apart, so that a lookup reads
    one run of rows a file and no hot value lands in a single task. Nothing upstream runs twice, as it
    would for finding ranges.
    """
    if cluster_by:
        df = df.repartition(*cluster_by).sortWithinPartitions(*cluster_by)
    df.write.mode("overwrite").parquet(path)


def replace_by_place(df: DataFrame, path: str, files: int) -> None:
    """Replace a table of places in so many files, each of which covers a few neighbouring areas.

    Rows are dealt by ranges of a curve that keeps near places together (``geo.z_order``) and follow it in each
    file, so the bounds of ``latitude`` and ``longitude`` that Parquet notes let a search in a box skip most
    files and row groups. Finding the ranges reads ``df`` once more: pass a written table.
    """
    named = df.withColumn("_z", geo.z_order(F.col("latitude"), F.col("longitude")))
    dealt = named.repartitionByRange(files, "_z").sortWithinPartitions("_z")
    dealt.drop("_z").write.mode("overwrite").parquet(path)


def export_csv(df: DataFrame, path: str, sep: str = ",", order_by: list[str] | None = None) -> None:
    """CSV parts with a header. Where rows are ordered, the order holds across the parts by name."""
    out = df.orderBy(*order_by) if order_by else df
    out.write.mode("overwrite").csv(path, header=True, sep=sep, escape='"', nullValue="", emptyValue="")


def export_result(df: DataFrame, path: str) -> int:
    """Write a result table and return its number of rows, counted as it was written."""
    seen = Observation()
    export_csv(df.observe(seen, F.count("*").alias("n")), path)
    return seen.get["n"]


def export_stations(stations: DataFrame, path: str) -> None:
    export_csv(stations, path, sep=";", order_by=["pays", "station_id"])


def export_allowlist(df: DataFrame, column: str, path: str) -> None:
    """One id per line."""
    df.select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)


def land_bronze(
    spark: SparkSession, raw_dir: str, bronze_dir: str, day: datetime.date, multiline: bool = True
) -> list[str]:
    """Copy every source that is there, with all its columns, to ``operator/category/dt=day/file``.

    Same-day reruns replace, also by a file without rows.
    """
    landed = []
    for name, spec in SOURCES.items():
        df = read_raw(spark, raw_dir, name, multiline)
        if df is None:
            continue
        target = f"{bronze_dir.rstrip('/')}/{spec.operator}/{spec.category}/dt={day.isoformat()}/{name}"
        df.write.mode("overwrite").parquet(target)
        landed.append(target)
    return landed


def land_partitioned(df: DataFrame, path: str) -> None:
    """Write rows that carry ``operateur, category, dt`` below those partitions.

    Only the partitions present in ``df`` are replaced, so a rerun of a day is idempotent.
    """
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "operateur", "category", "dt"
    ).parquet(path)


def stage_tables(
    spark: SparkSession, raw_dir: str, database: str | None = None, multiline: bool = True
) -> list[str]:
    """One staging table per source with every column found, replaced in full, named after the file.

    A source without a file is an empty table of the columns it should have.
    """
    tables = []
    for name, spec in SOURCES.items():
        table = f"{database}.{spec.table}" if database else spec.table
        df = read_raw(spark, raw_dir, name, multiline)
        if df is None:
            df = spark.createDataFrame([], spec.schema)
        # Accents, blanks and apostrophes are kept as they are in the column names.
        df.write.mode("overwrite").format("parquet").saveAsTable(table)
        tables.append(table)
    return tables


def keyed_messages(messages: DataFrame) -> DataFrame:
    """``key, value`` pairs to publish: trip id and the message as JSON."""
    return messages.select(
        F.col("trip_id").alias("key"),
        F.to_json(F.struct(*messages.columns), {"ignoreNullFields": "false"}).alias("value"),
    )


def publish_json(messages: DataFrame, path: str) -> None:
    keyed_messages(messages).select("value").write.mode("append").text(path)
