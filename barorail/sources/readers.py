"""Scans with declared schemas."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from .registry import SOURCES, SourceSpec


def _ordered_by_header(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """Read a CSV whose columns may come in any order or be more than the schema names.

    The header line alone is looked at; missing columns become NULL.
    """
    names = spark.read.csv(path, header=True, inferSchema=False, **options).columns
    types = {f.name.lower(): f for f in schema.fields}
    declared = T.StructType(
        [T.StructField(n, types[n.lower()].dataType if n.lower() in types else T.StringType()) for n in names]
    )
    df = spark.read.schema(declared).csv(path, header=True, enforceSchema=False, **options)
    present = {n.lower() for n in names}
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name.lower() in present else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def read_semicolon_csv(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = True) -> DataFrame:
    """Semicolon export: header, quoted fields that may hold line breaks, empty text is NULL.

    ``multiline=False`` lets a huge file without quoted line breaks be read in splits.
    """
    return _ordered_by_header(
        spark, path, schema, sep=";", multiLine=multiline, quote='"', escape='"', encoding="UTF-8"
    )


def read_gtfs_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Timetable file: comma separated, ids kept as text, split over tasks."""
    return _ordered_by_header(spark, path, schema, sep=",", quote='"', escape='"')


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A document that is one array of objects."""
    return spark.read.schema(schema).json(path, multiLine=True)


def read_json_variants(spark: SparkSession, path: str, schema: T.StructType | str, raw: str = "brut") -> DataFrame:
    """Objects of documents that are arrays or single objects: the declared fields, and all of each in ``raw``.

    Arrays are taken apart without a schema, so fields that nobody declared can still be had from ``raw``, a
    VARIANT. A field that does not fit its declared type is NULL, and the rest of its object stays. Files
    that are no JSON give no rows. Spark bounds the size of a VARIANT, and so of a document here; larger
    arrays go through ``read_json_array``.
    """
    declared = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    whole = spark.read.option("multiLine", True).option("singleVariantColumn", "_document").json(path)
    whole = whole.where("_document IS NOT NULL")
    listed = F.schema_of_variant("_document").startswith("ARRAY")
    elements = whole.where(listed).lateralJoin(spark.tvf.variant_explode(F.col("_document").outer()))
    objects = elements.select(F.col("value").alias(raw)).unionByName(whole.where(~listed).select(F.col("_document").alias(raw)))
    fields = [F.try_variant_get(raw, f"$['{f.name}']", f.dataType.simpleString()).alias(f.name) for f in declared]
    return objects.select(*fields, raw)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_raw(spark: SparkSession, raw_dir: str, name: str, multiline: bool = True) -> DataFrame | None:
    """Every column of a raw file as it stands, as text; None where there is no file."""
    spec: SourceSpec = SOURCES[name]
    path = f"{raw_dir.rstrip('/')}/{spec.filename}"
    try:
        if spec.filename.endswith(".json"):
            return spark.read.json(path, multiLine=True, primitivesAsString=True)
        if spec.semicolon:
            return spark.read.csv(
                path, header=True, sep=";", multiLine=multiline, quote='"', escape='"', encoding="UTF-8"
            )
        return spark.read.csv(path, header=True, quote='"', escape='"')
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error.getCondition()):
            raise
        return None


def read_source(spark: SparkSession, raw_dir: str, name: str, multiline: bool = True) -> DataFrame:
    """A registered source; one that is absent is an empty table, not an error."""
    spec: SourceSpec = SOURCES[name]
    path = f"{raw_dir.rstrip('/')}/{spec.filename}"
    try:
        if spec.filename.endswith(".json"):
            return read_json_array(spark, path, spec.schema)
        if spec.semicolon:
            return read_semicolon_csv(spark, path, spec.schema, multiline)
        return read_gtfs_csv(spark, path, spec.schema)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error.getCondition()):
            raise
        return spark.createDataFrame([], spec.schema)


def read_gold(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The chosen columns of a written table; only those are read."""
    return spark.read.parquet(path).select(*columns)


def read_allowlist(spark: SparkSession, path: str, column: str) -> DataFrame:
    """One id per line, blanks dropped."""
    return (
        spark.read.text(path)
        .select(F.trim("value").alias(column))
        .filter(F.length(column) > 0)
        .distinct()
    )


def read_stop_sequence_map(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.STOP_SEQUENCE_MAP).csv(path, header=True)


def read_feeds(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Decoded feed snapshots, one per line, with the file each came from."""
    reader = spark.readStream if stream else spark.read
    return reader.schema(S.FEED).json(path).withColumn("source_file", F.col("_metadata.file_path"))


def read_messages(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Trip messages, one per line, with their arrival order.

    ``arrivee`` orders by file time, file and split; lines of one split keep their own order.
    """
    reader = spark.readStream if stream else spark.read
    return reader.schema(S.TRIP_MESSAGE).json(path).withColumn("arrivee", arrival_order())


def arrival_order():
    return F.struct(
        F.col("_metadata.file_modification_time").alias("file_time"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
    )


def kafka_messages(spark: SparkSession, servers: str, topics: list[str]) -> DataFrame:
    """The same messages from a broker; needs the Kafka connector on the class path."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
        .load()
    )
    order = F.struct("timestamp", "topic", "partition", "offset").alias("arrivee")
    return raw.select(F.from_json(F.col("value").cast("string"), S.TRIP_MESSAGE).alias("m"), order).select(
        "m.*", "arrivee"
    )


def read_live_trains(spark: SparkSession, path: str) -> DataFrame:
    return read_json_array(spark, path, S.LIVE_TRAINS_FI)


def read_disruptions(spark: SparkSession, path: str) -> DataFrame:
    return read_json_array(spark, path, S.DISRUPTIONS)


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    return read_json_array(spark, path, S.ALERTS)
