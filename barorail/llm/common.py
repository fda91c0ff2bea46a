"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_passing: list[list[str]] = []


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read back: lineage is cut and nothing runs twice."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    if _passing:
        _passing[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables that are ``saved`` inside are removed at the end, but for those saved by what this gives.

    So a result that is kept has to be saved that way, since nothing else it could be read from is left.
    """
    made: list[str] = []
    kept_tables: list[str] = []

    def keep(df: DataFrame, label: str) -> DataFrame:
        table = saved(df, label)
        kept_tables.append(made.pop())
        return table

    _passing.append(made)
    try:
        yield keep
    finally:
        _passing.pop()
        if _passing:
            _passing[-1].extend(kept_tables)
        for path in made:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def unused(columns: list[str], name: str) -> str:
    """``name``, or that behind as many underscores as no column has (whatever its case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


#: Name of the column by which ``keyed`` tells rows apart, if the table has none of that name.
ROW = "_row"


def keyed(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` with a key of its own for every row, written with the table, and the key's name.

    Repeated rows and rows with NULL ids have keys of their own, too.
    """
    row = unused(df.columns, ROW)
    return saved(df.withColumn(row, F.monotonically_increasing_id()), "keyed"), row


#: Bytes of a batch of rows that goes to a Python worker, unless the session's settings name another size.
BATCH_BYTES = "4m"
_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Of long texts and sets Spark's own 64 MB are several times as much as Python objects."""
    if not spark.sparkContext.getConf().contains(_BYTES):
        spark.conf.set(_BYTES, BATCH_BYTES)


_kept: dict = {}


def kept(key, make: Callable):
    """What ``make`` returns, kept in this worker from task to task until another operator's task comes."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def map_rows(
    df: DataFrame, rows: Callable[..., Iterator[tuple]], schema: str, keeps: bool = False
) -> DataFrame:
    """Call ``rows`` with the columns of each Arrow batch as lists; it yields output rows.

    Batches are bounded by bytes, and output is sent after each of them and every few thousand rows, so
    that a task holds one batch of each side. Unless it ``keeps`` something, it drops what others have.
    """
    small_batches(df.sparkSession)
    struct = T.StructType.fromDDL(schema)
    # The schema is plain data; building it here keeps the closure free of Spark objects.
    arrow = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            _kept.clear()
        for batch in batches:
            out: list[tuple] = []
            for row in rows(*(c.to_pylist() for c in batch.columns)):
                out.append(row)
                if len(out) >= 4096:
                    yield _batch(out, arrow)
                    out = []
            if out:
                yield _batch(out, arrow)

    return df.mapInArrow(run, struct)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def labelled(labels: DataFrame, column: str) -> DataFrame:
    """All labelled ids (doc_id, ``column``), one row each.

    Ids with a NULL or with labels that contradict each other are no examples.
    """
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min(column).alias(column), F.max(column).alias("_most"))
        .where(F.col(column) == F.col("_most"))
        .select("doc_id", column)
    )


def label_sample(labels: DataFrame, column: str, rows: int) -> DataFrame:
    """At most ``rows`` of the ``labelled`` ids, those of lowest hash: the same on every run."""
    return labelled(labels, column).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def map_groups(
    df: DataFrame, keys: list[str], group: Callable[[tuple, list[tuple]], Iterator[tuple]], schema: str
) -> DataFrame:
    """Call ``group`` with each key and its rows (without the key columns), one group in memory at a time.

    Groups follow each other in a task, sorted by key, so that many small ones cost little; the caller
    sees to it that the largest is bounded.
    """
    small_batches(df.sparkSession)
    rest = [c for c in df.columns if c not in keys]
    struct = T.StructType.fromDDL(schema)
    arrow, width = to_arrow_schema(struct), len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _kept.clear()
        out: list[tuple] = []
        key, held = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:width] != key:
                    if held:
                        out += group(key, held)
                    key, held = row[:width], []
                    if len(out) >= 4096:
                        yield _batch(out, arrow)
                        out = []
                held.append(row[width:])
        if held:
            out += group(key, held)
        if out:
            yield _batch(out, arrow)

    dealt = df.select(*keys, *rest).repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, struct)
