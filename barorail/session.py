"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Applied only where the session has no explicit value of its own.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split hot join partitions even where that costs one more exchange afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


PARTITION_BYTES = 128 * 1024 * 1024


def tune(spark: SparkSession, shuffle_bytes: int | None = None) -> SparkSession:
    """Turn on the adaptive settings the operators count on and pin the time zone to UTC.

    ``shuffle_bytes``, the size of the largest exchange expected, sets the number of shuffle
    partitions so that each holds about 128 MB; adaptive execution merges those that hold less.
    """
    explicit = spark.sparkContext.getConf()
    for key, value in _DEFAULTS.items():
        if not explicit.contains(key):
            spark.conf.set(key, value)
    if shuffle_bytes is not None:
        spark.conf.set("spark.sql.shuffle.partitions", str(max(1, -(-shuffle_bytes // PARTITION_BYTES))))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def local_session(cores: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("barorail")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BARORAIL_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A path for a fresh folder below ``spark.checkpoint.dir``, which every executor can reach.

    A cluster has to set it: its executors would not see each other's files in a folder of this machine.
    A session in one process, as in tests, gets a temporary folder where it is unset.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to a scratch folder and read back: nothing before it runs twice, or differently."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="barorail-")
