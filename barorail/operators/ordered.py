"""Ranks, quantiles and rank correlation without putting a group into one task.

A window over a whole group would sort that group in a single task, and ``median`` keeps every
distinct value of a group in one hash map. Here equal values are counted first, a shuffle by range
deals them to partitions in their order, and each partition starts from what lies in those before it.
The ranges are written, since the bounds of a range shuffle come from a sample: a second run of the
same plan may choose others.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

#: Bits of ``monotonically_increasing_id`` that count rows; the others number the partition.
ROW_BITS = 33


def _meet(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Join in which NULL keys are keys like any other."""
    right = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(right, same).drop(*[f"_r_{k}" for k in keys])


def _offsets(sizes: DataFrame, part: str, size: str) -> DataFrame:
    """``part, _offset, total`` of all partitions; ``sizes`` has a row for each, which is all the driver gets."""
    told = sorted(sizes.select(part, size).collect())
    ends = list(accumulate(n for _, n in told))
    rows = [(p, end - n, ends[-1]) for (p, n), end in zip(told, ends)]
    return F.broadcast(sizes.sparkSession.createDataFrame(rows, f"{part} int, _offset long, total long"))


def running_counts(counts: DataFrame, keys: list[str], value: str, n: str = "n") -> DataFrame:
    """Add ``before`` (rows of the group with a smaller value) and ``total`` (rows of the group).

    ``counts`` has one row per ``keys`` and ``value``. A group of many values spans several partitions.
    """
    ranged = counts.repartitionByRange(*keys, value).withColumn("_part", F.spark_partition_id())
    ranged = written(ranged, "ranges")
    sizes = ranged.groupBy(*keys, "_part").agg(F.sum(n).alias("_size"))
    inside = Window.partitionBy(*keys, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_local", F.coalesce(F.sum(n).over(inside), F.lit(0)))
    if keys:
        group = Window.partitionBy(*keys)
        earlier = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        offsets = sizes.select(
            *keys,
            "_part",
            F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"),
            F.sum("_size").over(group).alias("total"),
        )
        placed = _meet(local, offsets, [*keys, "_part"])
    else:
        placed = local.join(_offsets(sizes, "_part", "_size"), "_part")
    return placed.withColumn("before", F.col("_offset") + F.col("_local")).drop("_part", "_offset", "_local")


def numbered(df: DataFrame, order: list[Column], name: str = "number") -> DataFrame:
    """``df`` with 1, 2, 3, ... in ``order``, which should tell all rows apart: no task sorts them all."""
    sorted_ = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = written(sorted_.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    rows = rows.withColumn("_part", F.shiftright("_at", ROW_BITS).cast("int"))
    offsets = _offsets(rows.groupBy("_part").agg(F.count("*").alias("_size")), "_part", "_size")
    place = F.col("_at").bitwiseAND(2**ROW_BITS - 1) + F.col("_offset") + 1
    return rows.join(offsets, "_part").withColumn(name, place).drop("_part", "_at", "_offset", "total")


def numbered_within(df: DataFrame, keys: list[str], order: list[str], name: str = "number") -> DataFrame:
    """``df`` with 0, 1, 2, ... in ``order`` inside each group, whatever the size of a group.

    A shuffle by range on keys and order cuts a large group into several partitions and keeps small ones
    together; a row's number is its place in its partition, less that of the first of its group there,
    plus the rows of the group in the partitions before.
    """
    sorted_ = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    rows = written(sorted_.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    rows = rows.withColumn("_part", F.shiftright("_at", ROW_BITS).cast("int"))
    sizes = rows.groupBy(*keys, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_size"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "_part", (F.coalesce(F.sum("_size").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    placed = _meet(rows, offsets, [*keys, "_part"])
    return placed.withColumn(name, F.col("_at") + F.col("_shift")).drop("_part", "_at", "_shift")


def value_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows per group and distinct non-null value."""
    return df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))


def quantile_summary(df: DataFrame, keys: list[str], value: str, q: float) -> DataFrame:
    """Per group ``total, lowest, highest`` and ``quantile``, interpolated between neighbours."""
    ranked = running_counts(value_counts(df, keys, value), keys, value)
    position = F.lit(float(q)) * (F.col("total") - 1)
    low, high = F.floor(position), F.ceil(position)
    upto = F.col("before") + F.col("n")

    def at(index):
        return F.max(F.when((F.col("before") <= index) & (upto > index), F.col(value)))

    ends = ranked.groupBy(*keys).agg(
        F.max("total").alias("total"),
        F.min(value).alias("lowest"),
        F.max(value).alias("highest"),
        at(low).alias("_low"),
        at(high).alias("_high"),
        F.max(position - low).alias("_part"),
    )
    return ends.select(
        *keys,
        "total",
        "lowest",
        "highest",
        (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_part")).alias("quantile"),
    )


def average_ranks(counts: DataFrame, value: str, name: str) -> DataFrame:
    """Value, its centred average rank, and the number of rows; ties share the mean rank."""
    centre = (F.col("total") + 1) / 2.0
    return running_counts(counts, [], value).select(
        value, (F.col("before") + (F.col("n") + 1) / 2.0 - centre).alias(name), "total"
    )


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row ``n, rho``: rank correlation of two columns, ``rho`` NULL without variation."""
    pairs = (
        df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
        .groupBy(x, y)
        .agg(F.count("*").alias("_pairs"))
    )
    pairs = written(pairs, "pairs")
    ranks_x = average_ranks(pairs.groupBy(x).agg(F.sum("_pairs").alias("n")), x, "_a").drop("total")
    ranks_y = average_ranks(pairs.groupBy(y).agg(F.sum("_pairs").alias("n")), y, "_b").drop("total")
    weight = F.col("_pairs")
    sums = pairs.join(ranks_x, x).join(ranks_y, y).agg(
        F.coalesce(F.sum(weight), F.lit(0)).alias("n"),
        F.sum(weight * F.col("_a") * F.col("_b")).alias("_ab"),
        F.sum(weight * F.col("_a") * F.col("_a")).alias("_aa"),
        F.sum(weight * F.col("_b") * F.col("_b")).alias("_bb"),
    )
    spread = F.sqrt(F.col("_aa") * F.col("_bb"))
    return sums.select("n", F.when(spread > 0, F.col("_ab") / spread).alias("rho"))
