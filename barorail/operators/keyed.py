"""One row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """The row of highest ``order`` for each key, columns in their original order.

    An aggregate, so a hot key shrinks to one row per task before the exchange.
    """
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def spread_nulls(key: Column, by: Column) -> Column:
    """Join key whose NULLs are scattered: they match nothing, yet would all meet in one task."""
    return F.coalesce(key, F.concat(F.lit("\u0000"), by))


def ranked_ends(df: DataFrame, score: str, n: int, labels: tuple[str, str], ties: list[str]) -> DataFrame:
    """The ``n`` best and the ``n`` worst rows, tagged in ``classement``."""
    tie_order = [F.col(t).asc() for t in ties]
    best = df.orderBy(F.col(score).desc_nulls_last(), *tie_order).limit(n)
    worst = df.orderBy(F.col(score).asc_nulls_last(), *tie_order).limit(n)
    return best.withColumn("classement", F.lit(labels[0])).unionByName(
        worst.withColumn("classement", F.lit(labels[1]))
    )
