"""Connected components of links between ids."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import passing, saved

#: Tasks that share the links of one id. The minimum of an id, one short row, goes to each of them; where
#: Spark broadcasts the minima instead, they are so many times as large as its threshold at most.
SALTS = 8


def components(links: DataFrame) -> DataFrame:
    """id, component: for every id in ``links`` (a, b) the smallest id it is linked with, over any steps.

    Large-star and small-star steps in turn hang every id on a smaller one until nothing changes, which
    takes a number of rounds in the order of the logarithm of the ids. An id with very many links is only
    ever reduced by a minimum or spread over the tasks of a join, never gathered.
    """
    with passing(links.sparkSession) as keep:
        edges = keep(_hung(links), "edges")
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)


def _hung(links: DataFrame) -> DataFrame:
    """Every id but the smallest of its component, as u, with the smallest, as v."""
    edges = _saved(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
    mark = _fingerprint(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = _with_least(both, least).where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _with_least(large, lower).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = _saved(small.unionByName(lower.withColumnRenamed("m", "v")))
        before, mark = mark, _fingerprint(edges)
        if mark == before:
            return edges


def _with_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """``edges`` with the minimum m of their u, those of one u dealt to many tasks by the other end."""
    salts = F.sequence(F.lit(0), F.lit(SALTS - 1))
    dealt = edges.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    return dealt.join(least.withColumn("salt", F.explode(salts)), ["u", "salt"])


def _saved(edges: DataFrame) -> DataFrame:
    return saved(edges.distinct(), "edges")


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).head())


def hung(near: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix of links the first row it hangs together with."""
    first = np.arange(len(near))
    while True:
        step = np.minimum(first, np.where(near, first[None, :], len(near)).min(axis=1, initial=len(near)))
        if (step == first).all():
            return first
        first = step
