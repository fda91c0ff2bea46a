"""Casts, rounding and exact means."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_double(c: Column) -> Column:
    """Double, or NULL when the text is not a number."""
    return c.try_cast("double")


def safe_int(c: Column) -> Column:
    """Integer, or NULL when the text is not a number; fractions round half to even."""
    return F.rint(c.try_cast("double")).try_cast("int")


def round_to(c: Column, digits: int) -> Column:
    """Round half away from zero on the scaled double.

    Spark's own ``round`` works on the decimal text of the double, which differs from the usual
    C rounding in about 0.5 % of values.
    """
    scale = float(10**digits)
    return F.round(c * F.lit(scale)) / F.lit(scale)


def percent(numerator: Column, denominator: Column) -> Column:
    """Percentage with two decimals; NULL unless the denominator is positive."""
    return F.when(denominator > 0, round_to(F.lit(100.0) * numerator / denominator, 2))


def scaled_sum(c: Column, decimals: int) -> Column:
    """Exact sum of a column whose values carry ``decimals`` decimals, in units of 10^-decimals.

    Whole-number addition gives the same answer in any shuffle order and after any task retry.
    """
    return F.sum(F.round(c * F.lit(float(10**decimals))).cast("long"))


def mean_from(total: Column, count: Column, decimals: int, digits: int | None) -> Column:
    """Mean out of a ``scaled_sum`` and a count, rounded to ``digits`` when given."""
    if digits is None:
        return total.cast("double") / (count.cast("double") * F.lit(float(10**decimals)))
    units = F.lit(float(10 ** (decimals - digits)))
    return F.round(total.cast("double") / (count.cast("double") * units)) / F.lit(float(10**digits))


def exact_mean(c: Column, decimals: int = 2, digits: int | None = 2) -> Column:
    """Aggregate: mean of a rounded column, itself rounded to ``digits``; NULL for no values."""
    count = F.count(c)
    return F.when(count > 0, mean_from(scaled_sum(c, decimals), count, decimals, digits))
