"""Tests of the two hypotheses: line type against punctuality, price against punctuality."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import exact_mean
from ..operators.ordered import spearman

ALPHA = 0.05


def log_beta(a: float, b: float) -> float:
    """Logarithm of the beta function, without taking large logarithms from each other."""
    a, b = min(a, b), max(a, b)
    if b < 10:
        return math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b)

    def rest(x: float) -> float:
        """What Stirling's formula leaves of log gamma, for x of 10 or more."""
        y = 1.0 / (x * x)
        return (1 / 12 - y * (1 / 360 - y * (1 / 1260 - y * (1 / 1680 - y / 1188)))) / x

    if a < 10:
        return math.lgamma(a) + rest(b) - rest(a + b) + a - a * math.log(a + b) + (b - 0.5) * math.log1p(-a / (a + b))
    share = a / (a + b)
    shift = (a - 0.5) * math.log(share) + b * math.log1p(-share) - 0.5 * math.log(b)
    return shift + 0.5 * math.log(2 * math.pi) + rest(a) + rest(b) - rest(a + b)


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - incomplete_beta(b, a, 1.0 - x)
    tiny = 1e-300
    scale = math.exp(a * math.log(x) + b * math.log1p(-x) - log_beta(a, b))
    c, d = 1.0, 1.0 / max(abs(1.0 - (a + b) * x / (a + 1.0)), tiny)
    d = math.copysign(d, 1.0 - (a + b) * x / (a + 1.0))
    total = d
    # The fraction needs a number of terms in the order of the root of the larger parameter.
    terms = 1000 + int(10 * math.sqrt(max(a, b)))
    for m in range(1, terms):
        for top in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + top * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + top / c
            c = c if abs(c) > tiny else tiny
            step = c * d
            total *= step
        if abs(step - 1.0) < 1e-15:
            return scale * total / a
    raise ArithmeticError(f"no convergence at a={a}, b={b}, x={x}")


def f_test_p(f: float | None, between: float, within: float) -> float | None:
    """Upper tail of the F distribution."""
    if f is None or math.isnan(f):
        return None
    if math.isinf(f):
        return 0.0
    return incomplete_beta(within / 2.0, between / 2.0, within / (within + between * f))


def rank_test_p(rho: float | None, n: int) -> float | None:
    """Two-sided p of a rank correlation by the t approximation."""
    if rho is None or n < 3:
        return None
    if abs(rho) >= 1.0:
        return 0.0
    freedom = n - 2.0
    t2 = rho * rho * freedom / ((1.0 - rho) * (1.0 + rho))
    return incomplete_beta(freedom / 2.0, 0.5, freedom / (freedom + t2))


#: Coefficients of Stirling's series in 1/z, 1/z^3, ...
STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188)
#: Arguments of the logarithm of the gamma function are moved up by so much, where the series is exact.
SHIFT = 12


def log_gamma(z: Column) -> Column:
    """ln of the gamma function for positive ``z``."""
    moved = z + SHIFT
    series = sum((F.lit(c) / F.pow(moved, F.lit(float(2 * i + 1))) for i, c in enumerate(STIRLING)), F.lit(0.0))
    product = F.aggregate(F.sequence(F.lit(0), F.lit(SHIFT - 1)), F.lit(0.0), lambda s, i: s + F.log(z + i))
    return (moved - 0.5) * F.log(moved) - moved + F.lit(0.5 * math.log(2 * math.pi)) + series - product


def with_beta_tail(df: DataFrame, a: Column, b: Column, x: Column, name: str) -> DataFrame:
    """``df`` with the regularised incomplete beta function of each row, as column expressions.

    A continued fraction from the front, by a fold over its steps; their number grows with the root of the
    parameters, as its convergence asks. On the far side of the mean the mirrored fraction converges.
    """
    far = x > (a + 1) / (a + b + 2)
    held = df.withColumn("_far", far).withColumn(
        "_t",
        F.when(F.col("_far"), F.struct(b.alias("a"), a.alias("b"), (1 - x).alias("x"))).otherwise(
            F.struct(a.alias("a"), b.alias("b"), x.alias("x"))
        ),
    )
    p, q, y = F.col("_t.a"), F.col("_t.b"), F.col("_t.x")
    steps = (2 * (60 + 6 * F.ceil(F.sqrt(F.greatest(p, q))))).cast("int")

    def step(s: Column, i: Column) -> Column:
        m = F.floor((i + 1) / 2)
        odd = m * (q - m) * y / ((p + 2 * m - 1) * (p + 2 * m))
        even = -(p + m) * (p + q + m) * y / ((p + 2 * m) * (p + 2 * m + 1))
        term = F.when(i % 2 == 1, odd).otherwise(even)
        d, c = 1 / (1 + term * s["d"]), 1 + term / s["c"]
        return F.struct(c.alias("c"), d.alias("d"), (s["h"] * d * c).alias("h"))

    first = 1 / (1 - (p + q) * y / (p + 1))
    begin = F.struct(F.lit(1.0).alias("c"), first.alias("d"), first.alias("h"))
    fraction = F.aggregate(F.sequence(F.lit(1), steps), begin, step)["h"]
    scale = F.exp(log_gamma(p + q) - log_gamma(p) - log_gamma(q) + p * F.log(y) + q * F.log(1 - y)) / p
    inside = F.when(y <= 0, F.lit(0.0)).when(y >= 1, F.lit(1.0)).otherwise(scale * fraction)
    tail = F.when(x.isNull() | a.isNull() | b.isNull(), F.lit(None)).when(F.col("_far"), 1 - inside).otherwise(inside)
    return held.withColumn(name, tail.cast("double")).drop("_far", "_t")


def sums_of_squares(df: DataFrame, group: str, value: str) -> DataFrame:
    """One row: number of groups and values, squares between and within groups, and in total.

    Two aggregates, the second over one row per group; spreads come from the running moments of
    ``var_pop``, which keep their precision where a difference of squared sums would not.
    """
    per_group = (
        df.filter(F.col(value).isNotNull())
        .groupBy(group)
        .agg(
            F.count("*").alias("_n"),
            F.sum(value).alias("_sum"),
            (F.var_pop(value) * F.count("*")).alias("_within"),
        )
    )
    return per_group.agg(
        F.count("*").alias("nb_groupes"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n"),
        F.sum("_within").alias("ss_intra"),
        (
            F.sum(F.col("_sum") * F.col("_sum") / F.col("_n"))
            - F.sum("_sum") * F.sum("_sum") / F.sum("_n")
        ).alias("_between"),
    ).select(
        "nb_groupes",
        "n",
        F.greatest(F.col("_between"), F.lit(0.0)).alias("ss_inter"),
        "ss_intra",
        (F.greatest(F.col("_between"), F.lit(0.0)) + F.col("ss_intra")).alias("ss_total"),
    )


def eta_squared(between: Column, total: Column) -> Column:
    """Share of the spread that lies between groups; 0 when there is none."""
    return F.when(total == 0, F.lit(0.0)).otherwise(between / total)


def axis_values(fact: DataFrame, grain: str = "axis") -> DataFrame:
    """``type_ligne`` and one mean per axis, or every monthly row with ``grain='month'``."""
    rated = fact.filter(F.col("taux_ponctualite").isNotNull())
    if grain == "month":
        return rated.select("type_ligne", F.col("taux_ponctualite").alias("valeur"))
    if grain != "axis":
        raise ValueError(f"unknown grain {grain!r}")
    return (
        rated.groupBy("type_ligne", "axe_label")
        .agg(exact_mean(F.col("taux_ponctualite"), 2, None).alias("valeur"))
        .select("type_ligne", "valeur")
    )


def group_sizes(fact: DataFrame, grain: str = "axis") -> DataFrame:
    return axis_values(fact, grain).groupBy("type_ligne").agg(F.count("*").alias("n"))


def anova_statistic(fact: DataFrame, grain: str = "axis") -> DataFrame:
    """One row: group and value counts, F and eta squared of punctuality over line types."""
    s = sums_of_squares(axis_values(fact, grain), "type_ligne", "valeur")
    between = F.col("ss_inter") / (F.col("nb_groupes") - 1)
    within = F.col("ss_intra") / (F.col("n") - F.col("nb_groupes"))
    testable = (F.col("nb_groupes") > 1) & (F.col("n") > F.col("nb_groupes")) & (F.col("ss_total") > 0)
    f = F.when(testable, F.when(F.col("ss_intra") == 0, F.lit(math.inf)).otherwise(between / within))
    return s.select(
        "nb_groupes",
        "n",
        f.alias("f_stat"),
        eta_squared(F.col("ss_inter"), F.col("ss_total")).alias("eta2"),
    )


def anova(fact: DataFrame, grain: str = "axis") -> DataFrame:
    """``anova_statistic`` with its p-value and the significance flag."""
    between = (F.col("nb_groupes") - 1).cast("double")
    within = (F.col("n") - F.col("nb_groupes")).cast("double")
    f = F.col("f_stat")
    x = F.when(f == math.inf, F.lit(0.0)).otherwise(within / (within + between * f))
    found = with_beta_tail(anova_statistic(fact, grain), within / 2, between / 2, x, "p_value")
    return found.withColumn("significatif", F.col("p_value") < ALPHA)


def price_rank_correlation(points: DataFrame) -> DataFrame:
    """``n`` and rho of price per kilometre against punctuality; rho NULL below three points."""
    return spearman(points, "prix_moyen_km", "taux_ponctualite_moyen").select(
        "n", F.when(F.col("n") >= 3, F.col("rho")).alias("rho")
    )


def price_rank_test(points: DataFrame) -> DataFrame:
    """``price_rank_correlation`` with its two-sided p-value by the t approximation, and the flag."""
    rho, freedom = F.col("rho"), (F.col("n") - 2).cast("double")
    # freedom / (freedom + t^2), with t^2 = rho^2 freedom / (1 - rho^2)
    x = F.greatest((1 - rho) * (1 + rho), F.lit(0.0))
    known = F.when(F.col("n") >= 3, freedom / 2)
    found = with_beta_tail(price_rank_correlation(points), known, F.lit(0.5), F.when(rho.isNotNull(), x), "p_value")
    return found.withColumn("significatif", F.col("p_value") < ALPHA)


def group_descriptives(fact: DataFrame) -> DataFrame:
    """Count, mean and population deviation of the monthly rates per line type."""
    return (
        fact.filter(F.col("taux_ponctualite").isNotNull())
        .groupBy("type_ligne")
        .agg(
            F.count("*").alias("n"),
            exact_mean(F.col("taux_ponctualite"), 2, None).alias("moyenne"),
            F.stddev_pop("taux_ponctualite").alias("ecart_type"),
        )
    )
