"""The named questions asked of the punctuality and fare facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import exact_mean, mean_from, round_to, scaled_sum
from ..functions.text import label_search
from ..functions.times import year_of
from ..operators.keyed import ranked_ends
from ..operators.ordered import quantile_summary
from ..schemas import LINE_TYPES

MIN_MONTHS = 12
HISTOGRAM_BINS = 25

MONTHLY_COLUMNS = [
    "mois",
    "type_ligne",
    "axe_label",
    "nb_trains_prevus",
    "nb_trains_circules",
    "nb_trains_annules",
    "nb_trains_retard_arrivee",
    "retard_moyen_tous_trains_arrivee_min",
    "taux_ponctualite",
    "taux_annulation",
]


def _rated(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("taux_ponctualite").isNotNull())


def _mean_punctuality(digits: int | None, name: str):
    return exact_mean(F.col("taux_ponctualite"), 2, digits).alias(name)


def type_means(fact: DataFrame, with_count: bool = True) -> DataFrame:
    """Mean punctuality, cancellation and delay per line type, best first."""
    count = [F.count("*").alias("nb_mois_liaisons")] if with_count else []
    return (
        fact.groupBy("type_ligne")
        .agg(
            *count,
            _mean_punctuality(2, "taux_ponctualite_moyen"),
            exact_mean(F.col("taux_annulation")).alias("taux_annulation_moyen"),
            round_to(F.avg("retard_moyen_tous_trains_arrivee_min"), 2).alias("retard_moyen_min"),
        )
        .orderBy(F.col("taux_ponctualite_moyen").desc_nulls_last())
    )


def axis_means(fact: DataFrame, min_months: int = MIN_MONTHS) -> DataFrame:
    """Punctuality per axis with enough months, and its first and last month."""
    return (
        _rated(fact)
        .groupBy("type_ligne", "axe_label")
        .agg(
            F.count("*").alias("nb_mois"),
            _mean_punctuality(2, "taux_ponctualite_moyen"),
            exact_mean(F.col("taux_annulation")).alias("taux_annulation_moyen"),
            F.min("mois").alias("premier_mois"),
            F.max("mois").alias("dernier_mois"),
        )
        .filter(F.col("nb_mois") >= min_months)
        .orderBy("type_ligne", F.col("taux_ponctualite_moyen").desc_nulls_last())
    )


def best_and_worst(
    fact: DataFrame,
    n: int = 5,
    min_months: int = MIN_MONTHS,
    labels: tuple[str, str] = ("top5", "bottom5"),
) -> DataFrame:
    """The ``n`` most and least punctual axes; equal means rank by type and label."""
    axes = axis_means(fact, min_months).select(
        "type_ligne", "axe_label", "taux_ponctualite_moyen", "nb_mois", "premier_mois", "dernier_mois"
    )
    return ranked_ends(axes, "taux_ponctualite_moyen", n, labels, ["type_ligne", "axe_label"])


def top_lines(
    fact: DataFrame, n: int = 5, line_type: str | None = None, min_months: int = MIN_MONTHS
) -> DataFrame:
    """Best and worst lines without the regional axes, optionally of one type; ``n`` is 3 to 15."""
    if not 3 <= n <= 15:
        raise ValueError("n is 3 to 15")
    lines = _rated(fact).filter(F.col("type_ligne") != "regional")
    if line_type:
        lines = lines.filter(F.col("type_ligne") == line_type)
    means = (
        lines.groupBy("type_ligne", "axe_label")
        .agg(_mean_punctuality(1, "ponctualite"), F.count("*").alias("nb_mois"))
        .filter(F.col("nb_mois") >= min_months)
    )
    return ranked_ends(means, "ponctualite", n, ("Top", "Bottom"), ["type_ligne", "axe_label"]).orderBy(
        "ponctualite", "type_ligne", "axe_label", "classement"
    )


def monthly_trend(fact: DataFrame) -> DataFrame:
    return (
        _rated(fact)
        .groupBy("type_ligne", "mois")
        .agg(_mean_punctuality(2, "taux_ponctualite_moyen"), F.count("*").alias("nb_axes"))
        .orderBy("type_ligne", "mois")
    )


def yearly_trend(fact: DataFrame) -> DataFrame:
    """Mean per year (as text) and line type."""
    return (
        _rated(fact)
        .groupBy(F.substring("mois", 1, 4).alias("annee"), "type_ligne")
        .agg(_mean_punctuality(1, "ponctualite_moyenne"))
        .orderBy("annee", "type_ligne")
    )


def _standard_fares(fares: DataFrame) -> DataFrame:
    """Second class at the normal tariff, on lines with a distance."""
    return fares.filter(
        F.col("prix_moyen_km").isNotNull()
        & (F.col("classe") == "2")
        & (F.col("profil_tarifaire") == "Tarif Normal")
    )


def price_per_km(fares: DataFrame) -> DataFrame:
    """Median, lowest and highest price per kilometre by line type."""
    chosen = _standard_fares(fares).select("type_ligne", "prix_moyen_km")
    return (
        quantile_summary(chosen, ["type_ligne"], "prix_moyen_km", 0.5)
        .select(
            "type_ligne",
            F.col("total").alias("nb_tarifs"),
            round_to(F.col("quantile"), 3).alias("prix_km_median"),
            round_to(F.col("lowest"), 3).alias("prix_km_min"),
            round_to(F.col("highest"), 3).alias("prix_km_max"),
        )
        .orderBy("type_ligne")
    )


def fare_detail(fares: DataFrame) -> DataFrame:
    return (
        _standard_fares(fares)
        .select(
            "type_ligne",
            "gare_origine",
            "gare_destination",
            "distance_km",
            "prix_minimum",
            "prix_maximum",
            "prix_moyen",
            "prix_moyen_km",
        )
        .orderBy(F.col("distance_km").asc_nulls_last())
    )


def price_and_punctuality_by_line(fares: DataFrame, fact: DataFrame) -> DataFrame:
    """Each fare line with the mean over the months of its axis.

    Months and fares are both summed up per axis before they meet: joining the rows themselves
    would multiply the months of a busy axis by all of its fares.
    """
    months = (
        _rated(fact)
        .groupBy("type_ligne", "axe_label")
        .agg(scaled_sum(F.col("taux_ponctualite"), 2).alias("_sum"), F.count("*").alias("_n"))
    )
    line = ["type_ligne", "gare_origine", "gare_destination", "distance_km", "prix_moyen_km"]
    per_axis = (
        _standard_fares(fares)
        .groupBy(*line, F.col("axe_label_regularite").alias("axe_label"))
        .agg(F.count("*").alias("_fares"))
    )
    total = F.sum(F.col("_fares") * F.col("_sum"))
    count = F.sum(F.col("_fares") * F.col("_n"))
    return (
        per_axis.join(months, ["type_ligne", "axe_label"])
        .groupBy(*line)
        .agg(mean_from(total, count, 2, 2).alias("ponctualite_moyenne"))
        .select(
            "type_ligne",
            F.concat("gare_origine", F.lit(" → "), "gare_destination").alias("liaison"),
            "distance_km",
            "prix_moyen_km",
            "ponctualite_moyenne",
        )
        .orderBy("type_ligne", "liaison")
    )


def consolidated(
    fact: DataFrame, lines: DataFrame, fares: DataFrame, min_months: int = MIN_MONTHS
) -> DataFrame:
    """One row per axis: punctuality, cancellation, distance and price per kilometre where known."""
    axes = axis_means(fact, min_months).drop("premier_mois", "dernier_mois")
    price = (
        _standard_fares(fares)
        .groupBy("type_ligne", F.col("axe_label_regularite").alias("axe_label"))
        .agg(exact_mean(F.col("prix_moyen_km"), 3, 3).alias("prix_moyen_km"))
    )
    return (
        axes.join(lines.select("type_ligne", "axe_label", "distance_km"), ["type_ligne", "axe_label"], "left")
        .join(price, ["type_ligne", "axe_label"], "left")
        .select(
            "type_ligne",
            "axe_label",
            "nb_mois",
            "taux_ponctualite_moyen",
            "taux_annulation_moyen",
            "distance_km",
            "prix_moyen_km",
        )
        .orderBy("type_ligne", F.col("taux_ponctualite_moyen").desc_nulls_last())
    )


def list_monthly(
    fact: DataFrame,
    line_type: str | None = None,
    month: str | None = None,
    axis: str | None = None,
    limit: int = 100,
) -> DataFrame:
    """Monthly rows under any combination of filters, newest first; at most 1000."""
    if limit > 1000:
        raise ValueError("limit is at most 1000")
    rows = fact
    if line_type:
        rows = rows.filter(F.col("type_ligne") == line_type)
    if month:
        rows = rows.filter(F.col("mois") == month)
    if axis:
        rows = rows.filter(label_search(F.col("axe_label"), axis))
    return (
        rows.select(*MONTHLY_COLUMNS)
        .orderBy(F.col("mois").desc_nulls_last(), "type_ligne", F.col("axe_label").asc_nulls_last())
        .limit(limit)
    )


def year_matrix(fact: DataFrame, years: list[int]) -> DataFrame:
    """Line type by year matrix of means; the years are given, so no extra job looks for them."""
    return (
        _rated(fact)
        .withColumn("annee", year_of(F.col("mois")))
        .groupBy("type_ligne")
        .pivot("annee", years)
        .agg(exact_mean(F.col("taux_ponctualite"), 2, 1))
    )


def year_cells(fact: DataFrame) -> DataFrame:
    """The same matrix as rows."""
    return (
        _rated(fact)
        .groupBy("type_ligne", year_of(F.col("mois")).alias("annee"))
        .agg(_mean_punctuality(1, "moyenne"))
        .orderBy("annee", "type_ligne")
    )


def punctuality_histogram(fact: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Rows per line type and equal-width bin over 0 to 100; the last bin includes 100."""
    rate = F.col("taux_ponctualite")
    width = 100.0 / bins
    slot = F.least(F.floor(rate / F.lit(width)), F.lit(bins - 1)).cast("int")
    return (
        fact.filter(rate.between(0, 100))
        .groupBy("type_ligne", slot.alias("classe"))
        .agg(F.count("*").alias("nb"))
        .withColumn("borne_basse", F.col("classe") * F.lit(width))
        .orderBy("type_ligne", "classe")
    )


def price_punctuality_points(fares: DataFrame, fact: DataFrame) -> DataFrame:
    """Price per kilometre of each fare against the mean punctuality of its axis."""
    means = _rated(fact).groupBy("type_ligne", "axe_label").agg(
        _mean_punctuality(None, "taux_ponctualite_moyen")
    )
    return (
        _standard_fares(fares)
        .withColumn("axe_label", F.col("axe_label_regularite"))
        .join(means, ["type_ligne", "axe_label"])
        .select("type_ligne", "prix_moyen_km", "taux_ponctualite_moyen")
    )


def type_means_between(fact: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Mean per line type over the chosen years, both included."""
    return (
        _rated(fact)
        .filter(year_of(F.col("mois")).between(first_year, last_year))
        .groupBy("type_ligne")
        .agg(_mean_punctuality(1, "ponctualite_moyenne"))
    )


def extent(fact: DataFrame, fares: DataFrame) -> DataFrame:
    """Row counts, first and last month and year of the rated facts, and the usable fares."""
    months = _rated(fact).agg(
        F.count("*").alias("nb_lignes"),
        F.min("mois").alias("mois_min"),
        F.max("mois").alias("mois_max"),
    )
    prices = _standard_fares(fares).agg(F.count("*").alias("nb_tarifs"))
    nothing = F.lit(None)
    return (
        months.withColumn("nb_tarifs", nothing.cast("bigint"))
        .unionByName(
            prices.select(
                nothing.cast("bigint").alias("nb_lignes"),
                nothing.cast("string").alias("mois_min"),
                nothing.cast("string").alias("mois_max"),
                "nb_tarifs",
            )
        )
        .agg(*[F.max(c).alias(c) for c in ("nb_lignes", "mois_min", "mois_max", "nb_tarifs")])
        .withColumns(
            {"annee_min": year_of(F.col("mois_min")), "annee_max": year_of(F.col("mois_max"))}
        )
    )


def bar_by_type(fact: DataFrame) -> DataFrame:
    """Mean punctuality per line type with one decimal, in display order."""
    order = F.array_position(F.array(*[F.lit(t) for t in LINE_TYPES]), F.col("type_ligne"))
    return (
        _rated(fact).groupBy("type_ligne").agg(_mean_punctuality(1, "moyenne")).orderBy(order)
    )
