"""The monthly punctuality fact out of three differently shaped sources."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import percent, safe_double, safe_int
from ..functions.text import axis_label

Cast = Callable[[Column], Column]


def _branch(
    df: DataFrame,
    line_type: str,
    source_file: str,
    departure: str | None,
    arrival: str | None,
    region: str | None,
    planned: str,
    ran: str | None,
    delay: str | None,
    to_int: Cast,
    to_double: Cast,
) -> DataFrame:
    origin = F.col(departure) if departure else F.lit(None).cast("string")
    target = F.col(arrival) if arrival else F.lit(None).cast("string")
    area = F.col(region) if region else F.lit(None).cast("string")
    planned_n = to_int(F.col(planned))
    cancelled_n = to_int(F.col("Nombre de trains annulés"))
    return df.select(
        F.col("Date").alias("mois"),
        F.lit(line_type).alias("type_ligne"),
        F.lit("region" if region else "liaison").alias("axe_type"),
        origin.alias("gare_depart"),
        target.alias("gare_arrivee"),
        area.alias("region"),
        (area if region else axis_label(origin, target)).alias("axe_label"),
        planned_n.alias("nb_trains_prevus"),
        (to_int(F.col(ran)) if ran else planned_n - cancelled_n).alias("nb_trains_circules"),
        cancelled_n.alias("nb_trains_annules"),
        to_int(F.col("Nombre de trains en retard à l'arrivée")).alias("nb_trains_retard_arrivee"),
        (to_double(F.col(delay)) if delay else F.lit(None).cast("double")).alias(
            "retard_moyen_tous_trains_arrivee_min"
        ),
        F.lit(source_file).alias("source_file"),
    )


def harmonize(tgv: DataFrame, ter: DataFrame, intercites: DataFrame, strict: bool = False) -> DataFrame:
    """Union the three sources into ``fact_regularite`` and add both rates.

    A value that is no number becomes NULL; with ``strict`` (typed input) it is an error instead.
    """
    to_int: Cast = (lambda c: c.cast("int")) if strict else safe_int
    to_double: Cast = (lambda c: c.cast("double")) if strict else safe_double
    branch = partial(_branch, to_int=to_int, to_double=to_double)
    fact = (
        branch(
            tgv,
            "grande_vitesse",
            "regularite_tgv.csv",
            departure="Gare de départ",
            arrival="Gare d'arrivée",
            region=None,
            planned="Nombre de circulations prévues",
            ran=None,
            delay="Retard moyen de tous les trains à l'arrivée",
        )
        .unionByName(
            branch(
                ter,
                "regional",
                "regularite_ter.csv",
                departure=None,
                arrival=None,
                region="Région",
                planned="Nombre de trains programmés",
                ran="Nombre de trains ayant circulé",
                delay=None,
            )
        )
        .unionByName(
            branch(
                intercites,
                "intercite",
                "regularite_intercites.csv",
                departure="Départ",
                arrival="Arrivée",
                region=None,
                planned="Nombre de trains programmés",
                ran="Nombre de trains ayant circulé",
                delay=None,
            )
        )
    )
    ran, late = F.col("nb_trains_circules"), F.col("nb_trains_retard_arrivee")
    return fact.withColumns(
        {
            "taux_ponctualite": percent(ran - late, ran),
            "taux_annulation": percent(F.col("nb_trains_annules"), F.col("nb_trains_prevus")),
        }
    )


def active_axes(fact: DataFrame) -> DataFrame:
    """Axes that still report in the last month of their own line type."""
    last = fact.groupBy("type_ligne").agg(F.max("mois").alias("mois"))
    return fact.join(last, ["type_ligne", "mois"]).select("type_ligne", "axe_label").distinct()


def first_axes(axes: DataFrame, n: int) -> DataFrame:
    """The first ``n`` axes of each type by label, with their rank ``rn``."""
    by_label = Window.partitionBy("type_ligne").orderBy(F.col("axe_label").asc_nulls_last())
    return axes.withColumn("rn", F.row_number().over(by_label)).filter(F.col("rn") <= n)


def recent_months(fact: DataFrame, k: int) -> DataFrame:
    """The ``k`` latest months over all line types."""
    return fact.select("mois").distinct().orderBy(F.col("mois").desc_nulls_last()).limit(k)


def dev_sample(fact: DataFrame, axes_per_type: int = 1, months: int = 3) -> DataFrame:
    """Rows of a few active axes per type in the latest months."""
    kept = first_axes(active_axes(fact), axes_per_type)
    return fact.join(kept, ["type_ligne", "axe_label"], "left_semi").join(
        recent_months(fact, months), "mois", "left_semi"
    ).select(*fact.columns)
