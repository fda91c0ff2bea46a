"""Queries on the monthly facts, stations, lines and fares."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo
from ..functions.text import normalize_name
from ..plans import analytics, build, harmonize, lines, stations, stats
from .registry import add
from .sql import mean, norm, norm_warehouse

YEARS = list(range(1995, 2002))

FACT = """mois, type_ligne, axe_type, gare_depart, gare_arrivee, region, axe_label, nb_trains_prevus, nb_trains_circules,
    nb_trains_annules, nb_trains_retard_arrivee, retard_moyen_tous_trains_arrivee_min, source_file, taux_ponctualite,
    taux_annulation"""

add("dp1_harmonize", lambda v: v.fact, f"SELECT {FACT} FROM fact")
add(
    "prj4_harmonize_strict",
    lambda v: harmonize.harmonize(v.tgv, v.ter, v.intercites, strict=True),
    f"SELECT {FACT} FROM fact",
)

_TYPE_MEANS = f"""{mean('taux_ponctualite')} AS taux_ponctualite_moyen, {mean('taux_annulation')} AS taux_annulation_moyen,
    ROUND(AVG(retard_moyen_tous_trains_arrivee_min), 2) AS retard_moyen_min FROM fact GROUP BY type_ligne"""
add(
    "q1_type_means",
    lambda v: analytics.type_means(v.fact),
    f"SELECT type_ligne, COUNT(*) AS nb_mois_liaisons, {_TYPE_MEANS}",
)
add(
    "q1_type_means_without_count",
    lambda v: analytics.type_means(v.fact, with_count=False),
    f"SELECT type_ligne, {_TYPE_MEANS}",
)
add("q2_axis_means", lambda v: analytics.axis_means(v.fact), "SELECT * FROM axes")


def _ends(n: int, top: str, bottom: str) -> str:
    return f"""SELECT type_ligne, axe_label, taux_ponctualite_moyen, nb_mois, premier_mois, dernier_mois, classement
        FROM (SELECT *, row_number() OVER (ORDER BY -taux_ponctualite_moyen, type_ligne, axe_label) AS from_best,
                row_number() OVER (ORDER BY taux_ponctualite_moyen, type_ligne, axe_label) AS from_worst FROM axes)
        JOIN (VALUES ('{top}', true), ('{bottom}', false)) AS ends(classement, best)
          ON CASE WHEN best THEN from_best ELSE from_worst END <= {n}"""


add("q3_best_and_worst_five", lambda v: analytics.best_and_worst(v.fact), _ends(5, "top5", "bottom5"))
add(
    "q8_best_and_worst_ten",
    lambda v: analytics.best_and_worst(v.fact, 10, labels=("top10", "bottom10")),
    _ends(10, "top10", "bottom10"),
)
add(
    "q4_monthly_trend",
    lambda v: analytics.monthly_trend(v.fact),
    f"""SELECT type_ligne, mois, {mean('taux_ponctualite')} AS taux_ponctualite_moyen, COUNT(*) AS nb_axes
        FROM fact WHERE taux_ponctualite IS NOT NULL GROUP BY type_ligne, mois""",
)
add(
    "q5_price_per_km",
    lambda v: analytics.price_per_km(v.fares_table),
    """SELECT type_ligne, COUNT(*) AS nb_tarifs, ROUND(MEDIAN(prix_moyen_km),3) AS prix_km_median,
        ROUND(MIN(prix_moyen_km),3) AS prix_km_min, ROUND(MAX(prix_moyen_km),3) AS prix_km_max
        FROM standard GROUP BY type_ligne""",
)
add(
    "q6_fare_detail",
    lambda v: analytics.fare_detail(v.fares),
    """SELECT type_ligne, gare_origine, gare_destination, distance_km, prix_minimum, prix_maximum, prix_moyen, prix_moyen_km
        FROM standard""",
)
add(
    "q7_yearly_trend",
    lambda v: analytics.yearly_trend(v.fact),
    f"""SELECT substr(mois,1,4) AS annee, type_ligne, {mean('taux_ponctualite', 2, 1)} AS ponctualite_moyenne
        FROM fact WHERE taux_ponctualite IS NOT NULL GROUP BY 1, 2""",
)
add(
    "q9_price_and_punctuality",
    lambda v: analytics.price_and_punctuality_by_line(v.fares_table, v.fact_table),
    """SELECT type_ligne, concat(gare_origine, ' → ', gare_destination) AS liaison, distance_km, prix_moyen_km,
        ROUND(CAST(SUM(centiemes) AS DOUBLE) / SUM(mois_mesures)) / 100 AS ponctualite_moyenne
        FROM standard JOIN (SELECT type_ligne AS axis_type, axe_label, centiemes, mois_mesures FROM axis_sums)
          ON (axis_type, axe_label) = (type_ligne, axe_label_regularite) GROUP BY ALL""",
)
CONSOLIDATED = f"""SELECT type_ligne, axe_label, nb_mois, taux_ponctualite_moyen, taux_annulation_moyen,
        (SELECT MAX(distance_km) FROM lines WHERE (lines.type_ligne, lines.axe_label) = (axes.type_ligne, axes.axe_label))
          AS distance_km,
        (SELECT {mean('prix_moyen_km', 3, 3)} FROM standard
         WHERE (standard.type_ligne, axe_label_regularite) = (axes.type_ligne, axes.axe_label)) AS prix_moyen_km
        FROM axes"""
add("q10_consolidated", lambda v: analytics.consolidated(v.fact_table, v.lines_table, v.fares_table), CONSOLIDATED)
STATION = "id_gare, station_id, nom_gare, trigramme, code_uic, latitude, longitude, pays"
add(
    "q11_station_list",
    lambda v: stations.list_stations(v.dim_stations),
    f"SELECT {STATION} FROM dim ORDER BY nom_gare NULLS LAST, id_gare LIMIT 50",
)
add(
    "q11_station_search",
    lambda v: stations.list_stations(v.dim_stations, "saint", 500),
    f"SELECT {STATION} FROM dim WHERE nom_gare_norm LIKE '%SAINT%' ORDER BY nom_gare NULLS LAST, id_gare LIMIT 500",
)
add(
    "q11_station_detail",
    lambda v: stations.get_station(v.dim_stations, "DE:1"),
    f"SELECT {STATION} FROM dim WHERE id_gare = 'DE:1'",
)
MONTHLY = ", ".join(analytics.MONTHLY_COLUMNS)
_NEWEST = "ORDER BY mois DESC, type_ligne, axe_label NULLS LAST"
add("q12_monthly_list", lambda v: analytics.list_monthly(v.fact), f"SELECT {MONTHLY} FROM fact {_NEWEST} LIMIT 100")
add(
    "q12_monthly_filtered",
    lambda v: analytics.list_monthly(v.fact, "grande_vitesse", "2000-05", "lâr", 1000),
    f"""SELECT {MONTHLY} FROM fact WHERE type_ligne = 'grande_vitesse' AND mois = '2000-05'
        AND axe_label ILIKE '%lâr%' {_NEWEST} LIMIT 1000""",
)
_CELLS = f"""SELECT type_ligne, CAST(substr(mois,1,4) AS INTEGER) AS annee, {mean('taux_ponctualite', 2, 1)} AS moyenne
    FROM fact WHERE taux_ponctualite IS NOT NULL GROUP BY 1, 2"""
add(
    "q13_year_matrix",
    lambda v: analytics.year_matrix(v.fact, YEARS),
    "SELECT type_ligne, "
    + ", ".join(f'MAX(moyenne) FILTER (WHERE annee = {y}) AS "{y}"' for y in YEARS)
    + f" FROM ({_CELLS}) GROUP BY type_ligne",
)
add("q13_year_cells", lambda v: analytics.year_cells(v.fact), _CELLS)
add(
    "q14_punctuality_histogram",
    lambda v: analytics.punctuality_histogram(v.fact),
    """SELECT type_ligne, CAST(LEAST(floor(taux_ponctualite / 4), 24) AS INTEGER) AS classe, COUNT(*) AS nb,
        LEAST(floor(taux_ponctualite / 4), 24) * 4e0 AS borne_basse
        FROM fact WHERE taux_ponctualite BETWEEN 0 AND 100 GROUP BY ALL""",
)
add(
    "q15_price_punctuality_points",
    lambda v: analytics.price_punctuality_points(v.fares_table, v.fact_table),
    "SELECT type_ligne, prix_moyen_km, taux_ponctualite_moyen FROM points",
)
add(
    "q16_type_means_between",
    lambda v: analytics.type_means_between(v.fact, 1997, 1999),
    f"""SELECT type_ligne, {mean('taux_ponctualite', 2, 1)} AS ponctualite_moyenne FROM fact
        WHERE taux_ponctualite IS NOT NULL AND CAST(substr(mois,1,4) AS INTEGER) BETWEEN 1997 AND 1999 GROUP BY 1""",
)
_LINES = f"""SELECT type_ligne, axe_label, {mean('taux_ponctualite', 2, 1)} AS ponctualite, COUNT(*) AS nb_mois FROM fact
    WHERE taux_ponctualite IS NOT NULL AND type_ligne <> 'regional' GROUP BY 1, 2 HAVING COUNT(*) >= 12"""
add(
    "q17_top_lines",
    lambda v: analytics.top_lines(v.fact, 7),
    f"""SELECT r.* EXCLUDE (haut, bas), classement FROM (
          SELECT *, row_number() OVER (ORDER BY ponctualite DESC, type_ligne, axe_label) AS haut,
            row_number() OVER (ORDER BY ponctualite, type_ligne, axe_label) AS bas FROM ({_LINES})) r
        JOIN (VALUES ('Top'), ('Bottom')) c(classement) ON CASE classement WHEN 'Top' THEN haut ELSE bas END <= 7""",
)
add(
    "q18_extent",
    lambda v: analytics.extent(v.fact_table, v.fares_table),
    """SELECT (SELECT COUNT(*) FROM fact WHERE taux_ponctualite IS NOT NULL) AS nb_lignes,
        (SELECT MIN(mois) FROM fact WHERE taux_ponctualite IS NOT NULL) AS mois_min,
        (SELECT MAX(mois) FROM fact WHERE taux_ponctualite IS NOT NULL) AS mois_max,
        (SELECT COUNT(*) FROM standard) AS nb_tarifs,
        (SELECT CAST(substr(MIN(mois),1,4) AS INTEGER) FROM fact WHERE taux_ponctualite IS NOT NULL) AS annee_min,
        (SELECT CAST(substr(MAX(mois),1,4) AS INTEGER) FROM fact WHERE taux_ponctualite IS NOT NULL) AS annee_max""",
)
add(
    "ag1_bar_by_type",
    lambda v: analytics.bar_by_type(v.fact),
    f"""SELECT type_ligne, {mean('taux_ponctualite', 2, 1)} AS moyenne FROM fact WHERE taux_ponctualite IS NOT NULL GROUP BY 1""",
)

# Sample
_ACTIVE = """SELECT DISTINCT type_ligne, axe_label FROM (
    SELECT *, MAX(mois) OVER (PARTITION BY type_ligne) AS dernier FROM fact) WHERE mois = dernier"""
_RANKED = f"SELECT *, row_number() OVER (PARTITION BY type_ligne ORDER BY axe_label) AS rn FROM ({_ACTIVE})"
add("jn10_active_axes", lambda v: harmonize.active_axes(v.fact), _ACTIVE)
add(
    "wn1_first_axes",
    lambda v: harmonize.first_axes(harmonize.active_axes(v.fact), 4),
    f"SELECT type_ligne, axe_label, CAST(rn AS INTEGER) AS rn FROM ({_RANKED}) WHERE rn <= 4",
)
add(
    "sl3_recent_months",
    lambda v: harmonize.recent_months(v.fact, 3),
    "SELECT DISTINCT mois FROM fact ORDER BY mois DESC LIMIT 3",
)
add(
    "dp18_dev_sample",
    lambda v: harmonize.dev_sample(v.fact_table, 2, 3),
    f"""SELECT {FACT} FROM fact WHERE (type_ligne, axe_label) IN (SELECT (type_ligne, axe_label) FROM ({_RANKED}) WHERE rn <= 2)
        AND mois IN (SELECT DISTINCT mois FROM fact ORDER BY mois DESC LIMIT 3)""",
)

# Stations
add(
    "fn1_normalize_names",
    lambda v: v.table("documents").select("doc_id", normalize_name(F.col("text")).alias("nom")),
    f"SELECT doc_id, {norm('text')} AS nom FROM documents",
)
add(
    "fn1_normalize_names_warehouse",
    lambda v: v.table("documents").select(
        "doc_id", normalize_name(F.replace("text", F.lit("ß"), F.lit("ss")), "warehouse").alias("nom")
    ),
    f"SELECT doc_id, {norm_warehouse("replace(text,'ß','ss')")} AS nom FROM documents",
)
SLICE = "station_id, nom_gare, nom_gare_norm, trigramme, code_uic, code_commune, latitude, longitude, pays"
add("dp2_stations_fr", lambda v: stations.stations_fr(v.gares), f"SELECT {SLICE} FROM dim_fr")
add("dp3_stations_ch", lambda v: stations.stations_ch(v.ch_stops), f"SELECT {SLICE} FROM dim_ch")
for _c in ("NL", "IT", "PL", "DE", "SE"):
    add(
        f"dp4_stations_{_c.lower()}",
        lambda v, c=_c: stations.stations_gtfs(v.gtfs_stops(c), c),
        f"SELECT {SLICE} FROM dim_{_c.lower()}",
    )
add("dp5_stations_fi", lambda v: stations.stations_fi(v.fi_stations), f"SELECT {SLICE} FROM dim_fi")
add("dp6_stations_all", lambda v: v.dim_stations, f"SELECT id_gare, {SLICE} FROM dim")
add(
    "ag9_stations_by_name",
    lambda v: stations.stations_by_name(v.dim_stations).select(
        "nom_norm", F.round("latitude", 6).alias("latitude"), F.round("longitude", 6).alias("longitude")
    ),
    "SELECT nom_norm, ROUND(latitude,6) AS latitude, ROUND(longitude,6) AS longitude FROM by_name",
)
add("rt5_station_lookup", lambda v: v.lookup, "SELECT cle, nom_gare, latitude, longitude FROM lookup")
add(
    "dp19_station_counts",
    lambda v: build.station_counts(v.dim_stations),
    "SELECT COUNT(*) AS gares, "
    + ", ".join(f"COUNT(*) FILTER (WHERE pays = '{c}') AS {c.lower()}" for c in ("FR", "CH", "NL", "IT", "FI", "PL", "DE", "SE"))
    + " FROM dim",
)

# Lines and fares
FR_PLACES = f"""SELECT {norm('nom_gare')} AS nom, [cos(radians(AVG(longitude))) * cos(radians(AVG(latitude))),
    sin(radians(AVG(longitude))) * cos(radians(AVG(latitude))), sin(radians(AVG(latitude)))] AS direction
    FROM dim_fr WHERE latitude + longitude IS NOT NULL GROUP BY ALL"""
_POS = ("latitude_depart", "longitude_depart", "latitude_arrivee", "longitude_arrivee")
add(
    "dp16_liaisons",
    lambda v: v.lines.select(
        "type_ligne", "axe_label", "gare_depart", "gare_arrivee", *[F.round(c, 6).alias(c) for c in _POS], "distance_km"
    ),
    "SELECT type_ligne, axe_label, gare_depart, gare_arrivee, "
    + ", ".join(f"ROUND({c},6) AS {c}" for c in _POS)
    + ", distance_km FROM lines",
)
add(
    "dp16_liaisons_fr",
    lambda v: lines.liaisons(v.fact, v.dim_stations, ["FR"]).select("type_ligne", "axe_label", "distance_km"),
    f"""SELECT type_ligne, axe_label, round(6371 * acos(CASE WHEN cosine > 1 THEN 1 ELSE cosine END), 1) AS distance_km
        FROM (SELECT type_ligne, axe_label, list_dot_product(a.direction, b.direction) AS cosine
          FROM line_ends LEFT JOIN ({FR_PLACES}) a ON a.nom = depart LEFT JOIN ({FR_PLACES}) b ON b.nom = arrivee)""",
)
add("dp17_fares", lambda v: v.fares, "SELECT * FROM fares")
add(
    "prj9_carrier_types",
    lambda v: v.tgv_fares.groupBy("Transporteur", lines.carrier_line_type(F.col("Transporteur")).alias("type_ligne"))
    .agg(F.count("*").alias("n")),
    """SELECT transporteur AS "Transporteur", type_ligne, COUNT(*) AS n FROM fares_base
        WHERE source_file = 'tarifs_tgv_ouigo.csv' GROUP BY 1, 2""",
)
add(
    "fn15_line_bearings",
    lambda v: v.lines.filter(F.col("distance_km").isNotNull()).select(
        "axe_label", F.round(geo.bearing_deg(*[F.col(c) for c in _POS]), 4).alias("cap")
    ),
    """SELECT axe_label, ROUND(fmod(degrees(atan2(
        sin(radians(longitude_arrivee - longitude_depart)) * cos(radians(latitude_arrivee)),
        cos(radians(latitude_depart)) * sin(radians(latitude_arrivee)) - sin(radians(latitude_depart)) *
        cos(radians(latitude_arrivee)) * cos(radians(longitude_arrivee - longitude_depart)))) + 360e0, 360e0), 4) AS cap
        FROM lines WHERE distance_km IS NOT NULL""",
)
add(
    "dp19_build_summary",
    lambda v: build.build_summary(v.fact_table, v.dim_stations, v.lines_table, v.fares_table),
    """SELECT 'fact_regularite' AS table_name, COUNT(*) AS total, COUNT(taux_ponctualite) AS renseignes FROM fact UNION ALL
        SELECT 'dim_stations_multipays', COUNT(*), COUNT(latitude) FROM dim UNION ALL
        SELECT 'dim_liaisons', COUNT(*), COUNT(distance_km) FROM lines UNION ALL
        SELECT 'fact_fares', COUNT(*), COUNT(prix_moyen_km) FROM fares""",
)

# Statistics
_SS = """SELECT COUNT(*) AS nb_groupes, CAST(SUM(n) AS BIGINT) AS n, SUM(n * (m - g) * (m - g)) AS inter, SUM(w) AS intra FROM (
    SELECT COUNT(*) AS n, AVG(valeur) AS m, VAR_POP(valeur) * COUNT(*) AS w,
      (SELECT AVG(valeur) FROM {src}) AS g FROM {src} GROUP BY type_ligne)"""
_F = """SELECT nb_groupes, n, ROUND((inter / (nb_groupes - 1)) / (intra / (n - nb_groupes)), 4) AS f_stat,
    ROUND(inter / (inter + intra), 6) AS eta2 FROM (%s)"""
_MONTHS = "(SELECT type_ligne, taux_ponctualite AS valeur FROM fact WHERE taux_ponctualite IS NOT NULL)"


def _rounded_f(df):
    return df.select(
        "nb_groupes", "n", F.round("f_stat", 4).alias("f_stat"), F.round("eta2", 6).alias("eta2")
    )


add(
    "sx1_anova_statistic",
    lambda v: _rounded_f(stats.anova_statistic(v.fact)),
    _F % _SS.format(src="axis_values"),
)
add(
    "sx5_anova_statistic_by_month",
    lambda v: _rounded_f(stats.anova_statistic(v.fact, "month")),
    _F % _SS.format(src=_MONTHS),
)
# Between three groups the upper tail of F has a closed form.
add(
    "sx1_anova_test",
    lambda v: stats.anova(v.fact).select(
        "nb_groupes", "n", F.round("f_stat", 4).alias("f_stat"), F.round("p_value", 9).alias("p_value"), "significatif"
    ),
    f"""SELECT nb_groupes, n, ROUND(f, 4) AS f_stat, ROUND(p, 9) AS p_value, p < 0.05 AS significatif FROM (
        SELECT *, power((n - 3) / (n - 3 + 2 * f), (n - 3) / 2e0) AS p FROM (
          SELECT *, (inter / (nb_groupes - 1)) / (intra / (n - nb_groupes)) AS f FROM ({_SS.format(src='axis_values')})))""",
)
add(
    "sx2_sums_of_squares",
    lambda v: stats.sums_of_squares(stats.axis_values(v.fact), "type_ligne", "valeur").select(
        "nb_groupes",
        "n",
        F.round("ss_inter", 4).alias("ss_inter"),
        F.round("ss_intra", 4).alias("ss_intra"),
        F.round("ss_total", 4).alias("ss_total"),
    ),
    f"""SELECT nb_groupes, n, ROUND(inter,4) AS ss_inter, ROUND(intra,4) AS ss_intra, ROUND(inter + intra,4) AS ss_total
        FROM ({_SS.format(src='axis_values')})""",
)
add(
    "sx1_group_sizes",
    lambda v: stats.group_sizes(v.fact),
    "SELECT type_ligne, COUNT(*) AS n FROM axis_values GROUP BY 1",
)
_POINTS = "(SELECT prix_moyen_km AS x, taux_ponctualite_moyen AS y FROM points)"
add(
    "sx3_price_rank_correlation",
    lambda v: stats.price_rank_correlation(analytics.price_punctuality_points(v.fares_table, v.fact_table)).select(
        "n", F.round("rho", 6).alias("rho")
    ),
    f"""SELECT COUNT(*) AS n, ROUND(CORR(rx, ry), 6) AS rho FROM (
        SELECT rank() OVER (ORDER BY x) + (COUNT(*) OVER (PARTITION BY x) - 1) / 2e0 AS rx,
          rank() OVER (ORDER BY y) + (COUNT(*) OVER (PARTITION BY y) - 1) / 2e0 AS ry FROM {_POINTS})""",
)
# Student's t in closed form: finite sums over the squared cosine 1 - rho^2, one for even and one for odd freedom.
_RANK_TEST = f"""SELECT * FROM (WITH r AS (SELECT COUNT(*) AS n, CORR(rx, ry) AS rho FROM (
        SELECT rank() OVER (ORDER BY x) + (COUNT(*) OVER (PARTITION BY x) - 1) / 2e0 AS rx,
          rank() OVER (ORDER BY y) + (COUNT(*) OVER (PARTITION BY y) - 1) / 2e0 AS ry FROM {_POINTS})),
    k AS (SELECT n, rho, unnest(generate_series(0, (n - 2) // 2 - 1)) AS k FROM r),
    s AS (SELECT n, rho,
        SUM(exp(lgamma(2 * k + 1) - 2 * lgamma(k + 1) - k * ln(4) + k * ln(1 - rho * rho))) AS even,
        SUM(exp(2 * (k * ln(2) + lgamma(k + 1)) - lgamma(2 * k + 2) + k * ln(1 - rho * rho))) AS odd
        FROM k GROUP BY n, rho),
    p AS (SELECT n, rho, 1 - CASE WHEN n % 2 = 0 THEN abs(rho) * even
        ELSE 2 / pi() * (asin(abs(rho)) + abs(rho) * sqrt(1 - rho * rho) * odd) END AS p FROM s)
    SELECT n, ROUND(rho, 6) AS rho, ROUND(p, 9) AS p_value, p < 0.05 AS significatif FROM p)"""
add(
    "sx3_price_rank_test",
    lambda v: stats.price_rank_test(analytics.price_punctuality_points(v.fares_table, v.fact_table)).select(
        "n", F.round("rho", 6).alias("rho"), F.round("p_value", 9).alias("p_value"), "significatif"
    ),
    _RANK_TEST,
)
add(
    "sx6_group_descriptives",
    lambda v: stats.group_descriptives(v.fact).withColumn("ecart_type", F.round("ecart_type", 6)),
    f"""SELECT type_ligne, COUNT(*) AS n, {mean('taux_ponctualite', 2, None)} AS moyenne,
        ROUND(STDDEV_POP(taux_ponctualite), 6) AS ecart_type FROM fact WHERE taux_ponctualite IS NOT NULL GROUP BY 1""",
)

