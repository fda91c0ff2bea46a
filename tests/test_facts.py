import datetime

import pytest
from data import GARES, gares, monthly, tarifs
from pyspark.sql import functions as F

from barorail.plans import analytics, harmonize, lines, stations
from barorail.schemas import TGV_MONTHLY


@pytest.fixture(scope="module")
def fact(spark):
    return harmonize.harmonize(*monthly(spark)).cache()


@pytest.fixture(scope="module")
def dim(spark):
    return stations.stations_all([stations.stations_fr(gares(spark))])


@pytest.fixture(scope="module")
def all_lines(fact, dim):
    return lines.liaisons(fact, dim)


@pytest.fixture(scope="module")
def fares(spark, all_lines):
    return lines.fares(*tarifs(spark), all_lines, datetime.date(2024, 5, 1))


def _one(fact, **keys):
    rows = fact
    for k, v in keys.items():
        rows = rows.filter(F.col(k) == v)
    (row,) = rows.collect()
    return row


def test_all_rows_and_types_are_kept(fact):
    counts = {r.type_ligne: r.n for r in fact.groupBy("type_ligne").agg(F.count("*").alias("n")).collect()}
    assert counts == {"grande_vitesse": 4, "regional": 4, "intercite": 3}
    axes = {(r.type_ligne, r.axe_type) for r in fact.select("type_ligne", "axe_type").distinct().collect()}
    assert axes == {("grande_vitesse", "liaison"), ("regional", "region"), ("intercite", "liaison")}


def test_rates(fact):
    tgv = _one(fact, type_ligne="grande_vitesse", mois="2024-02")
    assert (tgv.nb_trains_circules, tgv.taux_ponctualite, tgv.taux_annulation) == (64, 87.5, 20.0)
    ter = _one(fact, type_ligne="regional", mois="2024-01")
    assert (ter.taux_ponctualite, ter.taux_annulation) == (90.0, 3.33)
    ic = _one(fact, type_ligne="intercite", mois="2024-01")
    assert (ic.taux_ponctualite, ic.taux_annulation) == (91.67, 10.0)


def test_rates_are_null_where_nothing_was_planned(fact):
    row = _one(fact, axe_label="BREST -> NICE")
    assert (row.taux_ponctualite, row.taux_annulation) == (None, None)


def test_regions_have_no_ends_and_lines_no_region(fact):
    region = _one(fact, type_ligne="regional", mois="2014-06")
    assert (region.gare_depart, region.gare_arrivee, region.region, region.axe_label) == (
        None, None, "Aquitaine", "Aquitaine",
    )
    assert _one(fact, type_ligne="intercite", mois="2024-01").region is None


def test_delay_only_for_high_speed_and_bad_numbers_are_null(fact):
    assert _one(fact, type_ligne="grande_vitesse", mois="2024-02").retard_moyen_tous_trains_arrivee_min == 6.25
    assert _one(fact, type_ligne="grande_vitesse", mois="2024-03").retard_moyen_tous_trains_arrivee_min is None
    others = fact.filter(F.col("type_ligne") != "grande_vitesse")
    assert others.filter(F.col("retard_moyen_tous_trains_arrivee_min").isNotNull()).isEmpty()


def test_label_is_null_when_an_end_is(spark):
    tgv, ter, ic = monthly(spark)
    broken = spark.createDataFrame([("2024-01", None, "PARIS", "1", "0", "0", None)], TGV_MONTHLY)
    fact = harmonize.harmonize(broken, ter, ic)
    assert _one(fact, type_ligne="grande_vitesse").axe_label is None


def test_strict_casts_fail_on_bad_numbers(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        harmonize.harmonize(*monthly(spark), strict=True).collect()


def test_sample_keeps_active_axes_and_latest_months(fact):
    sample = harmonize.dev_sample(fact, 1, 2)
    assert {r.mois for r in sample.collect()} == {"2024-02", "2024-03"}
    axes = {(r.type_ligne, r.axe_label) for r in sample.collect()}
    assert axes == {
        ("grande_vitesse", "NANTES -> PARIS"), ("regional", "Occitanie"), ("intercite", "PARIS -> St-Malo"),
    }


def test_station_positions_and_names(dim):
    rows = {r.station_id: r for r in dim.collect()}
    assert len(rows) == len(GARES)
    assert (rows["g1"].latitude, rows["g1"].longitude, rows["g1"].nom_gare_norm) == (47.2173, -1.542, "NANTES")
    assert rows["g4"].latitude is None
    assert rows["g1"].id_gare == "FR:g1"


def test_distances(all_lines):
    by_axis = {r.axe_label: r.distance_km for r in all_lines.collect()}
    assert 335 < by_axis["NANTES -> PARIS"] < 350
    assert 315 < by_axis["PARIS -> St-Malo"] < 330  # St-Malo meets Saint Malo
    assert by_axis["BREST -> NICE"] is None


def test_homonyms_abroad_move_the_mean_unless_left_out(spark, fact, dim):
    from pyspark.sql import Row

    abroad = spark.createDataFrame(
        [Row(**{**dim.filter("station_id = 'g2'").head().asDict(), "pays": "DE", "latitude": 0.0})], dim.schema
    )
    both = dim.unionByName(abroad)
    every = stations.stations_by_name(both).filter("nom_norm = 'PARIS'").head()
    french = stations.stations_by_name(both, ["FR"]).filter("nom_norm = 'PARIS'").head()
    assert every.latitude == pytest.approx(48.8566 / 2)
    assert french.latitude == 48.8566


def test_fares(fares):
    rows = {(r.transporteur, r.gare_origine): r for r in fares.collect()}
    inoui = rows[("TGV INOUI", "nantes")]
    assert (inoui.type_ligne, inoui.prix_moyen, inoui.axe_label_regularite) == (
        "grande_vitesse", 50.0, "NANTES -> PARIS",
    )
    assert inoui.prix_moyen_km == round(50.0 / inoui.distance_km, 3)
    assert rows[("OUIGO", "NANTES")].prix_moyen == 27.5
    assert rows[("Nomad", "PARIS")].prix_moyen == 45.25
    assert rows[("Nomad", "PARIS")].type_ligne == "intercite"
    assert rows[("TGV INOUI", "BREST")].prix_moyen_km is None
    assert inoui.date_collecte == datetime.date(2024, 5, 1)


def test_a_fare_meets_every_spelling_of_its_line(spark, dim):
    tgv, ter, ic = monthly(spark)
    again = spark.createDataFrame([("2024-01", "Nantes", "Paris", "10", "0", "1", None)], TGV_MONTHLY)
    fact = harmonize.harmonize(tgv.unionByName(again), ter, ic)
    fares = lines.fares(*tarifs(spark), lines.liaisons(fact, dim), datetime.date(2024, 5, 1))
    labels = [r.axe_label_regularite for r in fares.filter("transporteur = 'OUIGO'").collect()]
    assert sorted(labels) == ["NANTES -> PARIS", "Nantes -> Paris"]


def test_axis_means_and_threshold(fact):
    assert analytics.axis_means(fact).isEmpty()
    rows = {r.axe_label: r for r in analytics.axis_means(fact, 3).collect()}
    assert set(rows) == {"NANTES -> PARIS", "Occitanie", "PARIS -> St-Malo"}
    nantes = rows["NANTES -> PARIS"]
    assert (nantes.nb_mois, nantes.taux_ponctualite_moyen) == (3, 85.83)
    assert (nantes.premier_mois, nantes.dernier_mois) == ("2024-01", "2024-03")


def test_best_and_worst_overlap_when_there_are_few(fact):
    rows = analytics.best_and_worst(fact, 2, 1).collect()
    assert [r.classement for r in rows].count("top5") == 2
    assert len(rows) == 4


def test_top_lines_leaves_regions_out_and_checks_n(fact):
    rows = analytics.top_lines(fact, 3, min_months=1).collect()
    assert {r.type_ligne for r in rows} == {"grande_vitesse", "intercite"}
    only = analytics.top_lines(fact, 3, "intercite", min_months=1).collect()
    assert {r.type_ligne for r in only} == {"intercite"}
    with pytest.raises(ValueError):
        analytics.top_lines(fact, 2)


def test_consolidated(fact, all_lines, fares):
    assert analytics.consolidated(fact, all_lines, fares).columns == [
        "type_ligne", "axe_label", "nb_mois", "taux_ponctualite_moyen", "taux_annulation_moyen",
        "distance_km", "prix_moyen_km",
    ]
    rows = {r.axe_label: r for r in analytics.consolidated(fact, all_lines, fares, 1).collect()}
    assert rows["NANTES -> PARIS"].distance_km is not None
    assert rows["NANTES -> PARIS"].prix_moyen_km is not None
    assert rows["Occitanie"].distance_km is None


def test_price_medians(fares):
    rows = {r.type_ligne: r for r in analytics.price_per_km(fares).collect()}
    per_km = sorted(r.prix_moyen_km for r in fares.filter("axe_label_regularite = 'NANTES -> PARIS'").collect())
    tgv = rows["grande_vitesse"]
    assert (tgv.nb_tarifs, tgv.prix_km_min, tgv.prix_km_max) == (2, per_km[0], per_km[1])
    assert tgv.prix_km_median == pytest.approx(sum(per_km) / 2, abs=6e-4)


def test_price_and_punctuality_equals_the_plain_join(fares, fact):
    rows = {(r.liaison, r.prix_moyen_km): r.ponctualite_moyenne for r in
            analytics.price_and_punctuality_by_line(fares, fact).collect()}
    assert len(rows) == 3
    assert {v for (name, _), v in rows.items() if name.lower().startswith("nantes")} == {85.83}


def test_histogram_closes_the_last_bin(spark):
    fact = spark.createDataFrame([("a", x) for x in (0.0, 3.99, 4.0, 96.0, 100.0, 120.0, None)], "type_ligne string, taux_ponctualite double")
    assert {r.classe: r.nb for r in analytics.punctuality_histogram(fact).collect()} == {0: 2, 1: 1, 24: 2}


def test_monthly_list_filters_and_limits(fact):
    assert analytics.list_monthly(fact, limit=5).count() == 5
    rows = analytics.list_monthly(fact, "intercite", "2024-02", "malo").collect()
    assert [r.axe_label for r in rows] == ["PARIS -> St-Malo"]
    with pytest.raises(ValueError):
        analytics.list_monthly(fact, limit=1001)


def test_station_list_search_and_detail(dim):
    assert [r.nom_gare for r in stations.list_stations(dim, limit=2).collect()] == ["Nantes", "Paris"]
    assert [r.station_id for r in stations.list_stations(dim, "saint").collect()] == ["g3"]
    assert stations.get_station(dim, "FR:g2").head().nom_gare == "Paris"
    assert stations.get_station(dim, "DE:g2").isEmpty()
    with pytest.raises(ValueError):
        stations.list_stations(dim, limit=501)


def test_matrix_extent_and_years(fact, fares):
    matrix = {r.type_ligne: r for r in analytics.year_matrix(fact, [2014, 2024]).collect()}
    assert matrix["regional"]["2014"] == 90.0
    assert matrix["intercite"]["2014"] is None
    extent = analytics.extent(fact, fares).head()
    assert (extent.nb_lignes, extent.mois_min, extent.mois_max, extent.nb_tarifs) == (10, "2014-06", "2024-03", 3)
    assert (extent.annee_min, extent.annee_max) == (2014, 2024)
    only = {r.type_ligne for r in analytics.type_means_between(fact, 2010, 2020).collect()}
    assert only == {"regional"}
