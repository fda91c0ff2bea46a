"""Small inputs shared by the tests."""

from __future__ import annotations

from barorail import schemas as S

TGV = [
    ("2024-01", "NANTES", "PARIS", "80", "0", "4", "3.5"),
    ("2024-02", "NANTES", "PARIS", "80", "16", "8", "6.25"),
    ("2024-03", "NANTES", "PARIS", "80", "0", "20", "n/a"),
    ("2024-01", "BREST", "NICE", "0", "0", "0", None),
]
TER = [
    ("2024-01", "Occitanie", "300", "290", "10", "29"),
    ("2024-02", "Occitanie", "300", "285", "15", "57"),
    ("2024-03", "Occitanie", "300", "270", "30", "0"),
    ("2014-06", "Aquitaine", "90", "90", "0", "9"),
]
INTERCITES = [
    ("2024-01", "PARIS", "St-Malo", "40", "36", "4", "3"),
    ("2024-02", "PARIS", "St-Malo", "40", "40", "0", "10"),
    ("2024-03", "PARIS", "St-Malo", "40", "39", "1", "0"),
]
GARES = [
    ("Nantes", "NTS", "A", "47.2173, -1.5420", "44109", "87481002", "g1"),
    ("Paris", "PAR", "A", "48.8566, 2.3522", "75056", "87271007", "g2"),
    ("Saint Malo", "SML", "B", "48.6469, -2.0004", "35288", "87478107", "g3"),
    ("Perdue", "PDU", "C", None, "0", "87000000", "g4"),
]
TARIFS_TGV = [
    ("TGV INOUI", "nantes", "1", "Paris", "2", "2", "Tarif Normal", "20.0", "80.0"),
    ("OUIGO", "NANTES", "1", "PARIS", "2", "2", "Tarif Normal", "10.0", "45.0"),
    ("TGV INOUI", "BREST", "1", "NICE", "2", "2", "Tarif Normal", "40.0", "90.0"),
]
TARIFS_IC = [("Nomad", "PARIS", "1", "Saint Malo", "2", "2", "Tarif Normal", "25.0", "65.5")]


def monthly(spark):
    return (
        spark.createDataFrame(TGV, S.TGV_MONTHLY),
        spark.createDataFrame(TER, S.TER_MONTHLY),
        spark.createDataFrame(INTERCITES, S.INTERCITES_MONTHLY),
    )


def gares(spark):
    return spark.createDataFrame(GARES, S.GARES)


def tarifs(spark):
    return spark.createDataFrame(TARIFS_TGV, S.TARIFS), spark.createDataFrame(TARIFS_IC, S.TARIFS)
