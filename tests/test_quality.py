import random

from pyspark.sql import functions as F

from barorail.plans import quality


def _report(df):
    return {(r.mesure, r.colonne): r.valeur for r in df.collect()}


def test_profile_counts_nulls_and_duplicates(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y"), (None, "z")], "a int, b string")
    assert _report(quality.profile(df, "s")) == {
        ("lignes", ""): 4, ("colonnes", ""): 2, ("nuls", "a"): 1, ("doublons", ""): 1,
    }


def test_equal_rows_with_nulls_are_duplicates_and_shifted_values_are_not(spark):
    same = spark.createDataFrame([(None, "x"), (None, "x"), ("x", None)], "a string, b string")
    assert _report(quality.duplicate_count(same, "s")) == {("doublons", ""): 1}


def test_clean_source_has_no_null_rows(spark):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    assert _report(quality.profile(df, "s")) == {("lignes", ""): 2, ("colonnes", ""): 1, ("doublons", ""): 0}


def test_outliers(spark):
    df = spark.createDataFrame([("10.0",)] * 99 + [("10000",)], "`Prix maximum` string")
    assert _report(quality.profile(df, "s", "Prix maximum"))[("aberrants_p99", "Prix maximum")] == 1
    assert ("aberrants_p99", "Prix maximum") not in _report(quality.profile(df.toDF("a"), "s", "Prix maximum"))


def test_outliers_equal_the_sorted_threshold(spark):
    rng = random.Random(2)
    for n in (1, 2, 100, 101, 1234):
        xs = [rng.choice([rng.randrange(50), rng.random() * 60]) for _ in range(n)]
        pos = 0.99 * (n - 1)
        ordered = sorted(xs)
        low, high = ordered[int(pos)], ordered[min(int(pos) + 1, n - 1)]
        limit = low + (high - low) * (pos - int(pos))
        df = spark.createDataFrame([(float(x),) for x in xs] + [(None,)], "v double")
        assert _report(quality.outlier_count(df, "v", "s")) == {("aberrants_p99", "v"): sum(x > limit for x in xs)}


def test_outlier_sketch(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    assert _report(quality.outlier_count(df, "v", "s", accuracy=10_000)) == {("aberrants_p99", "v"): 10}
    assert _report(quality.outlier_count(df.limit(0), "v", "s", accuracy=100)) == {("aberrants_p99", "v"): 0}


def test_empty_source(spark):
    df = spark.createDataFrame([], "a int, `Prix maximum` string")
    assert _report(quality.profile(df, "s", "Prix maximum")) == {
        ("lignes", ""): 0, ("colonnes", ""): 2, ("doublons", ""): 0, ("aberrants_p99", "Prix maximum"): 0,
    }


def test_column_tests(spark):
    df = spark.createDataFrame([("a", "FR"), ("a", "XX"), (None, None)], "k string, pays string")
    assert quality.not_null_violations(df, "k").count() == 1
    assert [tuple(r) for r in quality.unique_violations(df, "k").collect()] == [("a", 2)]
    assert [tuple(r) for r in quality.accepted_values_violations(df, "pays", ["FR"]).collect()] == [("XX", 1)]


def test_rows_a_microsecond_apart_are_not_duplicates(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, TIMESTAMP '2024-01-01 00:00:00.000001'), (1, TIMESTAMP '2024-01-01 00:00:00.000002'),"
        " (1, TIMESTAMP '2024-01-01 00:00:00.000002'), (2, NULL), (2, NULL) AS t(a, b)"
    )
    assert quality.duplicate_count(df, "s").head().valeur == 2
    assert _report(quality.profile(df, "s"))[("doublons", "")] == 2
