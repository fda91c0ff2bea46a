import math
import random
import re

import pytest
from pyspark.sql import functions as F

from barorail.operators import ordered
from barorail.plans import stats


def _brute_ranks(xs):
    return [sum(o < x for o in xs) + (sum(o == x for o in xs) + 1) / 2 for x in xs]


def _brute_corr(a, b):
    ma, mb = sum(a) / len(a), sum(b) / len(b)
    top = sum((x - ma) * (y - mb) for x, y in zip(a, b))
    return top / math.sqrt(sum((x - ma) ** 2 for x in a) * sum((y - mb) ** 2 for y in b))


@pytest.fixture(params=[50, 7, 1], ids=["many ranges", "some ranges", "one range"])
def splitting(request, spark):
    """So many partitions of a shuffle by range, none of them merged."""
    settings = {
        "spark.sql.shuffle.partitions": str(request.param),
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.95, 0.99, 1.0])
def test_quantiles_equal_sorting(spark, splitting, q):
    rng = random.Random(3)
    groups = {
        "many": [rng.random() * 100 for _ in range(1500)],
        "hot": [5.0] * 2000 + [float(i) for i in range(700)],
        "one": [2.5],
        "two": [1.0, 2.0],
        None: [3.0, 1.0, 2.0, 2.0],
    }
    df = spark.createDataFrame([(g, x) for g, xs in groups.items() for x in xs], "g string, x double")
    got = {r.g: r for r in ordered.quantile_summary(df, ["g"], "x", q).collect()}
    for g, xs in groups.items():
        xs = sorted(xs)
        pos = q * (len(xs) - 1)
        low, high = xs[math.floor(pos)], xs[math.ceil(pos)]
        assert got[g]["quantile"] == pytest.approx(low + (high - low) * (pos - math.floor(pos)), abs=1e-12)
        assert (got[g].total, got[g].lowest, got[g].highest) == (len(xs), xs[0], xs[-1])


def test_running_counts_equal_sorting(spark, splitting):
    rng = random.Random(4)
    xs = [round(rng.gauss(0, 10), 2) for _ in range(5000)] + [0.0] * 2500
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    rows = ordered.running_counts(ordered.value_counts(df, [], "x"), [], "x").collect()
    before = 0
    for row in sorted(rows, key=lambda r: r.x):
        assert (row.before, row.total) == (before, len(xs))
        before += row.n
    assert before == len(xs)


def test_spearman_with_ties(spark):
    x, y = [1, 2, 3, 4, 5, 6], [1, 3, 2, 5, 5, 6]
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    row = ordered.spearman(df, "x", "y").head()
    assert (row.n, row.rho) == (6, pytest.approx(0.9276336570439175))


def test_spearman_equals_brute_force_with_a_hot_value(spark, splitting):
    rng = random.Random(5)
    pairs = [(round(rng.random(), 1), rng.randrange(20) / 2) for _ in range(600)] + [(0.3, 4.0)] * 300
    df = spark.createDataFrame(pairs, "x double, y double")
    a, b = _brute_ranks([p[0] for p in pairs]), _brute_ranks([p[1] for p in pairs])
    assert ordered.spearman(df, "x", "y").head().rho == pytest.approx(_brute_corr(a, b))


def test_spearman_without_variation_or_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    assert ordered.spearman(df, "x", "y").head().rho is None
    assert tuple(ordered.spearman(df.limit(0), "x", "y").head()) == (0, None)


def _fact(spark, groups):
    rows = [(g, f"{g}{i}", x) for g, xs in groups.items() for i, x in enumerate(xs)]
    return spark.createDataFrame(rows, "type_ligne string, axe_label string, taux_ponctualite double")


def test_anova_known_value(spark):
    fact = _fact(spark, {"a": [85.0, 88.0], "b": [90.0, 93.0, 95.0], "c": [70.0, 75.0]})
    row = stats.anova(fact).head()
    assert (row.nb_groupes, row.n) == (3, 7)
    assert row.f_stat == pytest.approx(33.24879614766693)
    assert row.p_value == pytest.approx(0.0032193738574202158)
    assert row.significatif is True


def test_eta_squared_edges(spark):
    same = stats.anova_statistic(_fact(spark, {"a": [50.0, 50.0], "b": [50.0, 50.0]})).head()
    assert (same.eta2, same.f_stat) == (0.0, None)
    split = stats.anova_statistic(_fact(spark, {"a": [10.0, 10.0], "b": [50.0, 50.0], "c": [90.0, 90.0]})).head()
    assert (split.eta2, split.f_stat) == (1.0, math.inf)


def test_anova_grains(spark):
    rows = [("a", "x", 80.0), ("a", "x", 90.0), ("a", "y", 70.0), ("b", "z", 60.0), ("b", "w", 64.0)]
    fact = spark.createDataFrame(rows, "type_ligne string, axe_label string, taux_ponctualite double")
    assert stats.anova_statistic(fact).head().n == 4
    assert stats.anova_statistic(fact, "month").head().n == 5
    assert {r.type_ligne: r.n for r in stats.group_sizes(fact).collect()} == {"a": 2, "b": 2}


def test_small_samples_have_no_correlation(spark):
    df = spark.createDataFrame([("t", 0.1, 90.0), ("t", 0.2, 91.0)], "type_ligne string, prix_moyen_km double, taux_ponctualite_moyen double")
    row = stats.price_rank_test(df).head()
    assert (row.n, row.rho, row.p_value, row.significatif) == (2, None, None, None)


def test_incomplete_beta_reference_points():
    assert stats.incomplete_beta(1.0, 1.0, 0.3) == pytest.approx(0.3)
    assert stats.incomplete_beta(2.0, 3.0, 0.4) == pytest.approx(0.5248)
    assert stats.incomplete_beta(0.5, 0.5, 0.5) == pytest.approx(0.5)
    assert stats.incomplete_beta(5.0, 2.0, 0.9) == pytest.approx(0.885735)
    assert stats.rank_test_p(1.0, 5) == 0.0


@pytest.mark.parametrize("rho, n", [(0.5, 12), (-0.2, 40), (0.9, 4)])
def test_rank_test_equals_the_integrated_t_density(rho, n):
    v = n - 2
    t = abs(rho) * math.sqrt(v / (1 - rho * rho))
    scale = math.gamma((v + 1) / 2) / (math.sqrt(v * math.pi) * math.gamma(v / 2))
    steps = 20_000
    xs = [t * i / steps for i in range(steps + 1)]
    ys = [scale * (1 + x * x / v) ** (-(v + 1) / 2) for x in xs]
    inside = (t / steps) * (sum(ys) - (ys[0] + ys[-1]) / 2)
    assert stats.rank_test_p(rho, n) == pytest.approx(1 - 2 * inside, abs=1e-7)


def test_group_descriptives(spark):
    row = stats.group_descriptives(_fact(spark, {"a": [10.0, 20.0]})).head()
    assert (row.n, row.moyenne, row.ecart_type) == (2, 15.0, 5.0)


def test_beta_at_large_parameters():
    from fractions import Fraction

    from barorail.plans.stats import incomplete_beta, log_beta

    # By symmetry one half in the middle, however large the parameters are.
    for n in (3.0, 40.0, 5e4, 5e6, 5e7):
        assert abs(incomplete_beta(n, n, 0.5) - 0.5) < 1e-6
    for a, b in ((2, 3), (7, 40), (15, 15), (12, 90)):
        exact = Fraction(math.factorial(a - 1) * math.factorial(b - 1), math.factorial(a + b - 1))
        assert abs(log_beta(a, b) - math.log(exact)) < 1e-12 * abs(math.log(exact))


def test_numbers_follow_the_order(spark, splitting):
    rng = random.Random(5)
    rows = [(rng.choice([None, 1.0, 2.0, rng.random()]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "x double, id long")
    order = [F.col("x").desc_nulls_last(), F.col("id")]
    found = sorted(ordered.numbered(df, order, "place").collect(), key=lambda r: r.place)
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0.0), r[1]))
    assert [(r.x, r.id) for r in found] == want
    assert [r.place for r in found] == list(range(1, 3001))
    assert ordered.numbered(df.limit(0), order).collect() == []


def test_no_task_sorts_a_whole_group(spark, splitting):
    df = spark.createDataFrame([("a", float(i)) for i in range(500)], "g string, x double")
    for keys in ([], ["g"]):
        ranked = ordered.running_counts(ordered.value_counts(df, keys, "x"), keys, "x")
        plan = ranked._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"Window [^\n]*\n[^\n]*Sort[^\n]*\n[^\n]*Exchange SinglePartition", plan)
        assert {(r.x, r.before, r.total) for r in ranked.collect()} == {(float(i), i, 500) for i in range(500)}


def test_p_values_as_columns(spark):
    rng = random.Random(9)
    rows = [(rng.uniform(-1, 1), rng.randint(3, 400)) for _ in range(40)] + [(0.0, 5), (1.0, 5), (-1.0, 9), (0.01, 90_000)]
    df = spark.createDataFrame([(r, n, r * r, stats.rank_test_p(r, n)) for r, n in rows], "rho double, n long, r2 double, p double")
    a, x = (F.col("n") - 2) / 2, (1 - F.col("rho")) * (1 + F.col("rho"))
    for r in stats.with_beta_tail(df, a, F.lit(0.5), x, "found").collect():
        assert r.found == pytest.approx(r.p, rel=1e-8, abs=1e-13)
    tests = [(rng.uniform(0, 9), float(rng.randint(1, 30)), float(rng.randint(1, 3000))) for _ in range(40)]
    df = spark.createDataFrame([(*t, stats.f_test_p(*t)) for t in tests], "f double, between double, within double, p double")
    x = F.col("within") / (F.col("within") + F.col("between") * F.col("f"))
    for r in stats.with_beta_tail(df, F.col("within") / 2, F.col("between") / 2, x, "found").collect():
        assert r.found == pytest.approx(r.p, rel=1e-8, abs=1e-13)
    nothing = spark.createDataFrame([(None, 5), (None, 0)], "rho double, n long")
    assert [r.found for r in stats.with_beta_tail(nothing, F.col("n") / 2, F.lit(0.5), F.col("rho"), "found").collect()] == [None, None]
