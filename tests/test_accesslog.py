import datetime

import pytest
from pyspark.sql import functions as F

from barorail.plans import accesslog

T0 = datetime.datetime(2024, 1, 1, 10, 0, 0)


def _log(spark, rows):
    return spark.createDataFrame(
        [(T0 + datetime.timedelta(seconds=s), ip, "GET", path, status, d, "k") for s, ip, path, status, d in rows],
        "ts timestamp, ip string, method string, path string, status int, duration_s double, api_key string",
    )


def test_counts_use_the_path_template(spark):
    log = _log(spark, [(0, "1.2.3.4", "/stations/FR:1", 200, 0.1), (1, "1.2.3.4", "/stations/FR:2", 200, 0.1), (2, "1.2.3.4", "/stations", 429, 0.1)])
    rows = {(r.path, r.status): r.n for r in accesslog.request_counts(log).collect()}
    assert rows == {("/stations/{id_gare}", 200): 2, ("/stations", 429): 1}
    assert tuple(accesslog.totals(log).head()) == (3, 1)
    assert {r.status: r.n for r in accesslog.by_status(log).collect()} == {200: 2, 429: 1}


def test_log_lines_hide_the_caller(spark):
    log = _log(spark, [(0, "91.2.3.4", "/health", 200, 0.1), (0, None, "/health", 200, 0.1)])
    lines = sorted(r.ligne for r in accesslog.log_lines(log).collect())
    assert lines == ['91.2.0.0 - "GET /health" 200', 'unknown - "GET /health" 200']


def test_histogram_is_cumulative(spark):
    log = _log(spark, [(0, "a", "/p", 200, d) for d in (0.005, 0.006, 0.3, 99.0)])
    rows = {r.borne_s: r.n for r in accesslog.latency_histogram(log).collect()}
    assert rows[0.005] == 1 and rows[0.01] == 2 and rows[0.5] == 3 and rows[10.0] == 3 and rows[float("inf")] == 4


@pytest.mark.parametrize(
    "durations, q, value",
    [([0.02] * 4, 0.95, 0.01 + 0.015 * 0.95), ([0.5] * 10 + [2.0] * 10, 0.75, 1.0 + 1.5 * 0.5), ([50.0], 0.95, 10.0)],
)
def test_quantile_inside_its_bucket(spark, durations, q, value):
    log = _log(spark, [(0, "a", "/p", 200, d) for d in durations])
    (row,) = accesslog.latency_quantiles(log, q, "1 minute", "1 minute").collect()
    assert row.latence_s == pytest.approx(value)


def test_quota(spark):
    rows = [(i, "a", "/stations", 200, 0.1) for i in range(31)] + [(i, "b", "/stations", 200, 0.1) for i in range(30)]
    rows += [(59, "c", "/p", 200, 0.1)] * 20 + [(60, "c", "/p", 200, 0.1)] * 20
    (breach,) = accesslog.quota_breaches(_log(spark, rows)).collect()
    assert (breach.appelant, breach.path, breach.n) == ("a", "/stations", 31)


def test_rate(spark):
    rows = accesslog.request_rate(_log(spark, [(0, "a", "/p", 200, 0.1)] * 30)).collect()
    assert [r.par_seconde for r in rows] == [0.5]
    assert accesslog.anonymized(_log(spark, [(0, "1.2.3.4", "/p", 200, 0.1)])).select(F.max("ip")).head()[0] == "1.2.0.0"


def test_sketches_merge_into_sliding_windows(spark):
    rows = [(s, "a", f"/p{s % 2}", 200, (s * 37 % 1000) / 100) for s in range(1200)]
    log = _log(spark, rows)
    slots = accesslog.latency_sketches(log)
    assert slots.count() == 40  # a row per path and minute, whatever their requests
    # The shares of a log that were sketched apart add up to the whole.
    half = accesslog.latency_sketches(log.where("duration_s < 5")).unionByName(
        accesslog.latency_sketches(log.where("duration_s >= 5"))
    )
    start = int(T0.replace(tzinfo=datetime.timezone.utc).timestamp())
    for told in (slots, half):
        found = {
            (r.debut, r.path): (r.n, r.latence_s)
            for r in accesslog.sketched_latency(told).withColumn("debut", F.unix_timestamp("debut")).collect()
        }
        want = {}
        for s, _, path, _, d in rows:
            for back in range(5):
                want.setdefault((start + s // 60 * 60 - 60 * back, path), []).append(d)
        assert {k: n for k, (n, _) in found.items()} == {k: len(v) for k, v in want.items()}
        for key, values in want.items():
            upto = sum(v <= found[key][1] for v in values) / len(values)
            below = sum(v < found[key][1] for v in values) / len(values)
            assert below - 0.01 <= 0.95 <= upto + 0.01


def test_sketches_of_nothing(spark):
    log = _log(spark, [(0, "a", "/p", 200, None), (70, "a", "/p", 200, 1.0)])
    found = {r.n: r.latence_s for r in accesslog.sketched_latency(accesslog.latency_sketches(log), window_slots=1).collect()}
    assert found == {0: None, 1: 1.0}
    assert accesslog.sketched_latency(accesslog.latency_sketches(log.limit(0))).collect() == []
