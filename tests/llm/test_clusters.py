"""Clustering against all distances in plain numpy, and the bounds against what they bound."""

import hashlib
import os

import numpy as np
import pyarrow.parquet as pq
import pytest
from compare import connect, differences

from barorail.llm import clusters
from barorail.llm.clusters import LARGEST, Move, cluster_vectors, fitted, moved, scanned, squared_distances
from barorail.llm.queries import op13_centroid_clustering, oracle_sql

SF = "/root/testdata/sf0.001"


def brute(rows, dims=64, count=8, rounds=10):
    """vec_id -> cluster, distance, cluster_inertia, inertia, centroid_sha256, by all distances in each round."""
    kept = [(i, v) for i, v in rows if v is not None and len(v) == dims and None not in v and np.isfinite(v).all()]
    x = np.array([[int(np.floor(1024.0 * c)) for c in v] for _, v in kept], np.int64).reshape(-1, dims)
    names = [hashlib.sha256(f"3:{i}".encode()).hexdigest() for i, _ in kept]
    c = x[sorted(range(len(kept)), key=lambda i: (names[i], x[i].tolist()))[:count]].copy()
    for _ in range(rounds):
        nearest = ((x[:, None] - c[None]) ** 2).sum(2).argmin(1)
        for j in range(len(c)):
            if (nearest == j).any():
                c[j] = x[nearest == j].sum(0) // (nearest == j).sum()
    every = ((x[:, None] - c[None]) ** 2).sum(2)
    nearest, own = every.argmin(1), every.min(1)
    hashes = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in c.tolist()]
    return sorted(
        (i, int(j), int(d), int(own[nearest == j].sum()), int(own.sum()), hashes[j])
        for (i, _), j, d in zip(kept, nearest, own)
    )


def told(df):
    return sorted(tuple(r) for r in df.collect())


def test_table(spark):
    table = pq.read_table(f"{SF}/embeddings.parquet")
    rows = list(zip(table.column("vec_id").to_pylist(), table.column("embedding").to_pylist()))
    assert told(op13_centroid_clustering(spark, SF)) == brute(rows)


@pytest.fixture(scope="module")
def groups():
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(8, 64)) * 3
    x = centres[np.arange(1500) % 8] + rng.normal(size=(1500, 64)) * 0.4
    return [(i, [float(c) for c in v]) for i, v in enumerate(x)]


def test_bounds_spare_most_comparisons(spark, groups):
    df = spark.createDataFrame(groups, "vec_id long, embedding array<double>").repartition(3)
    assert told(cluster_vectors(df)) == brute(groups)
    compared = [t.compared for t in fitted(df).rounds]
    assert compared[0] == 1500 and sum(compared[5:]) < 300


def test_one_table_stays(spark, groups, tmp_path, monkeypatch):
    names = iter(range(100))
    monkeypatch.setattr(clusters, "scratch_dir", lambda spark, label: f"{tmp_path}/{label}-{next(names)}")
    cluster_vectors(spark.createDataFrame(groups[:100], "vec_id long, embedding array<double>")).collect()
    assert os.listdir(tmp_path) == ["clusters-11"]


def test_odd_tables(spark):
    nan = float("nan")
    good = [(i, [float((i * 37 + d * d) % 11) - 5 for d in range(64)]) for i in range(40)]
    odd = [(50, None), (51, []), (52, [1.0] * 63), (53, [1.0] * 65), (54, [nan] * 64), (55, [None] + [1.0] * 63)]
    twice = good + [good[3], (7, [2.0] * 64), (60, [0.0] * 64), (61, [0.0] * 64)]
    schema = "vec_id long, embedding array<double>, cluster string"
    df = spark.createDataFrame([(*r, "x") for r in twice + odd], schema)
    assert told(cluster_vectors(df)) == brute(twice)
    nobody = [(None, [0.5] * 64), (1, [0.25] * 64)]
    found = cluster_vectors(spark.createDataFrame(nobody, "vec_id long, embedding array<double>")).collect()
    assert sorted((str(r.vec_id), r.cluster, r.distance) for r in found) == [("1", 0, 0), ("None", 1, 0)]
    for empty in (df.limit(0), df.where("vec_id >= 50 AND vec_id < 60")):
        assert cluster_vectors(empty).collect() == []
        assert cluster_vectors(empty).columns[:3] == ["vec_id", "cluster", "distance"]
    strings = spark.createDataFrame([(str(i), v) for i, v in good], "vec_id string, embedding array<double>")
    assert [r[1:] for r in told(cluster_vectors(strings))] == [r[1:] for r in brute([(str(i), v) for i, v in good])]


def test_too_large_components_are_an_error(spark):
    df = spark.createDataFrame([(1, [1e9] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="exact distances"):
        cluster_vectors(df).collect()


def test_loosening_bounds_every_approach():
    rng = np.random.default_rng(11)
    saved, full = 0.0, 0.0
    for _ in range(200):
        dims, count = int(rng.integers(1, 6)), int(rng.integers(2, 6))
        before = rng.integers(-300, 300, (count, dims))
        after = before + rng.integers(-40, 41, (count, dims)) * (rng.random((count, 1)) < 0.7)
        own = rng.integers(0, count, 60)
        x = before[own] + rng.integers(-60, 61, (60, dims))
        from_own = np.linalg.norm(x - before[own], axis=1)
        reach = np.array([from_own[own == i].max(initial=0.0) for i in range(count)])
        looser = Move(before, after, reach).loosening()
        nearer = np.linalg.norm(x[:, None] - before, axis=2) - np.linalg.norm(x[:, None] - after, axis=2)
        nearer[np.arange(60), own] = 0
        assert (nearer.max(axis=1) <= looser[own] + 1e-9).all()
        drift = np.linalg.norm(after - before, axis=1)
        others = np.array([np.delete(drift, i).max() for i in range(count)])
        assert (looser <= others + 1e-9).all()
        saved, full = saved + looser.sum(), full + others.sum()
    assert saved < 0.9 * full


def test_moved_equals_scanned():
    rng = np.random.default_rng(2)
    for large in (100, LARGEST // 4):
        x = rng.integers(-large, large, (400, 5))
        before = x[:6].copy()
        clusters_, own, bounds = scanned(x, before)
        for _ in range(4):
            after = before + rng.integers(-(large // 50) - 1, large // 50 + 2, before.shape)
            reach = np.sqrt([own[clusters_ == i].max(initial=0) for i in range(6)])
            move = Move(before, after, reach)
            clusters_, own, bounds, _ = moved(x, clusters_, bounds, move, move.loosening())
            told_ = scanned(x, after)
            assert (clusters_ == told_[0]).all() and (own == told_[1]).all() and (bounds <= told_[2] + 1e-6).all()
            before = after


def test_squared_distances_of_large_numbers():
    x = np.array([[LARGEST, -LARGEST], [LARGEST - 1, 3]])
    assert squared_distances(x, -x).tolist() == [
        [sum((int(a) + int(b)) ** 2 for a, b in zip(u, v)) for v in x] for u in x
    ]
    assert clusters.LARGEST == LARGEST


def test_sql(spark):
    assert differences(op13_centroid_clustering(spark, SF), connect(SF), oracle_sql()["op13_centroid_clustering"]) is None
