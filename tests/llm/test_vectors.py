"""Linked vectors against all pairs, and the share of links that the caps find."""

import numpy as np
import pytest
from test_minhash import classes_of

from barorail.llm import vectors as V
from barorail.llm.vectors import CapFilters, near_vectors, random_pairs

SCHEMA = "vec_id long, embedding array<float>, label int, id string"


def plain(rows, cosine=0.98):
    """{position: (n_links, component)} over all pairs."""
    good = {}
    for at, (i, v, label, *_) in enumerate(rows):
        if i is not None and v and label is not None and None not in v:
            x = np.array(v, np.float32).astype(float)
            if np.isfinite(x).all() and x.any():
                x = x / np.abs(x).max()
                good[at] = x / np.linalg.norm(x)
    pairs = []
    for a in good:
        for b in good:
            if a < b and rows[a][2] == rows[b][2] and len(good[a]) == len(good[b]) and good[a] @ good[b] >= cosine:
                pairs.append((a, b))
    ids = {at: rows[at][0] for at in range(len(rows))}
    classes = classes_of([(ids[a], ids[b]) for a, b in pairs if ids[a] != ids[b]], {i for i in ids.values() if i is not None})
    return sorted((str(ids[at]), sum(at in p for p in pairs), classes.get(ids[at])) for at in ids)


def got(df):
    rows = near_vectors(df).collect()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in rows)
    return sorted((str(r["vec_id"]), r["n_links"], r["component_id"]) for r in rows)


def clusters(seed, n, dims, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(max(1, n // 12), dims))
    x = centres[rng.integers(0, len(centres), n)] + spread * rng.normal(size=(n, dims))
    return x.astype(np.float32)


@pytest.mark.parametrize("dims,spread", [(64, 0.1), (8, 0.1), (3, 0.15), (200, 0.12)])
def test_recall(dims, spread):
    x = clusters(dims, 1500, dims, spread).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    caps = [set(c.tolist()) for c in CapFilters(dims, 11).decode(x)]
    assert min(map(len, caps)) >= 8
    a, b = np.nonzero(np.triu(x @ x.T >= 0.98, 1))
    assert len(a) > 500
    assert sum(bool(caps[i] & caps[j]) for i, j in zip(a, b)) / len(a) > 0.999


@pytest.mark.parametrize("dims,code", [(64, 11), (64, 26), (64, 48), (200, 26)])
def test_recall_at_the_cosine_itself(dims, code):
    """Pairs that are just similar enough, with the codes of tables of up to half a million vectors."""
    filters = CapFilters(dims, code)
    one, other = random_pairs(np.random.default_rng(99), 1500, dims, 0.98)
    assert abs((one * other).sum(axis=1) - 0.98).max() < 1e-9
    caps = filters.decode(one)
    missed = sum(not len(np.intersect1d(x, y)) for x, y in zip(caps, filters.decode(other)))
    assert missed <= 9 and np.mean([len(c) for c in caps]) < 64


def test_decoding_finds_all_caps():
    filters = CapFilters(16, 6, caps=20)
    x = np.random.default_rng(1).normal(size=(30, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    w = filters.words
    for row, found in zip(x, filters.decode(x)):
        s = [row @ part.T for part in w]
        every = (s[0][:, None, None, None] + s[1][:, None, None] + s[2][:, None] + s[3]).ravel()
        assert (np.sort(np.argsort(-every)[: len(found)]) == found).all()
        assert (every >= filters.threshold).sum() <= len(found)


def test_table_and_clusters(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").limit(300).collect()
    rows = [(r["vec_id"], r["embedding"], r["label"], "x") for r in rows]
    x = clusters(2, 300, 64, 0.1)
    rows += [(10_000 - i, v.tolist(), i % 2, "x") for i, v in enumerate(x)]
    rows += [(20_000 + i, x[0].tolist(), 0, "x") for i in range(30)] + [(30_000, (2 * x[0]).tolist(), 0, "x")]
    assert got(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_large_caps_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(V, "BLOCK", 16)
    x = np.random.default_rng(4).normal(size=32) + 0.09 * np.random.default_rng(5).normal(size=(120, 32))
    rows = [(i, v.astype(np.float32).tolist(), 1, "x") for i, v in enumerate(x)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_odd_rows(spark):
    one = [1.0, 2.0, 3.0]
    rows = [(1, one, 1), (2, one, 1), (2, one, 1), (3, one, 2), (4, one, None), (5, None, 1), (6, [], 1), (7, [0.0, 0.0, 0.0], 1)]
    rows += [(8, [1.0, None, 3.0], 1), (9, [float("nan"), 2.0, 3.0], 1), (10, [float("inf"), 2.0, 3.0], 1), (None, one, 1)]
    rows += [(11, [2.0, 4.0, 6.0], 1), (12, [1.0, 2.0], 1), (13, [3e38, 3e38, 3e38], 3), (14, [1e-38, 1e-38, 1e-38], 3)]
    rows += [(15, [-0.0, 1.0], 4), (16, [0.0, 1.0], 4), (17, [-1.0, -2.0, -3.0], 1)]
    rows = [(*r, "x") for r in rows]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(df) == plain(rows)
    assert got(df.limit(0)) == []
    assert len(got(df.where("label IS NULL"))) == 1
