"""The compression classifier: held-out accuracy, the curve, odd tables."""

import zlib

import numpy as np
import pandas as pd

from barorail.llm.compression import classify, rising_curve

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = classify(docs, labels).toPandas()
    assert len(got) == docs.count() and got.score.between(0, 1).all()
    assert (got.predicted == (got.score >= 0.3)).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    held = got[got.held_out].merge(pd.read_parquet(f"{SF}/labels.parquet"), on="doc_id")
    assert (held.predicted == held.quality).mean() > 0.95
    assert held.predicted[held.quality == 1].mean() > 0.98
    assert held.predicted[held.quality == 0].mean() < 0.3


def test_labels_of_held_out_rows_are_not_used(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.selectExpr(
        "doc_id", "CASE WHEN pmod(crc32(CAST(doc_id AS string)), 5) = 0 THEN 1 - quality ELSE quality END AS quality"
    )
    both = [sorted(map(tuple, classify(docs, x).collect())) for x in (labels, flipped)]
    assert both[0] == both[1]


def test_curve_rises():
    rng = np.random.default_rng(2)
    x = rng.normal(size=500)
    at, rate = rising_curve(x, (x + rng.normal(size=500) > 0).astype(int))
    assert (np.diff(at) > 0).all() and (np.diff(rate) >= 0).all()
    assert 0 < rate[0] < 0.1 and 0.9 < rate[-1] < 1
    at, rate = rising_curve(np.zeros(4), np.array([0, 1, 1, 1]))
    assert at == (0.0,) and rate == (3.5 / 5,)


def test_odd_tables(spark):
    docs = spark.createDataFrame(
        [(1, None, 0.5), (1, None, 0.5), (None, "", 1.0), (2, "é" * 200_000, 2.0)],
        "doc_id long, text string, score double",
    )
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (None, 1), (3, None)], "doc_id long, quality int")
    got = classify(docs, labels).collect()
    assert len(got) == 4 and len({r["score"] for r in got}) == 1
    assert classify(docs.limit(0), labels.limit(0)).collect() == []
