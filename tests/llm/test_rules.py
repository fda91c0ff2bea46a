"""Rule counts against a plain restatement; the forest against planted anomalies and labels."""

import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barorail.llm import rules
from barorail.llm.rules import COUNTS, EXTRA, IsolationForest, calibrate, quality_rules, text_counts, usual_depth

SF = "/root/testdata/sf0.01"


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n")]
    dups = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) and x in lines[:i] for i, x in enumerate(lines))
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(covered)


@pytest.mark.parametrize(
    "text",
    ["", " \n\t", "a b c a b c", "a a a a", "x\n\nx\n x\nx y\nx", "é# <b> \x1c\x85 |", "a b", "w " * 300, "\r\n\r\na\r\na"],
)
def test_counts(text):
    assert text_counts(text)[:5] == plain_counts(text)


def test_forest_finds_what_is_far_off():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 3))
    forest = IsolationForest.fit(x, rows=256)
    far = forest.anomaly(np.array([[9.0, 9, 9], [0, 0, 0]]))
    assert far[0] > 0.7 > 0.5 > far[1]
    assert forest.depth.max() <= 8 + usual_depth(256) and forest.depth.min() > 0
    same = IsolationForest.fit(np.ones((50, 3)))
    assert len(set(same.anomaly(np.array([[1.0, 1, 1], [5, 5, 5]])))) == 1


def test_threshold():
    a = np.arange(100.0)
    assert calibrate(a, np.ones(100), 0.05) == 94.0
    assert calibrate(a, np.zeros(100), 0.05) == np.inf


def test_every_count_of_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = quality_rules(docs, labels).toPandas().set_index("doc_id")
    texts = pd.read_parquet(f"{SF}/documents.parquet").set_index("doc_id")["text"]
    assert sorted(got.index) == sorted(texts.index)
    for i in list(texts.index)[:150]:
        if len(texts[i]) < 5000:
            assert tuple(got.loc[i, list(COUNTS)]) == plain_counts(texts[i])
    failed = (got.n_words < 50) | (100 * got.n_repeat_words > 50 * got.n_words)
    assert (got.base_failed == failed).all() and not got.kept[failed].any()


def test_labels_that_the_forest_meets(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = quality_rules(docs, labels).toPandas().merge(labels.toPandas(), on="doc_id")
    rest = got[~got.base_failed]
    assert rest.kept[rest.quality == 1].mean() > 0.99
    assert rest.kept[rest.quality == 0].mean() < 0.2


def test_odd_tables(spark):
    docs = spark.createDataFrame(
        [(1, None, 5), (1, None, 5), (None, "", 0), (3, "a b " * 100, 9), (4, "x" * 10**6, 1)],
        "doc_id long, text string, n_words long",
    )
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = sorted((r["n_words"], r["kept"]) for r in quality_rules(docs, none).collect())
    assert got == [(0, False), (0, False), (0, False), (1, False), (200, False)]
    fine = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(60)))], "doc_id long, text string")
    assert [r["kept"] for r in quality_rules(fine, none).collect()] == [True]
    assert quality_rules(docs.limit(0), none).collect() == []


def test_forest_and_threshold_come_from_all_examples(spark):
    names = [*COUNTS, *EXTRA]
    good = spark.range(30_000).selectExpr("id AS doc_id", "200 AS n_words", *[f"abs(hash(id, '{c}')) % 1000 AS {c}" for c in names[1:]])
    forest = rules.fit_forest(good, 30_000, trees=10, tree_rows=500)
    # Ten shares of one round: no row is left out, and a tree of more rows has no more nodes.
    assert forest.rows == 3_000 and forest.depth.shape == (10, 512)
    rows = good.toPandas()
    anomaly = forest.anomaly(rules.features({c: rows[c].to_numpy() for c in names}))
    table = spark.createDataFrame(pd.DataFrame({"anomaly": anomaly}))
    for share in (0.005, 0.3, 0.0):
        assert rules.threshold(table, 30_000, share) == calibrate(anomaly, np.ones(30_000), share)


def test_rejects_few_of_more_examples_than_were_once_read(spark):
    """21,000 good examples: those of highest hash, which a sample of 20,000 left out, are as safe as others."""
    text = "concat_ws(' ', transform(sequence(1, 60), i -> concat(repeat('x', CAST(pmod(hash(id, i), 9) AS int)), i)))"
    docs = spark.range(21_000).selectExpr("id AS doc_id", f"concat({text}, repeat(' #', CAST(id % 7 AS int))) AS text")
    late = docs.orderBy(F.xxhash64("doc_id").desc()).limit(1_000).select("doc_id", F.lit(True).alias("late"))
    docs = docs.join(late, "doc_id", "left").selectExpr("doc_id", "CASE WHEN late THEN concat(text, repeat(' $$$$$$', 40)) ELSE text END AS text")
    labels = docs.selectExpr("doc_id", "1 AS quality")
    got = quality_rules(docs, labels).join(late, "doc_id", "left").groupBy("late").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    assert {r["late"]: r["kept"] > 0.85 for r in got} == {None: True, True: True}
