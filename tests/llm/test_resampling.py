"""Importance resampling against plain Python: hashes, counts, gains, scores and the draw."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
from compare import connect, differences
from hypothesis import given, settings
from hypothesis import strategies as st

from barorail.llm.queries import op12_importance_resampling, oracle_sql
from barorail.llm.resampling import PART, crc32s, drawn_documents, feature_buckets, resampled

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    runs = [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]
    return len(words), [zlib.crc32(r.encode("utf-8", "surrogatepass")) % 10000 for r in runs]


def brute(docs, target, percent=5, fewest=20):
    """doc_id, n_features, weight, score, rank of (doc_id, text) rows with ids of their own."""
    hashed = [(i, *features(t)) for i, t in docs]
    s, t = Counter(b for _, _, f in hashed for b in f), Counter(b for x in target for b in features(x)[1])
    s_all, t_all = sum(s.values()) + 10000, sum(t.values()) + 10000
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * s_all / ((s[b] + 1) * t_all))) for b in range(10000)}
    out = {}
    for i, n, found in hashed:
        h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        out[i] = [len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None]
    fits = sorted((i for i, n, _ in hashed if n >= fewest), key=lambda i: (-out[i][2], i))
    for rank, i in enumerate(fits[: percent * len(fits) // 100], 1):
        out[i][3] = rank
    return {i: tuple(v) for i, v in out.items()}


def test_table(spark):
    docs = pq.read_table(f"{SF}/documents.parquet")
    docs = list(zip(docs.column("doc_id").to_pylist(), docs.column("text").to_pylist()))
    target = pq.read_table(f"{SF}/benchmark.parquet").column("text").to_pylist()
    found = {r.doc_id: tuple(r)[1:] for r in op12_importance_resampling(spark, SF).collect()}
    assert found == brute(docs, target)
    assert sum(v[3] is not None for v in found.values()) > 0


def test_checksums_of_all_lengths():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 20_000).astype(np.uint8)
    lengths = np.array([0, 1, 2, 7, 7, PART - 1, PART, PART + 1, 2 * PART, 2 * PART + 1, 5000, 9999, 7, 300])
    starts = rng.integers(0, 10_000, len(lengths))
    told = [zlib.crc32(data[a : a + n].tobytes()) for a, n in zip(starts, lengths)]
    assert crc32s(data, starts, lengths).tolist() == told
    assert crc32s(data, starts[:0], lengths[:0]).tolist() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAbZ09 \n.@[`{é日\x7f\x00", max_size=40)), max_size=6))
def test_features(texts):
    for text, (words, buckets) in zip(texts, feature_buckets(texts)):
        n, told = features(text)
        assert (words, sorted(buckets.tolist())) == (n, sorted(told))


def test_long_words_and_texts():
    texts = ["x" * 3000 + " y " + "é" * 700, " ".join(f"w{i % 977}" for i in range(30_000)), None, ""]
    for text, (words, buckets) in zip(texts, feature_buckets(texts)):
        n, told = features(text)
        assert (words, sorted(buckets.tolist())) == (n, sorted(told))


def test_odd_tables(spark):
    long = " ".join(f"word{i}" for i in range(25))
    rows = [(1, long, "a"), (1, long, "b"), (None, long, "c"), (2, None, "d"), (3, "", "e"), (4, "few words", None)]
    rows += [(10 + i, f"{long} {i}", "f") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rank string")
    target = spark.createDataFrame([("word1 word2", 5), (None, 6)], "text string, doc_id long")
    found = resampled(docs, target).collect()
    assert found and resampled(docs, target).columns == ["doc_id", "n_features", "weight", "score", "rank"]
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, []).append(r)
    assert len(found) == len(rows) and len(by_id[1]) == 2
    assert by_id[1][0].score == by_id[1][1].score
    assert [(r.n_features, r.weight, r.rank) for i in (2, 3) for r in by_id[i]] == [(0, 0, None)] * 2
    assert by_id[4][0].n_features == 3 and by_id[4][0].rank is None
    ranked = sorted((r.rank, -r.score, r.doc_id) for r in found if r.rank is not None)
    assert [r[0] for r in ranked] == [1, 2, 3]  # five in a hundred of 63
    fits = sorted((-r.score, r.doc_id is None, r.doc_id) for r in found if r.n_features >= 57)
    assert [(-s, i) for _, s, i in ranked] == [(-s, i) for s, _, i in fits[:3]]
    drawn = drawn_documents(docs, target)
    assert drawn.columns == docs.columns
    assert {r.doc_id for r in drawn.collect()} == {i for _, _, i in ranked if i is not None}
    assert resampled(docs.limit(0), target).collect() == []
    nothing = resampled(docs, target.limit(0)).collect()
    assert len(nothing) == len(rows)


def test_all_are_drawn_in_order(spark):
    docs = spark.createDataFrame([(i, f"w{i} and more") for i in range(300)], "doc_id long, text string")
    target = spark.createDataFrame([("w1 and",)], "text string")
    found = {r.doc_id: tuple(r)[1:] for r in resampled(docs, target, percent=100, fewest=1).collect()}
    assert found == brute([(i, f"w{i} and more") for i in range(300)], ["w1 and"], 100, 1)


def test_sql(spark):
    assert differences(op12_importance_resampling(spark, SF), connect(SF), oracle_sql()["op12_importance_resampling"]) is None
