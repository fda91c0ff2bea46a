"""Near-duplicates against all pairs; signatures against the similarity they estimate."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from barorail.llm.graph import components
from barorail.llm import minhash
from barorail.llm.minhash import counted_elements, dart_signatures, near_duplicates, shingles, similarities


def classes_of(pairs, ids):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {i: root(i) for i in ids}


def plain_classes(texts, words=5, similarity=0.8):
    bags = {}
    for i, text in texts.items():
        w = (text or "").split()
        n = min(words, len(w))
        bags[i] = Counter(tuple(w[j : j + n]) for j in range(len(w) - n + 1)) if n else Counter()
    holders = defaultdict(list)
    for i, bag in bags.items():
        for s in bag:
            holders[s].append(i)
    links = set()
    for i, bag in bags.items():
        for j in {j for s in bag for j in holders[s] if j < i}:
            low, high = (bag & bags[j]).total(), (bag | bags[j]).total()
            if low / high >= similarity:
                links.add((j, i))
    return classes_of(links, texts)


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(3)
    elements = rng.integers(0, 2**64, 300, dtype=np.uint64)
    for top in (2, 40):
        a = rng.integers(0, top, 300)
        b = np.where(rng.random(300) < 0.7, a, rng.integers(0, top, 300))
        sets = [(elements[w > 0], w[w > 0]) for w in (a, b)]
        one, two = dart_signatures(sets, 4000)
        assert abs((one == two).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.03
    tiny = [(elements[:1], np.array([1])), (elements[:1], np.array([10**6]))]
    assert (dart_signatures(tiny, 64) != 0).all()
    alone = dart_signatures(sets[:1], 64)
    assert (dart_signatures(sets, 64)[0] == alone[0]).all()


def test_shingles():
    assert len(shingles("a b c", 5)[0]) == 1 and len(shingles(" \n", 5)[0]) == 0
    elements, counts = shingles("a b a b a b", 2)
    assert len(elements) == 2 and sorted(counts) == [2, 3]


def test_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(230)] + [(i, i + 1) for i in range(1000, 1060)]
    pairs += [(2000, i) for i in range(2001, 2100)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    ids = {i for a, b in pairs if a != b for i in (a, b)}
    assert got == classes_of(pairs, ids)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def result(df):
    rows = df.collect()
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in rows)
    assert len({r["doc_id"] for r in rows}) == len(rows)
    return {r["doc_id"]: r["class_id"] for r in rows}


def test_table_against_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert result(near_duplicates(docs)) == plain_classes(texts)


def test_similarities():
    rng = np.random.default_rng(4)
    bags = [Counter(rng.integers(0, 30, rng.integers(1, 60)).tolist()) for _ in range(40)]
    sets = []
    for bag in bags:
        items = sorted(bag.items())
        sets.append(counted_elements(np.array([k for k, _ in items], np.uint64), np.array([v for _, v in items])))
    got = similarities(sets)
    for i, a in enumerate(bags):
        for j, b in enumerate(bags):
            assert i == j or abs(got[i, j] - (a & b).total() / (a | b).total()) < 1e-12


@pytest.mark.parametrize("group", [256, 7])
def test_groups_with_many_classes_in_a_bucket(spark, monkeypatch, group):
    monkeypatch.setattr(minhash, "GROUP", group)
    rng = random.Random(12)
    words = [f"w{i}" for i in range(5000)]
    texts, n = {}, 0
    for group in range(3):
        base = [rng.choice(words) for _ in range(120)]
        for _ in range(45):
            copy = list(base)
            for _ in range(rng.randint(0, 7)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts[1000 - n] = " ".join(copy)
            n += 1
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = plain_classes(texts)
    assert len(set(want.values())) > 4
    got = result(near_duplicates(df))
    # A link just above the threshold may be missed with a small probability.
    assert sum(got[i] != want[i] for i in texts) <= 2


def test_odd_tables(spark):
    long = " ".join(f"v{i}" for i in range(20_000))
    rows = [(5, "a b c d e f", "x"), (5, "a b c d e f", "x"), (3, "a  b c\td e f", "x"), (9, None, "x"), (8, "", "x")]
    rows += [(7, "one two", "x"), (6, "one two", None), (2, long, "x"), (1, long + " more", "x"), (4, " \n ", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, key string")
    assert result(near_duplicates(df)) == {5: 3, 3: 3, 9: 9, 8: 8, 7: 6, 6: 6, 2: 1, 1: 1, 4: 4}
    with_null = df.union(spark.createDataFrame([(None, "one two", "x")], df.schema))
    rows = near_duplicates(with_null).where("doc_id IS NULL").collect()
    assert [(r["class_id"], r["kept"]) for r in rows] == [(None, True)]
    assert near_duplicates(df.limit(0)).collect() == []


def test_every_text_of_an_id_links(spark):
    one, two = (" ".join(f"{c}{i}" for i in range(30)) for c in "ab")
    rows = [(5, one), (5, two), (3, one), (4, two), (9, "c d e"), (9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for docs in (df, df.union(df)):
        assert result(near_duplicates(docs)) == {5: 3, 3: 3, 4: 3, 9: 9}


def test_only_shingles_that_are_asked_for_move(spark):
    known = spark.range(1_000).selectExpr("id AS doc_id", "CAST(unhex('0100000000000000') AS binary) AS elements")
    pairs = spark.createDataFrame([(3, 900), (5, 6)], "a long, b long")
    found = minhash._links(pairs, known, 0.8)
    assert sorted(map(tuple, found.collect())) == [(3, 900), (5, 6)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan


def test_shingles_move_only_where_a_block_compares_them(spark, monkeypatch):
    """Two texts of different classes share every bucket and meet once; a third is too long to be like either."""
    moved = []
    groups = minhash.map_groups

    def watched(df, *rest):
        if "elements" in df.columns:
            moved.extend(r["doc_id"] for r in df.select("doc_id").collect())
        return groups(df, *rest)

    monkeypatch.setattr(minhash, "map_groups", watched)
    one = np.arange(1, 101, dtype=np.uint64)
    sets = {1: one, 2: np.append(one[:95], np.arange(500, 505, dtype=np.uint64)), 3: np.arange(1, 401, dtype=np.uint64)}
    texts = [(i, len(s), list(range(10, 34))) for i, s in sets.items()]
    texts = spark.createDataFrame(texts, "doc_id long, weight long, keys array<bigint>")
    known = spark.createDataFrame([(i, s.tobytes()) for i, s in sets.items()], "doc_id long, elements binary")
    classes = spark.createDataFrame([], "id long, component long")
    found = minhash._cross_links(texts, classes, known, 0.8)
    assert sorted({*moved}) == [1, 2] and len(moved) <= 3
    assert {tuple(sorted(r)) for r in found.collect() if r["a"] != r["b"]} == {(1, 2)}


def test_members_of_keys_move_once(spark):
    members = [(d, k) for k in range(40) for d in range(100) if (7 * d + 3 * k) % 31 < k % 3]
    members += [(100 + k, 1000 + k) for k in range(50)]
    found = minhash.shared_keys(spark.createDataFrame(members, "doc_id long, key long"))
    holders = defaultdict(list)
    for d, k in members:
        holders[k].append(d)
    want = {(k, d, min(own)) for k, own in holders.items() if len(own) > 1 for d in own}
    assert sorted((r["key"], r["doc_id"], r["low"]) for r in found.collect()) == sorted(want)
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in plan and plan.count("+- Exchange ") == 1
