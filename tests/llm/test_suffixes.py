"""Repeated passages against hashing every window plainly."""

import random
from collections import defaultdict

import pytest

from barorail.llm import suffixes as S
from barorail.llm.suffixes import cut_passages, repeated_passages


def plain(texts, length):
    places = defaultdict(list)
    for i, text in sorted(texts.items()):
        words = (text or "").split()
        for at in range(len(words) - length + 1):
            places[tuple(words[at : at + length])].append((i, at))
    covered = defaultdict(set)
    for found in places.values():
        first = found[0]
        copy = [i != first[0] or at >= first[1] + length for i, at in found]
        if any(copy):
            for (i, at), c in zip(found, copy):
                covered[i, c].update(range(at, at + length))
    out = []
    for (i, c), words in covered.items():
        for w in sorted(words):
            if w - 1 not in words:
                start = w
            if w + 1 not in words:
                out.append((i, start, w + 1, c))
    return sorted(out)


def got(spark, texts, length, spread):
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    return sorted(tuple(r) for r in repeated_passages(df, length, spread, 3).collect())


def made_up(seed, words=40, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    blocks = [[rng.choice(vocabulary) for _ in range(rng.randint(5, 40))] for _ in range(12)]
    texts = {}
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 6)):
            kind = rng.random()
            block = rng.choice(blocks)
            if kind < 0.5:
                a = rng.randrange(len(block))
                parts += block[a : rng.randint(a, len(block))]
            elif kind < 0.6:
                parts += [rng.choice(vocabulary)] * rng.randint(1, 60)
            elif kind < 0.7:
                parts += block[: rng.randint(1, 3)] * rng.randint(1, 20)
            else:
                parts += [rng.choice(vocabulary) for _ in range(rng.randint(1, 10))]
        texts[rng.randrange(10**6)] = " ".join(parts)
    return texts


@pytest.mark.parametrize("seed,group", [(1, 1000), (2, 1000), (3, 1), (4, 3)])
def test_against_every_window(spark, monkeypatch, seed, group):
    monkeypatch.setattr(S, "GROUP", group)  # few: the way for very common passages
    texts = made_up(seed)
    assert got(spark, texts, 12, 6) == plain(texts, 12)


def test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    want = plain(texts, 50)
    assert len(want) > 100
    assert sorted(tuple(r) for r in repeated_passages(docs).collect()) == want


def test_cutting(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    texts = {1: f"a b\n{passage}  c", 2: f"{passage}\t", 3: f"x  y {passage} é z", 4: " x  y ", 5: None, 6: ""}
    schema = "doc_id long, text string, n_chars long, start string"
    docs = spark.createDataFrame([(i, t, -1, "s") for i, t in texts.items()] + [(None, passage, 0, "s")], schema)
    out = cut_passages(docs, repeated_passages(docs))
    assert out.columns == docs.columns
    left = {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()}
    assert left[1][0] == texts[1] and left[2] == ("", 0) and left[3] == ("x  y é z", 8)
    assert left[4] == (" x  y ", 6) and left[5] == (None, None) and left[6] == ("", 0) and left[None][0] == passage


def test_odd_tables(spark):
    docs = spark.createDataFrame(
        [(1, "a " * 70, "x"), (1, "a " * 70, "x"), (2, "b " * 200, "x"), (3, None, "x"), (None, "a " * 90, "x")],
        "doc_id long, text string, copy string",
    )
    found = sorted(tuple(r) for r in repeated_passages(docs).collect())
    assert found == plain({2: "b " * 200}, 50)
    assert found[0][:3] == (2, 0, 99) and found[1] == (2, 50, 200, True)
    assert repeated_passages(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        repeated_passages(docs, 20, 15)
