"""The automaton against the tokenizers library, and exact round trips."""

import hashlib
import random

import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from barorail.llm.bpe import BpeAutomaton, encode_texts, round_trip_digests

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def bpe():
    return BpeAutomaton.from_file(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_small_vocabularies_against_plain_merging():
    rng = random.Random(4)
    for _ in range(60):
        vocab, merges = {bytes([b]): b for b in range(256)}, []
        have = [b"a", b"b", b"c"]
        for _ in range(rng.randint(1, 14)):
            pair = rng.choice(have), rng.choice(have)
            if pair[0] + pair[1] not in vocab:
                vocab[pair[0] + pair[1]] = len(vocab)
                merges.append(pair)
                have.append(pair[0] + pair[1])
        bpe = BpeAutomaton.compile(vocab, merges, {})
        for _ in range(60):
            word = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 14)))
            parts = [word[i : i + 1] for i in range(len(word))]
            while True:
                ranked = [(merges.index(p), i) for i, p in enumerate(zip(parts, parts[1:])) if p in merges]
                if not ranked:
                    break
                i = min(ranked)[1]
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            assert [bpe.labels[t] for t in bpe.encode_word(word)] == parts, (merges, word)


def test_whole_texts(bpe, library):
    texts = pd.read_parquet("/root/testdata/sf0.01/documents.parquet")["text"].tolist()
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        got = bpe.encode(text)
        assert got == want.ids
        assert bpe.decode(got) == text


def test_every_token_of_the_vocabulary(bpe, library):
    texts = [label.decode("utf-8", "replace") for label in bpe.labels.values()]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert bpe.encode(text) == want.ids, text


def test_odd_texts(bpe, library):
    rng = random.Random(9)
    letters = " \n\t\r\x0b\x1c\x1f\x85\xa0 　aAbeé́ß'sdmre12٣Ⅷ½#$.,<|>\U0001f600中\x00﻿"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += ["<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|", " " * 300, "a" * 5000, "ab" * 2000, "  x", "it's  'S'LL"]
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        assert bpe.encode(text) == want, repr(text)
        assert bpe.decode(want) == library.decode(want, skip_special_tokens=False) == text


def test_tables(spark, bpe):
    docs = spark.createDataFrame(
        [(1, None, "x"), (1, None, "x"), (None, "", "y"), (2, "hello  wörld" * 9000, None)],
        "doc_id long, text string, ids string",
    )
    got = sorted(tuple(r) for r in round_trip_digests(docs, bpe).collect() if r["doc_id"])
    empty = hashlib.sha256(b"").hexdigest()
    assert got[:2] == [(1, 0, empty, empty)] * 2
    assert got[2][3] == hashlib.sha256(("hello  wörld" * 9000).encode()).hexdigest()
    assert sorted(len(r["ids"]) for r in encode_texts(docs, bpe).collect())[:3] == [0, 0, 0]
    assert round_trip_digests(docs.limit(0), bpe).collect() == []
