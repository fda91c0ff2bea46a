"""Packing: ids as the library gives them, valid sequences, few of them."""

import random
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from barorail.llm import packing
from barorail.llm.packing import WordTokenizer, best_two_fit, pack, pack_documents, sequences

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids(library):
    own = WordTokenizer(open(PATH, encoding="utf-8").read())
    rng = random.Random(2)
    letters = " \n\t\x1c\x1f\x85\xa0 　aAbBééßİΣ'sdmre12٣Ⅷ#$.,<|>\U0001f600中\x00"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(2000)]
    texts += ["", "<|endoftext|>", "a<|startoftext|>B <|endoftext|", "x" * 3000]
    texts += pd.read_parquet("/root/testdata/sf0.01/documents.parquet")["text"].tolist()
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.encode(text), "<u4").tolist() == want, repr(text)


def test_strings_of_simple_characters_need_no_library(library, monkeypatch):
    own = WordTokenizer(open(PATH, encoding="utf-8").read())
    rng = random.Random(5)
    letters = "aAbtheßÉ²ªº09#$.,<|>-\xad\x85\xa0\x00\u012f \n\t"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["", "  ", "The 12:30 train, (delayed); no. 7!", "a" * 64, "é" * 32]

    def refuse(strings):
        assert not strings, strings
        return []

    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    with monkeypatch.context() as m:
        m.setattr(own, "_encoded", refuse)
        assert [np.frombuffer(ids, "<u4").tolist() for ids in own.encode_all(texts)] == want
    texts = ["rock'n'roll it's \"'s 'tis", "x" * 65 + "'", "it\u2019s \u4e2d. a,b", "a\x1cb.", "<|endoftext|>.", "", "ok, ok."]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in own.encode_all(texts)] == want
    assert list(own.encode_all([])) == []


def plain(lengths, capacity):
    """Best-two-fit over plain lists: the bins' contents."""
    rest, bins = sorted(lengths, reverse=True), []
    while rest:
        held, gap = [], capacity
        while any(x <= gap for x in rest):
            x = max(x for x in rest if x <= gap)
            rest.remove(x)
            held.append(x)
            gap -= x
        if gap and len(held) > 1:
            s = held[-1]
            sums = [a + b for i, a in enumerate(rest) for b in rest[i + 1 :] if s < a + b <= gap + s]
            if sums:
                best = max(sums)
                a, b = next((a, b) for i, a in enumerate(rest) for b in rest[i + 1 :] if a + b == best)
                held.pop()
                rest.remove(a)
                rest.remove(b)
                rest = sorted([*rest, s], reverse=True)
                held += [a, b]
        bins.append(sum(held))
    return bins


def check(lengths, bins, offsets, capacity):
    for b in np.unique(bins):
        rows = np.flatnonzero(bins == b)
        rows = rows[np.argsort(offsets[rows])]
        assert offsets[rows].tolist() == [0, *np.cumsum(lengths[rows])[:-1]]
        assert lengths[rows].sum() <= capacity


def test_against_plain_lists():
    rng = np.random.default_rng(6)
    for _ in range(150):
        lengths = rng.integers(1, 40, rng.integers(0, 60))
        bins, offsets = best_two_fit(lengths, 40)
        check(lengths, bins, offsets, 40)
        want = plain(lengths.tolist(), 40)
        assert len(set(bins.tolist())) <= len(want) + 1 and (len(lengths) == 0 or bins.max() + 1 == len(set(bins.tolist())))


def test_few_sequences():
    rng = np.random.default_rng(8)
    lengths = np.minimum(rng.lognormal(6, 1.2, 20_000).astype(int) + 1, 4096)
    bins, offsets = best_two_fit(lengths, 4096)
    check(lengths[:0], bins[:0], offsets[:0], 4096)
    assert bins.max() + 1 <= 1.001 * lengths.sum() / 4096 + 1


def test_whole_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = pack_documents(docs, PATH).toPandas().sort_values(["doc_id", "piece"])
    for r, text in docs.toPandas()[["doc_id", "text"]].itertuples(index=False):
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 1], "<u4")
        rows = got[got.doc_id == r]
        assert rows.length.sum() == len(ids) and (rows.length.iloc[:-1] == 4096).all()
        for row in rows.itertuples():
            assert zlib.crc32(ids[row.start : row.start + row.length].tobytes()) == row.ids_crc32
    check(*(got[c].to_numpy() for c in ("length", "sequence_id", "offset")), 4096)
    assert got.sequence_id.nunique() <= got.length.sum() / 4096 + 2


def test_groups_and_files(spark, library):
    texts = ["a b", None, "", "c " * 5000, "a b"]
    docs = spark.createDataFrame([(i % 3, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, length long")
    packed = pack_documents(docs, PATH, keep_ids=True)
    assert packed.count() == 6
    tokens = sum(len(r["ids"]) for r in sequences(packed).collect())
    assert tokens == 5 + sum(len(library.encode(t or "", add_special_tokens=False).ids) for t in texts)
    assert pack_documents(docs.limit(0), PATH).collect() == []
    many = spark.range(5000).selectExpr("id AS doc_id", "0 AS piece", "1 + id % 300 AS length")
    got = pack(many, 1000, 500).toPandas()
    check(*(got[c].to_numpy() for c in ("length", "sequence_id", "offset")), 1000)
    assert got.sequence_id.nunique() <= got.length.sum() / 1000 + 10


def test_ids_are_stored_in_as_few_bytes_as_they_need(spark, library):
    docs = spark.createDataFrame([(1, "The train leaves at noon."), (2, None)], "doc_id long, text string")
    found = pack_documents(docs, PATH, keep_ids=True, as_coded=True)
    assert found.schema["ids"].dataType.simpleString() == "binary"
    for row in found.collect():
        assert len(row["ids"]) == 2 * row["length"]
        assert zlib.crc32(packing.decoded(row["ids"], row["length"]).tobytes()) == row["ids_crc32"]
    for ids in ([65535, 0, 7], [65536, 0, 7]):
        stored = packing.coded(np.array(ids, "<u4").tobytes())
        assert len(stored) == (6 if max(ids) < 2**16 else 12) and packing.decoded(stored, 3).tolist() == ids
    listed = {r["doc_id"]: r["ids"] for r in packing.token_pieces(docs, PATH, keep_ids=True).collect()}
    assert listed == {1: [*library.encode("The train leaves at noon.", add_special_tokens=False).ids, 1], 2: [1]}
