"""SentencePiece encoding against the library: ids, spans and decoded texts, under several normalisers."""

import hashlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece

from barorail.llm.pieces import (
    LONG,
    CharacterMap,
    PieceModel,
    decode_pieces,
    encode_pieces,
    fields,
    piece_digests,
)

FILE = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "",
    " ",
    "   ",
    "a",
    " a  b   ",
    "tab\tand\nline\r\n",
    "▁ mark ▁▁x",
    "<s> </s> <unk> <0x41>",
    "日本語テキスト 𐍈x \U0001f600\U0001f600",
    "a" * 1000,
    "abcd efgh" * 300,
    "é́ é ﬁ Ⅷ ｱ",
    "\x00\x01",
    "�",
    "x" * (LONG + 1) + " " + "日" * (LONG + 5),
]


def _number(value: int) -> bytes:
    out = b""
    while value > 127:
        out += bytes([value & 127 | 128])
        value >>= 7
    return out + bytes([value])


def _message(entries) -> bytes:
    out = b""
    for number, value in entries:
        if isinstance(value, int):
            out += _number(number << 3) + _number(value)
        else:
            out += _number(number << 3 | 2) + _number(len(value)) + value
    return out


def changed(normalizer: dict[int, object] | None = None, trainer: dict[int, object] | None = None, extra=()) -> bytes:
    """The model file with other settings, and with pieces (text, score, kind) behind its own."""
    with open(FILE, "rb") as f:
        data = f.read()
    out = b""
    for number, value in fields(data):
        if number == 3:
            value = _message(({1: b"own", 3: 1, 4: 0} | (normalizer or {})).items())
        elif number == 2 and trainer:
            # Of a field that is there twice the last one counts.
            value += _message(trainer.items())
        out += _message([(number, value)])
    for text, score, kind in extra:
        piece = _message([(1, text.encode())]) + b"\x15" + np.float32(score).tobytes() + _message([(3, kind)])
        out += _message([(1, piece)])
    return out


def rule_map(rule: str) -> bytes:
    """The compiled character map of one of the library's own normalisers."""
    proto = sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto()
    return dict(fields(dict(fields(proto))[3]))[2]


def spans(library, text: str) -> list[tuple[int, int]]:
    told = library.encode(text, out_type="serialized_proto")
    pieces = [dict(fields(v)) for number, v in fields(told) if number == 2]
    return [(p.get(4, 0), p.get(5, 0)) for p in pieces]


def check(model: PieceModel, library, texts: list[str]) -> None:
    for text, (ids, bounds) in zip(texts, model.encode_all(texts)):
        assert ids.tolist() == library.encode(text), text
        assert list(zip(bounds[:-1].tolist(), bounds[1:].tolist())) == spans(library, text), text
        assert model.decode(ids.tolist()) == library.decode(ids.tolist()), text


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=FILE)


@pytest.fixture(scope="module")
def texts():
    found = pq.read_table("/root/testdata/sf0.001/documents.parquet").column("text")
    return [t or "" for t in found.to_pylist()]


def test_table(library, texts):
    check(PieceModel.from_file(FILE), library, ODD + texts)


@pytest.mark.parametrize("squeeze", [0, 1])
@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
def test_character_maps(texts, rule, squeeze):
    data = changed({2: rule_map(rule), 4: squeeze})
    check(PieceModel.from_bytes(data), sentencepiece.SentencePieceProcessor(model_proto=data), ODD + texts[:60])


@pytest.mark.parametrize("settings", [{3: 0}, {4: 1}, {3: 0, 4: 1}])
def test_white_space(settings):
    data = changed(settings)
    check(PieceModel.from_bytes(data), sentencepiece.SentencePieceProcessor(model_proto=data), ODD)


def test_without_byte_fallback(texts):
    # The library refuses pieces for bytes then; as ordinary pieces they stand for their own spelling.
    data = b""
    for number, value in fields(changed(trainer={35: 0})):
        if number == 1 and dict(fields(value)).get(3) == 6:
            value = value[:-2] + b"\x18\x01"
        data += _message([(number, value)])
    check(PieceModel.from_bytes(data), sentencepiece.SentencePieceProcessor(model_proto=data), ODD + texts[:40])


def test_pieces_of_a_user(texts):
    data = changed({2: rule_map("nmt_nfkc")}, extra=[("[cut]", 0.0, 4), ("[cut][cut]", 0.0, 4), ("xyz", 0.0, 4)])
    library = sentencepiece.SentencePieceProcessor(model_proto=data)
    odd = ["a[cut]b", "[cut][cut][cut]", "wxyz xyzxyz", "[cut", "é[cut]́", *ODD, *texts[:20]]
    check(PieceModel.from_bytes(data), library, odd)


def test_decoding_any_ids(library):
    model = PieceModel.from_file(FILE)
    rng = np.random.default_rng(3)
    for _ in range(300):
        ids = rng.integers(0, 32000 if rng.random() < 0.5 else 300, rng.integers(0, 12)).tolist()
        assert model.decode(ids) == library.decode(ids), ids


def test_longest_prefix():
    found = CharacterMap(rule_map("nmt_nfkc"))
    assert found.longest("ﬁx".encode(), 0) == (3, b"fi")
    assert found.longest("é".encode(), 0) == (3, "é".encode())
    assert found.longest(b"ex", 0) is None
    assert not CharacterMap(b"")


def test_long_runs_are_merged_alike():
    model = PieceModel.from_file(FILE)
    rng = np.random.default_rng(5)
    for _ in range(40):
        run = "".join(rng.choice(list("aeinrst▁日é"), rng.integers(2, 100)))
        assert model._coded(model._merged_long(run)) == model._merged_all([run])[0]


def test_other_models_are_refused():
    for data in (changed(trainer={3: 1}), changed({5: 0}), changed(extra=[("zz", 0.0, 5)])):
        with pytest.raises(ValueError):
            PieceModel.from_bytes(data)


def test_frames(spark, library):
    rows = [(1, "héllo wörld", "x"), (1, "héllo wörld", "y"), (None, None, "z"), (3, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    found = sorted(encode_pieces(docs, FILE).collect(), key=str)
    ids = library.encode("héllo wörld")
    pairs = spans(library, "héllo wörld")
    assert [(r.doc_id, r.ids) for r in found] == [(1, ids), (1, ids), (3, []), (None, [])]
    assert list(zip(found[0].starts, found[0].ends)) == pairs
    told = sorted(decode_pieces(encode_pieces(docs, FILE), FILE).collect(), key=str)
    assert [tuple(r) for r in told] == [(1, "héllo wörld"), (1, "héllo wörld"), (3, ""), (None, "")]
    digests = {r.doc_id: r for r in piece_digests(docs, FILE).collect()}
    assert digests[1].n_tokens == len(ids)
    assert digests[1].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert digests[1].decoded_sha256 == hashlib.sha256("héllo wörld".encode()).hexdigest()
    bounds = np.array([pairs[0][0], *(b for _, b in pairs)], "<u4").tobytes()
    assert digests[1].bounds_sha256 == hashlib.sha256(bounds).hexdigest()
    assert encode_pieces(docs.limit(0), FILE).collect() == piece_digests(docs.limit(0), FILE).collect() == []
