"""Best-fit packing: documents as token pieces into sequences of one length, by best-two-fit."""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import CACHED_CHARS, SPACE, byte_letters
from .common import kept, map_rows, saved, small_batches
from .hashing import Recent
from .merging import Merges

CHUNK = re.compile(rf"[^{SPACE}]+")
#: Separators that str.split takes for white space and the tokenizer does not.
SEPARATORS = re.compile("[\x1c-\x1f]")
END_ID = 1
#: Entries of a generation of a worker's memory: both generations come to some 150 MB.
WORDS_KEPT = 300_000
#: Characters of the texts that are encoded at once.
BLOCK = 4_000_000
#: Words that are merged at once.
WORDS_MERGED = 16_384
#: Up to here letters have one simple lower case and no other spelling.
SIMPLE = chr(0x130)
COMPLEX = re.compile(f"[{SIMPLE}-{chr(0x10FFFF)}]")
#: Fixed by the vocabulary: how it splits words.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _simple_split() -> re.Pattern:
    """``SPLIT`` for lower-case text of simple characters: letters, the most frequent kind, are tried first.

    What begins with letters, with a number and with other characters excludes each other.
    """
    simple = [chr(c) for c in range(ord(SIMPLE))]
    letters = "".join(c for c in simple if unicodedata.category(c)[0] == "L")
    numbers = "".join(c for c in simple if unicodedata.category(c)[0] == "N")
    return re.compile(rf"[{letters}]+|[{numbers}]|'(?:s|t|re|ve|m|ll|d)|[^{SPACE}{letters}{numbers}]+")


LETTER, NUMBER, MARK, ODD = range(4)


def _kind(code: int) -> int:
    if code == ord("'") or code >= ord(SIMPLE):
        return ODD  # may begin a word of the rule's own, or has another spelling
    return {"L": LETTER, "N": NUMBER}.get(unicodedata.category(chr(code))[0], MARK)


#: Of each simple character, and of all others, how words are told apart by it.
KINDS = np.array([_kind(c) for c in range(ord(SIMPLE) + 1)], np.int8)


def _simple(word: str) -> bool:
    return word.isascii() or max(word) < SIMPLE


class WordTokenizer:
    """Token ids by a tokenizer of the tokenizers library that drops white space and case.

    Strings of simple characters between white space are split as the tokenizer splits them, in lower case,
    and their words merged here, those of many texts at a time. What is long, has an apostrophe or other
    characters goes through the library, bounded by white space, unless it was met lately. Strings of special
    tokens are cut out first, as the library does.
    """

    def __init__(self, config: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(config)
        self.special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.words = Recent(WORDS_KEPT)
        self._learn(json.loads(config))

    def _learn(self, told: dict) -> None:
        """The merges of a byte-level BPE whose words end in letters of their own, if this is one."""
        self.split = None  # everything goes through the library
        model, suffix, letters = told["model"], told["model"].get("end_of_word_suffix"), byte_letters()
        odd = any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "ignore_merges"))
        steps = (told.get("pre_tokenizer") or {}).get("pretokenizers", [])
        lower = [n["type"] for n in (told.get("normalizer") or {}).get("normalizers", [])]
        splits = [s["pattern"].get("Regex") for s in steps if s["type"] == "Split"]
        if model["type"] != "BPE" or not suffix or odd or splits != [SPLIT] or lower != ["NFC", "Replace", "Lowercase"]:
            return
        vocabulary = model["vocab"]
        if all(c in vocabulary and c + suffix in vocabulary for c in letters):
            self.split = _simple_split()
            self.inner, self.last = np.zeros(256, np.int64), np.zeros(256, np.int64)
            for letter, byte in letters.items():
                self.inner[byte], self.last[byte] = vocabulary[letter], vocabulary[letter + suffix]
            pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
            made = [(vocabulary[a], vocabulary[b], rank, vocabulary[a + b]) for rank, (a, b) in enumerate(pairs)]
            self.merges = Merges(made)

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        return next(self.encode_all([text]))

    def encode_all(self, texts: list[str]) -> Iterator[bytes]:
        """``encode`` of many texts: strings are numbered by Arrow, and each different one is looked up once."""
        bare = [self._is_bare(text) for text in texts]
        lower = pa.array([t.lower() for t, b in zip(texts, bare) if b], pa.string())
        others = pa.array([self._words(t) for t, b in zip(texts, bare) if not b], pa.list_(pa.string()))
        listed = pa.concat_arrays([pc.utf8_split_whitespace(lower), others])
        numbered = listed.values.dictionary_encode()
        values, starts, sizes = self._ids_of(numbered.dictionary)
        string = numbered.indices.to_numpy()
        length = sizes[string]
        ends = np.cumsum(length)
        place = np.repeat(starts[string] - (ends - length), length)
        place += np.arange(len(place))
        values = values[place]
        cuts = np.append(0, ends)[listed.offsets.to_numpy()].tolist()
        found = [values[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
        of_bare, of_other = iter(found[: len(lower)]), iter(found[len(lower) :])
        for b in bare:
            yield next(of_bare if b else of_other)

    def _is_bare(self, text: str) -> bool:
        """Whether a text is of simple characters, without special tokens, and bounded by what both call white space."""
        return (
            self.split is not None
            and (text.isascii() or not COMPLEX.search(text))
            and not any(s in text for s in "\x1c\x1d\x1e\x1f")
            and not any(s in text for s in self.special)
        )

    def _ids_of(self, strings: pa.StringArray) -> tuple[np.ndarray, ...]:
        """Ids of different strings, and where those of each begin and how many they are."""
        if not len(strings):
            return np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64)
        ends = np.frombuffer(strings.buffers()[1], np.int32)[strings.offset :][: len(strings) + 1].astype(np.int64)
        codes = np.frombuffer(strings.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
        lengths, ends = np.diff(ends), ends - ends[0]
        kind = self._kinds(codes)
        odd = np.diff(np.append(0, np.cumsum(kind == ODD))[ends]) > 0
        odd |= lengths > CACHED_CHARS
        odd[pc.index_in(pa.array(list(self.special), pa.string()), strings).drop_null().to_numpy()] = True
        if not self.split:
            odd[:] = True
        values, starts, sizes = self._merged(codes, kind, ends, odd)
        rest = np.flatnonzero(odd)
        ids = self._remembered(strings.take(pa.array(rest)).to_numpy(zero_copy_only=False).tolist())
        sizes[rest] = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        starts[rest] = len(values) + np.cumsum(sizes[rest]) - sizes[rest]
        return np.concatenate([values, np.frombuffer(b"".join(ids), "<u4")]), starts, sizes

    def _kinds(self, codes: np.ndarray) -> np.ndarray:
        """For each byte of UTF-8 what ``KINDS`` says of its character."""
        after = np.append(codes[1:], 0).astype(np.int64)
        point = np.where(codes < 0x80, codes, ((codes.astype(np.int64) & 0x1F) << 6) | (after & 0x3F))
        kind = KINDS[np.where(codes < 0xE0, point, ord(SIMPLE)).clip(max=ord(SIMPLE))]
        further = np.flatnonzero((codes & 0xC0) == 0x80)
        kind[further] = kind[further - 1]  # of longer characters all bytes but the second and third are odd already
        return kind

    def _merged(
        self, codes: np.ndarray, kind: np.ndarray, ends: np.ndarray, odd: np.ndarray
    ) -> tuple[np.ndarray, ...]:
        """``_ids_of`` the strings that are not ``odd``: all their words are merged side by side."""
        sizes = np.zeros(len(odd), np.int64)
        if odd.all():
            return np.zeros(0, "<u4"), sizes.copy(), sizes
        begins = np.ones(len(codes), bool)
        begins[1:] = kind[1:] != kind[:-1]
        begins |= (kind == NUMBER) & ((codes & 0xC0) != 0x80)
        begins[ends[:-1][ends[:-1] < len(codes)]] = True
        kept_codes = np.repeat(~odd, np.diff(ends))
        of = np.repeat(np.arange(len(odd)), np.diff(ends))[kept_codes]
        codes, begins = codes[kept_codes], begins[kept_codes]
        first = np.flatnonzero(begins)
        width = np.diff(np.append(first, len(codes)))
        last = first + width - 1
        symbol = self.inner[codes]
        symbol[last] = self.last[codes[last]]
        made = []
        for low in range(0, len(first), WORDS_MERGED):
            high = min(low + WORDS_MERGED, len(first))
            part = symbol[first[low] : last[high - 1] + 1]
            made += [(n + low, ids) for n, ids in self.merges.apply_by_width(part, width[low:high])]
        count = np.zeros(len(first), np.int64)
        for n, ids in made:
            count[n] = ids.shape[1]
        at = np.cumsum(count) - count
        values = np.zeros(int(count.sum()), "<u4")
        for n, ids in made:
            values[at[n][:, None] + np.arange(ids.shape[1])] = ids
        sizes = np.bincount(of[first], weights=count, minlength=len(odd)).astype(np.int64)
        return values, np.cumsum(sizes) - sizes, sizes

    def _remembered(self, strings: list[str]) -> list[bytes]:
        """Ids of different strings by the library, but for those met lately."""
        parts = [self._parts(string) for string in strings]
        known = self.words.renewed()
        long = self._look_up({w for words in parts for w in words if w not in known}, known)
        out = [known[words[0]] if len(words) == 1 else b"".join(map(known.__getitem__, words)) for words in parts]
        for word in long:
            del known[word]
        return out

    def _parts(self, string: str) -> list[str]:
        """The words of a string of simple characters; any other string as it stands."""
        if not self.split or string in self.special or not _simple(string):
            return [string]
        return self.split.findall(string)

    def _words(self, text: str) -> list[str]:
        """Strings that are encoded for themselves: of simple characters in lower case, or as they stand."""
        if self.cut is not None and any(s in text for s in self.special):
            parts = self.cut.split(text)
            return [w for i, p in enumerate(parts) for w in ([p] if i % 2 else self._words(p))]
        if self.split and (text.isascii() or not COMPLEX.search(text)):
            return self.split.findall(text.lower())
        chunks = CHUNK.findall(text) if SEPARATORS.search(text) else text.split()
        if not self.split:
            return chunks
        return [w for c in chunks for w in (self.split.findall(c.lower()) if max(c) < SIMPLE else [c])]

    def _look_up(self, words: set[str], known: dict[str, bytes]) -> list[str]:
        """Put the ids of ``words`` into ``known``; those that are too long to stay there are given back."""
        earlier = self.words.old
        new = [w for w in words if w not in earlier]
        known.update((w, earlier[w]) for w in words.difference(new))
        known.update(zip(new, self._encoded(new)))
        return [w for w in new if len(w) > CACHED_CHARS]

    def _encoded(self, texts: list[str]) -> list[bytes]:
        coded = self.library.encode_batch_fast(texts, add_special_tokens=False) if texts else []
        return [np.array(e.ids, "<u4").tobytes() for e in coded]


def _encoded(tokenizer: WordTokenizer, texts: list[str | None]) -> Iterator[bytes]:
    held, load = [], 0
    for text in texts:
        held.append(text or "")
        load += len(held[-1])
        if load >= BLOCK:
            yield from tokenizer.encode_all(held)
            held, load = [], 0
    yield from tokenizer.encode_all(held)


def coded(ids: bytes) -> bytes:
    """Little-endian ids of 32 bits in 16 bits each, if all of them fit; ``decoded`` is told how many they are."""
    values = np.frombuffer(ids, "<u4")
    return values.astype("<u2").tobytes() if values.max() < 2**16 else ids


def decoded(ids: bytes, length: int) -> np.ndarray:
    return np.frombuffer(ids, f"<u{len(ids) // length}").astype("<u4", copy=False)


def _pieces(docs: DataFrame, tokenizer_file: str, capacity: int, keep_ids: bool) -> DataFrame:
    """``token_pieces`` with their ids ``coded``."""
    with open(tokenizer_file, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())  # its size is that of the vocabulary

    def rows(doc_ids, texts) -> Iterator[tuple]:
        tokenizer = kept(("word tokenizer", zlib.crc32(shared.value.encode())), lambda: WordTokenizer(shared.value))
        end = np.array([END_ID], "<u4").tobytes()
        for doc_id, ids in zip(doc_ids, _encoded(tokenizer, texts)):
            ids += end
            for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[at : at + 4 * capacity]
                told = doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)
                yield (*told, coded(part)) if keep_ids else told

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    return map_rows(docs.select("doc_id", "text"), rows, schema + ", ids binary" * keep_ids, keeps=True)


def listed_ids(pieces: DataFrame) -> DataFrame:
    """``pieces`` with their ``coded`` ids as array<int>."""
    small_batches(pieces.sparkSession)
    names = pieces.columns
    at, length_at = names.index("ids"), names.index("length")
    fields = [T.StructField("ids", T.ArrayType(T.IntegerType())) if f.name == "ids" else f for f in pieces.schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                columns = list(batch.columns)
                ids = [decoded(*x) for x in zip(columns[at].to_pylist(), columns[length_at].to_pylist())]
                ends = np.cumsum([0, *map(len, ids)])
                values = pa.array(np.concatenate(ids).astype(np.int32))
                columns[at] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return pieces.mapInArrow(run, T.StructType(fields))


def token_pieces(docs: DataFrame, tokenizer_file: str, capacity: int = 4096, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, and with ``keep_ids`` the ids, of every document.

    A document is its ids and then END_ID; what is longer than ``capacity`` is cut into pieces of that
    many, the last one shorter. A NULL or empty text is the END_ID alone. Repeated rows are documents of
    their own, other columns are ignored, an empty table gives no rows.
    """
    pieces = _pieces(docs, tokenizer_file, capacity, keep_ids)
    return listed_ids(pieces) if keep_ids else pieces


class Stock:
    """Lengths not packed yet. ``floor[g]`` is the largest of them up to g, 0 if there is none."""

    def __init__(self, lengths: np.ndarray, capacity: int):
        self.count = np.bincount(lengths, minlength=capacity + 1)
        every = np.arange(capacity + 1)
        self.floor = np.maximum.accumulate(np.where(self.count > 0, every, 0))

    def take(self, length: int) -> None:
        self.count[length] -= 1
        if not self.count[length]:
            stop = np.searchsorted(self.floor, length, side="right")
            self.floor[length:stop] = self.floor[length - 1]

    def put(self, length: int) -> None:
        self.count[length] += 1
        if self.count[length] == 1:
            stop = np.searchsorted(self.floor, length, side="right")
            self.floor[length:stop] = length

    def best_two(self, gap: int, above: int) -> tuple[int, int] | None:
        """The two lengths of largest sum above ``above`` and up to ``gap``."""
        first = np.flatnonzero(self.count[:gap])
        if not len(first):
            return None
        second = self.floor[gap - first]
        alone = (second == first) & (self.count[first] == 1)
        second = np.where(alone, self.floor[np.maximum(first - 1, 0)], second)
        total = np.where(second > 0, first + second, 0)
        best = int(total.argmax())
        return (int(first[best]), int(second[best])) if total[best] > above else None


def best_two_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every length, none above ``capacity``.

    Bins are filled one after the other: always the longest that fits; then, if room is left, the
    shortest of the bin gives way to the two of the rest that fill its place and the room best, if they
    fill more.
    """
    stock = Stock(lengths, capacity)
    order = np.argsort(lengths, kind="stable")
    at = np.concatenate([[0], np.cumsum(np.bincount(lengths, minlength=capacity + 1))])
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    packed, number = 0, 0
    while packed < len(lengths):
        gap, held = capacity, []
        while length := int(stock.floor[gap]):
            stock.take(length)
            held.append(length)
            gap -= length
        if gap and len(held) > 1:
            pair = stock.best_two(gap + held[-1], held[-1])
            if pair:
                for length in pair:
                    stock.take(length)
                stock.put(held.pop())
                held += pair
        offset = 0
        for length in held:
            row = order[at[length]]
            at[length] += 1
            bins[row], offsets[row] = number, offset
            offset += length
        packed += len(held)
        number += 1
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = 4096, group_rows: int = 20_000) -> DataFrame:
    """``pieces`` with sequence_id and offset.

    The pieces are dealt evenly to groups of about ``group_rows``, each packed for itself; a group leaves
    one or two sequences part empty, of the thousands it fills. Pass a saved table: it is read twice.
    """
    parts = max(1, round(pieces.count() / group_rows))
    dealt = pieces.withColumn("_group", F.pmod(F.monotonically_increasing_id(), F.lit(parts)))

    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        bins, offsets = best_two_fit(rows["length"].to_numpy(), capacity)
        out = rows.drop(columns="_group")
        return out.assign(sequence_id=(int(key[0]) << 32) + bins, offset=offsets)

    schema = pieces.schema.add("sequence_id", "long").add("offset", "long")
    return dealt.groupBy("_group").applyInPandas(run, schema)


def pack_documents(
    docs: DataFrame, tokenizer_file: str, capacity: int = 4096, keep_ids: bool = False, as_coded: bool = False
) -> DataFrame:
    """Pieces of all documents (see ``token_pieces``) with the sequence and the place each one got.

    Only lengths are gathered to be packed; ids stay with the written pieces and meet their places by a join,
    ``coded``, which is half as much. They come out as array<int>, or ``as_coded`` as they were stored.
    """
    pieces = _pieces(docs, tokenizer_file, capacity, keep_ids)
    if not keep_ids:
        return pack(saved(pieces, "pieces"), capacity)
    pieces = saved(pieces.withColumn("_piece", F.monotonically_increasing_id()), "pieces")
    places = saved(pack(pieces.select("_piece", "length"), capacity).drop("length"), "places")
    told = [c for c in pieces.columns if c not in ("_piece", "ids")]
    packed = pieces.join(places, "_piece").select(*told, "sequence_id", "offset", "ids")
    return packed if as_coded else listed_ids(packed)


def packed_digests(packed: DataFrame) -> DataFrame:
    """Pieces that were packed with their ids, with ids_crc32 taken from those ids, listed or coded, in their place."""
    names = [c for c in packed.columns if c != "ids"]
    struct = packed.select(*names).schema
    at, length_at = names.index("ids_crc32"), names.index("length")
    binary = packed.schema["ids"].dataType == T.BinaryType()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *columns, ids = batch.columns
            if binary:
                parts = [decoded(*x) for x in zip(ids.to_pylist(), columns[length_at].to_pylist())]
            else:
                values, ends = ids.values.to_numpy().astype("<i4", copy=False), ids.offsets.to_pylist()
                parts = [values[a:b] for a, b in zip(ends, ends[1:])]
            columns[at] = pa.array([zlib.crc32(part.tobytes()) for part in parts], pa.int64())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return packed.select(*names, "ids").mapInArrow(run, struct)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and ids of whole sequences, from pieces that were packed with their ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
