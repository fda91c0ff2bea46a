"""SentencePiece encoding that keeps every piece's place in the source, and decoding.

A text is normalised from left to right: where the compiled character map of the model has a key, the longest
one gives way to its replacement; everything else is copied. Beside the normalised text stands, for each of its
bytes, where in the source it came from, so a piece, which is a range of normalised bytes, becomes a range of
source bytes. Pieces come from merging: of all neighbours that make up a piece of the vocabulary those of the
highest score join, the leftmost of equal ones first.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
from pyspark.sql import DataFrame

from .common import kept, map_rows
from .hashing import Recent
from .merging import Merges, cut_runs

MARK = "▁"  # stands for a space
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = range(1, 7)
#: Longer runs of characters are merged for themselves, with a heap.
LONG = 128
#: Characters of the texts that are encoded at once.
BLOCK = 500_000
#: Entries of a generation of either memory of a worker, and the longest text remembered.
KEPT, KEPT_CHARS = 300_000, 48


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of the fields of a serialised message: integers, or bytes as they stand."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
            continue
        size = number() if tag & 7 == 2 else {1: 8, 5: 4}[tag & 7]
        yield tag >> 3, data[at : at + size]
        at += size


class CharacterMap:
    """A compiled character map: a double-array trie over UTF-8 bytes, and what its keys turn into.

    A unit of the trie holds a label (the byte that leads to it, or for a value the top bit), an offset to
    its children and whether a value is one of them; a child stands at the parent's place, its offset and
    the byte, joined by exclusive or.
    """

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if size else []
        self.strings = blob[4 + size :] if blob else b""

    def __bool__(self) -> bool:
        return bool(self.units)

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest key that stands there, and what it turns into."""
        found = None
        place = self._offset(self.units[0])
        for end in range(at, len(data)):
            place ^= data[end]
            unit = self.units[place]
            if unit & 0x800000FF != data[end]:
                break
            place ^= self._offset(unit)
            if unit & 0x100:
                found = end + 1, self.units[place] & 0x7FFFFFFF
        if found is None:
            return None
        end, text = found
        return end - at, self.strings[text : self.strings.index(b"\0", text)]

    def plain(self) -> bytes:
        """ASCII bytes that no key begins with, but for keys that go on with a byte above 0x7F."""
        if not self:
            return bytes(range(1, 128))
        root = self._offset(self.units[0])
        out = []
        for byte in range(1, 128):
            unit = self.units[root ^ byte]
            if unit & 0x800000FF == byte:
                place = root ^ byte ^ self._offset(unit)
                if unit & 0x100 or any(self.units[place ^ b] & 0x800000FF == b for b in range(1, 128)):
                    continue
            out.append(byte)
        return bytes(out)


def _each_byte(error):
    return "�", error.start + 1


codecs.register_error("barorail-each-byte", _each_byte)


@dataclass
class PieceModel:
    """A BPE model of the sentencepiece library. ``ranks`` orders pieces by falling score."""

    pieces: list[str]
    kinds: list[int]
    ranks: dict[str, int]
    ids: dict[str, int]
    charmap: CharacterMap
    dummy_prefix: bool
    squeeze: bool
    byte_fallback: bool
    unknown_surface: str
    chunks: Recent = field(default_factory=lambda: Recent(KEPT), repr=False)

    @classmethod
    def from_bytes(cls, data: bytes) -> PieceModel:
        """Read a model file; kinds of models that are not covered are refused."""
        listed: list[tuple[str, float, int]] = []
        specs: dict[int, dict] = {2: {}, 3: {}, 5: {}}
        for number, value in fields(data):
            if number == 1:
                piece = dict(fields(value))
                score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
                listed.append((piece.get(1, b"").decode(), score, piece.get(3, NORMAL)))
            elif number in specs:
                specs[number] = dict(fields(value))
        trainer, normalizer, denormalizer = specs[2], specs[3], specs[5]
        if trainer.get(3, 1) != 2:
            raise ValueError("not a BPE model")
        if trainer.get(24, 0) or not normalizer.get(5, 1) or denormalizer.get(2):
            raise ValueError("white space as a suffix or unescaped, and denormalising, are not covered")
        if any(kind == UNUSED for _, _, kind in listed):
            raise ValueError("unused pieces are not covered")
        order = {s: rank for rank, s in enumerate(sorted({s for _, s, _ in listed}, reverse=True))}
        return cls(
            pieces=[p for p, _, _ in listed],
            kinds=[k for _, _, k in listed],
            ranks={p: order[s] for p, s, k in listed if k in (NORMAL, USER)},
            ids={p: i for i, (p, _, k) in enumerate(listed) if k in (NORMAL, USER)},
            charmap=CharacterMap(normalizer.get(2, b"")),
            dummy_prefix=bool(normalizer.get(3, 1)),
            squeeze=bool(normalizer.get(4, 1)),
            byte_fallback=bool(trainer.get(35, 0)),
            unknown_surface=trainer.get(44, " ⁇ ".encode()).decode(),
        )

    @classmethod
    def from_file(cls, path: str) -> PieceModel:
        with open(path, "rb") as f:
            return cls.from_bytes(f.read())

    def __post_init__(self):
        self.unknown = self.kinds.index(UNKNOWN)
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if self.kinds[i] == BYTE}
        known = [p for p, k in zip(self.pieces, self.kinds) if k in (NORMAL, USER)]
        # Where no piece has a mark behind another character, no merge crosses such a place.
        bounded = not any(a != MARK and b == MARK for p in known for a, b in zip(p, p[1:]))
        self.chunk = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+" if bounded else r"(?s:.+)")
        user = sorted((p for p, k in zip(self.pieces, self.kinds) if k == USER), key=len, reverse=True)
        self.users = set(user)
        self.user = re.compile("(" + "|".join(map(re.escape, user)) + ")") if user else None
        self.user_bytes = re.compile(b"|".join(re.escape(p.encode()) for p in user)) if user else None
        plain = bytes(b for b in self.charmap.plain() if not (b == 0x20 and self.squeeze))
        self.plain = re.compile(b"(?:[" + re.escape(plain) + b"](?![\x80-\xff]))+")
        surfaces = [p.replace(MARK, " ").encode() for p in self.pieces]
        for i, kind in enumerate(self.kinds):
            if kind == BYTE:
                surfaces[i] = bytes([int(self.pieces[i][3:5], 16)])
            elif kind == CONTROL:
                surfaces[i] = b""
            elif kind == UNKNOWN:
                surfaces[i] = self.unknown_surface.encode()
        self.surfaces = surfaces

    def normalised(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its bytes and its end the place in the source's UTF-8 bytes."""
        data = text.encode("utf-8", "replace")
        if not data:
            return "", np.zeros(1, np.int64)
        if self.charmap or self.squeeze:
            return self._walked(data)
        source = np.frombuffer(data, np.uint8)
        places = np.repeat(np.arange(len(source)), np.where(source == 0x20, 3, 1))
        prefix = np.zeros(3 * self.dummy_prefix, np.int64)
        marked = MARK * self.dummy_prefix + data.decode().replace(" ", MARK)
        return marked, np.concatenate([prefix, places, [len(source)]])

    def _prefix(self, data: bytes, at: int) -> tuple[int, bytes]:
        """How many bytes come next, and what they turn into: a user's piece, a key of the map, a character."""
        if self.user_bytes and (match := self.user_bytes.match(data, at)):
            return match.end() - at, match[0]
        found = self.charmap.longest(data, at) if self.charmap else None
        if found:
            return found
        size = 1 if data[at] < 0xC0 else 2 if data[at] < 0xE0 else 3 if data[at] < 0xF0 else 4
        return size, data[at : at + size]

    def _walked(self, data: bytes) -> tuple[str, np.ndarray]:
        parts, places = [], []
        at, spaced = 0, self.squeeze
        while self.squeeze and at < len(data):
            size, turned = self._prefix(data, at)
            if turned != b" ":
                break
            at += size
        if at == len(data):
            return "", np.zeros(1, np.int64)
        mark = MARK.encode()
        if self.dummy_prefix:
            parts.append(mark)
            places.append(np.full(3, at))
        while at < len(data):
            run = None if self.user_bytes else self.plain.match(data, at)
            if run:
                turned, size = run[0], len(run[0])
                where = np.arange(at, at + size)
            else:
                size, turned = self._prefix(data, at)
                where = np.full(len(turned), at)
            if spaced:
                where = where[len(turned) - len(turned.lstrip(b" ")) :]
                turned = turned.lstrip(b" ")
            if turned:
                spaces = np.frombuffer(turned, np.uint8) == 0x20
                parts.append(turned.replace(b" ", mark))
                places.append(np.repeat(where, np.where(spaces, 3, 1)))
                spaced = turned.endswith(b" ")
            spaced = spaced and self.squeeze
            at += size
        whole, source = b"".join(parts), np.concatenate([*places, [at]])
        while self.squeeze and whole.endswith(mark):
            whole = whole[:-3]
            source = source[: len(whole) + 1]
        return whole.decode(), source

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids, and the places in the source's bytes where each piece begins and the last one ends.

        Of the bytes that spell an unknown character the last one stands for its source, the others for
        nothing, as does a piece that is made up by normalising.
        """
        return next(self.encode_all([text]))

    def encode_all(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``encode`` of many texts: what none of them has shown lately is merged at once."""
        normalised = [self.normalised(text) for text in texts]
        chunked = [self._chunks(marked) for marked, _ in normalised]
        find = self.chunks.new.get
        found = [[find(c) for c in chunks] for chunks in chunked]
        told = self._looked_up({c for cs, fs in zip(chunked, found) for c, f in zip(cs, fs) if f is None})
        for (_, source), chunks, known in zip(normalised, chunked, found):
            coded = b"".join([told[c] if f is None else f for c, f in zip(chunks, known)])
            pairs = np.frombuffer(coded, "<u4").reshape(-1, 2)
            ids, ends = pairs[:, 0], np.cumsum(pairs[:, 1], dtype=np.int64)
            if not self.byte_fallback:  # neighbouring unknown characters are one piece
                last = (ids != self.unknown) | np.append(ids[1:] != self.unknown, True)[: len(ids)]
                ids, ends = ids[last], ends[last]
            yield ids, source[np.concatenate([[0], ends])] if len(ids) else source[:1]

    def _chunks(self, marked: str) -> list[str]:
        """Parts of a normalised text that no merge crosses."""
        if not self.user:
            return self.chunk.findall(marked)
        parts = self.user.split(marked)
        return [c for i, p in enumerate(parts) for c in ([p] if i % 2 else self.chunk.findall(p))]

    def _looked_up(self, chunks: set[str]) -> dict[str, bytes]:
        """(id, normalised bytes) of the pieces of each chunk, as little-endian 32-bit numbers."""
        told, new = {}, []
        for chunk in chunks:
            coded = self.chunks.get(chunk)
            if coded is not None:
                told[chunk] = coded
            elif chunk in self.users:
                told[chunk] = struct.pack("<II", self.ids[chunk], len(chunk.encode()))
            elif len(chunk) > LONG:
                told[chunk] = self._coded(self._merged_long(chunk))
            else:
                new.append(chunk)
        told.update(zip(new, self._merged_all(new)))
        for chunk, coded in told.items():
            if len(chunk) <= KEPT_CHARS:
                self.chunks.put(chunk, coded)
        return told

    def _coded(self, parts: list[str]) -> bytes:
        told: list[int] = []
        for piece in parts:
            number, size = self.ids.get(piece), len(piece.encode())
            if number is not None:
                told += (number, size)
            elif self.byte_fallback:
                for byte in piece.encode():
                    told += (self.bytes[byte], 0)
                told[-1] = size
            else:
                told += (self.unknown, size)
        return struct.pack(f"<{len(told)}I", *told)

    @cached_property
    def letters(self) -> np.ndarray:
        """The piece that is a character, by code point; above all pieces the code point if there is none."""
        found = np.arange(0x110000) + len(self.pieces)
        for piece, number in self.ids.items():
            if len(piece) == 1:
                found[ord(piece)] = number
        return found

    @cached_property
    def merges(self) -> Merges:
        """Every pair of pieces that make up a piece."""
        return Merges(
            [
                (self.ids[p[:i]], self.ids[p[i:]], self.ranks[p], number)
                for p, number in self.ids.items()
                for i in range(1, len(p))
                if p[:i] in self.ids and p[i:] in self.ids
            ]
        )

    def _merged_all(self, runs: list[str]) -> list[bytes]:
        """The pieces of many short runs, all merged side by side."""
        out = [b""] * len(runs)
        codes = np.frombuffer("".join(runs).encode("utf-32-le"), "<u4")
        run = np.repeat(np.arange(len(runs)), [len(r) for r in runs])
        size = 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)
        for ended in self.merges.apply(run, self.letters[codes], size):
            of, numbers, sizes = self._spelled(*ended)
            for name, coded in cut_runs(of, np.stack([numbers, sizes], axis=1)):
                out[name] = coded
        return out

    def _spelled(self, run: np.ndarray, piece: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """Characters that are no piece as their bytes, of which the last has the size, or as unknown."""
        strange = piece >= len(self.pieces)
        if not strange.any():
            return run, piece, size
        if not self.byte_fallback:
            return run, np.where(strange, self.unknown, piece), size
        times = np.where(strange, size, 1)
        last = np.cumsum(times) - 1
        sizes = np.zeros(times.sum(), np.int64)
        sizes[last] = size
        numbers = np.repeat(piece, times)
        spelled = "".join(map(chr, (piece[strange] - len(self.pieces)).tolist())).encode("utf-8", "replace")
        numbers[np.repeat(strange, times)] = [self.bytes[b] for b in spelled]
        return np.repeat(run, times), numbers, sizes

    def _merged_long(self, run: str) -> list[str]:
        """One run, in n log n steps: a heap of pairs, in which those that have changed since are passed over."""
        rank, parts = self.ranks.get, list(run)
        after = [*range(1, len(parts)), None]
        before = [None, *range(len(parts) - 1)]
        heap = [(r, i, 2) for i, (a, b) in enumerate(zip(parts, parts[1:])) if (r := rank(a + b)) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            j = after[i]
            if not parts[i] or j is None or len(parts[i]) + len(parts[j]) != size:
                continue
            parts[i] += parts[j]
            parts[j] = ""
            after[i] = after[j]
            if after[i] is not None:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a is not None and b is not None and (r := rank(parts[a] + parts[b])) is not None:
                    heapq.heappush(heap, (r, a, len(parts[a]) + len(parts[b])))
        return [p for p in parts if p]

    def decode(self, ids) -> str:
        """What the pieces stand for, without the space that normalising put in front.

        Bytes that are no UTF-8 become U+FFFD one by one.
        """
        surfaces = self.surfaces
        told = [surfaces[i] for i in ids]
        if self.dummy_prefix or self.squeeze:
            for at, i in enumerate(ids):
                if self.kinds[i] == CONTROL:
                    continue
                if self.kinds[i] in (NORMAL, USER) and told[at].startswith(b" "):
                    told[at] = told[at][1:]
                    if self.squeeze and not told[at]:
                        continue  # nothing has come out yet
                break
        return b"".join(told).decode("utf-8", "barorail-each-byte")

    def __getstate__(self):
        return self.__dict__ | {"chunks": Recent(KEPT)}


def _encoded(shared, texts) -> Iterator[tuple[PieceModel, np.ndarray, np.ndarray]]:
    """Model, ids and places of each text, by the model a worker keeps with what it has met."""
    key = "pieces", hashlib.sha256(shared.value).digest()
    model = kept(key, lambda: PieceModel.from_bytes(shared.value))
    held, load = [], 0
    for text in texts:
        held.append(text or "")
        load += len(held[-1])
        if load >= BLOCK:
            for ids, bounds in model.encode_all(held):
                yield model, ids, bounds
            held, load = [], 0
    for ids, bounds in model.encode_all(held):
        yield model, ids, bounds


def _shared(df: DataFrame, model_file: str):
    with open(model_file, "rb") as f:
        data = f.read()
    PieceModel.from_bytes(data)  # a model that is not covered fails here
    return df.sparkSession.sparkContext.broadcast(data)


def encode_pieces(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, ids, starts, ends of every row: pieces and their ranges in the bytes of the text in UTF-8.

    A NULL or empty text has no ids. The model goes to each executor once; its size is that of the
    vocabulary. Repeated rows stay, other columns are ignored, an empty table gives no rows.
    """
    shared = _shared(docs, model_file)

    def rows(doc_ids, texts) -> Iterator[tuple]:
        for doc_id, (_, ids, bounds) in zip(doc_ids, _encoded(shared, texts)):
            yield doc_id, ids.astype(np.int32), bounds[:-1].astype(np.int32), bounds[1:].astype(np.int32)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, ids array<int>, starts array<int>, ends array<int>"
    return map_rows(docs.select("doc_id", "text"), rows, schema, keeps=True)


def decode_pieces(encoded: DataFrame, model_file: str) -> DataFrame:
    """doc_id and text of every row of ids; NULL ids give a NULL text."""
    shared = _shared(encoded, model_file)

    def rows(doc_ids, ids) -> Iterator[tuple]:
        model = PieceModel.from_bytes(shared.value)
        for doc_id, found in zip(doc_ids, ids):
            yield doc_id, None if found is None else model.decode(found)

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return map_rows(encoded.select("doc_id", "ids"), rows, f"doc_id {kind}, text string")


def piece_digests(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, bounds_sha256 of every row, rows as in ``encode_pieces``.

    bounds_sha256 is that of the places where pieces begin and the last one ends, as little-endian unsigned
    32-bit numbers. The ids and places themselves stay in the task: digests of them are all that is asked.
    """
    shared = _shared(docs, model_file)
    names: list[str] = []

    def rows(doc_ids, texts) -> Iterator[tuple]:
        for doc_id, (model, found, bounds) in zip(doc_ids, _encoded(shared, texts)):
            if not names:
                names.extend(map(str, range(len(model.pieces))))
            ids = found.tolist()
            said = ",".join([names[i] for i in ids]).encode()
            told = said, model.decode(ids).encode(), bounds.astype("<u4").tobytes()
            yield doc_id, len(ids), *(hashlib.sha256(x).hexdigest() for x in told)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, bounds_sha256 string"
    return map_rows(docs.select("doc_id", "text"), rows, schema, keeps=True)
