"""Byte-pair encoding by an automaton compiled from the merges, one gadget per merge.

The automaton reads tokens. It starts as one state with an arc per byte. A merge of ``a`` and ``b``
into ``w`` adds an arc ``w`` wherever ``a`` and then ``b`` could be read, ending where ``b`` ends, and
moves the end of ``a`` to a copy of its state from which ``b`` cannot be read any more. So a state is
given by the last token, and the arcs that are dead from it are what it inherited when its token was
made plus what later merges cut. Written out for a vocabulary of 50,000 tokens that is some 15,000
states and 22 million dead arcs; the gadgets are kept as they are instead (``ends``, ``begins``), and
rows of the table of arcs are filled in as they are used. Exactly one path spells any given word, and
its arcs are the tokens that merging would give.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import regex
from pyspark.sql import DataFrame

from .common import map_rows
from .hashing import Recent

#: White space of the pre-tokenizers.
SPACE = "\t-\r \x85\xa0" + "".join(map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
#: Runs that no match of the word pattern leaves: a cache of these is asked first.
CHUNK = re.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: Fixed by the vocabulary: how byte-level BPE splits words.
WORD = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
NEVER = 2**31
CACHED = 400_000
CACHED_CHARS = 64


def byte_letters() -> dict[str, int]:
    """The letter by which a vocabulary file writes each byte: itself if printable, else from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


@dataclass
class BpeAutomaton:
    """``labels[token]``: the bytes an arc emits. ``ids``: the arc that spells some bytes.

    ``ends[token]`` lists the tokens that end where it ends, ``begins[token]`` those that begin where it
    begins, each with the rank of the merge that used it up. ``special`` strings are cut out before words
    are split.
    """

    labels: dict[int, bytes]
    ids: dict[bytes, int]
    ranks: dict[tuple[int, int], int]
    ends: dict[int, tuple[tuple[int, int], ...]]
    begins: dict[int, tuple[tuple[int, int], ...]]
    special: dict[str, int]
    longest: int
    arcs: dict[int, bool] = field(default_factory=dict, repr=False)
    chunks: Recent = field(default_factory=lambda: Recent(CACHED), repr=False)
    words: Recent = field(default_factory=lambda: Recent(CACHED), repr=False)

    @classmethod
    def compile(cls, vocab: dict[bytes, int], merges: list[tuple[bytes, bytes]], special: dict[str, int]):
        new = cls({}, {}, {}, {}, {}, special, 1)
        for b in range(256):
            token = vocab.get(bytes([b]))
            if token is not None:
                new._arc(token, bytes([b]), ((token, NEVER),), ((token, NEVER),))
        for rank, (left, right) in enumerate(merges):
            a, b, w = vocab[left], vocab[right], vocab[left + right]
            if w in new.labels:
                raise ValueError(f"two merges make {left + right!r}")
            if a not in new.labels or b not in new.labels or not new._follows(a, b):
                continue  # an earlier merge never leaves these two side by side
            new.ranks[a, b] = rank
            ends = ((w, NEVER), (b, rank), *new.ends[b][1:])
            begins = ((w, NEVER), (a, rank), *new.begins[a][1:])
            new._arc(w, left + right, ends, begins)
        return new

    @classmethod
    def from_file(cls, path: str) -> BpeAutomaton:
        """Read a byte-level BPE vocabulary in the JSON form of the tokenizers library."""
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        letters = byte_letters()

        def spelled(text: str) -> bytes:
            return bytes(letters[c] for c in text)

        pairs = (m if isinstance(m, list) else m.split(" ") for m in told["model"]["merges"])
        special = {t["content"]: t["id"] for t in told["added_tokens"]}
        vocab = {spelled(t): i for t, i in told["model"]["vocab"].items() if t not in special}
        return cls.compile(vocab, [(spelled(a), spelled(b)) for a, b in pairs], special)

    def _arc(self, token, label, ends, begins) -> None:
        self.labels[token], self.ids[label] = label, token
        self.ends[token], self.begins[token] = ends, begins
        self.longest = max(self.longest, len(label))

    def _follows(self, last: int, token: int) -> bool:
        """Is there an arc ``token`` from the state that ``last`` ends in?

        It is dead if some merge joins a token at the end of ``last`` with one at the beginning of
        ``token`` before either is used up; of two equal pairs that overlap the left one goes first.
        """
        for x, until in self.ends[last]:
            for y, before in self.begins[token]:
                rank = self.ranks.get((x, y))
                if rank is not None and rank < until and rank <= before:
                    return False
        return True

    def follows(self, last: int, token: int) -> bool:
        key = last << 32 | token
        found = self.arcs.get(key)
        if found is None:
            if len(self.arcs) >= 4 * CACHED:
                self.arcs.clear()
            found = self.arcs[key] = self._follows(last, token)
        return found

    def encode_word(self, word: bytes) -> list[int]:
        """Follow arcs from the left, longest first, and step back from dead ends, each tried once."""
        path: list[int] = []
        starts: list[int] = []
        dead = bytearray(len(word) + 1)
        at, end = 0, min(len(word), self.longest)
        while at < len(word):
            token = None
            while end > at:
                if not dead[end]:
                    token = self.ids.get(word[at:end])
                    if token is not None and (not path or self.follows(path[-1], token)):
                        break
                    token = None
                end -= 1
            if token is not None:
                path.append(token)
                starts.append(at)
                at, end = end, min(len(word), end + self.longest)
            elif path:
                dead[at] = 1
                path.pop()
                end, at = at - 1, starts.pop()
            else:
                raise ValueError(f"no path spells {word!r}")
        return path

    def _chunk(self, chunk: str) -> bytes:
        found = self.chunks.get(chunk)
        if found is None:
            found = b"".join([self._word(w) for w in WORD.findall(chunk)])
            if len(chunk) <= CACHED_CHARS:
                self.chunks.put(chunk, found)
        return found

    def _word(self, word: str) -> bytes:
        found = self.words.get(word)
        if found is None:
            found = np.array(self.encode_word(word.encode("utf-8", "surrogatepass")), "<u4").tobytes()
            if len(word) <= CACHED_CHARS:
                self.words.put(word, found)
        return found

    def encode(self, text: str) -> list[int]:
        """Token ids of a whole text."""
        out = []
        marks = [s for s in self.special if s in text]
        parts = re.split("(" + "|".join(map(re.escape, marks)) + ")", text) if marks else [text]
        for i, part in enumerate(parts):
            if i % 2:
                out.append(np.array([self.special[part]], "<u4").tobytes())
            else:
                chunk = self._chunk
                out += [self.chunks.new.get(c) or chunk(c) for c in CHUNK.findall(part)]
        return np.frombuffer(b"".join(out), "<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        """What the arcs emit, one after the other."""
        emitted = self.emitted
        return b"".join([emitted[i] for i in ids]).decode("utf-8", "replace")

    @property
    def emitted(self) -> dict[int, bytes]:
        if not hasattr(self, "_emitted"):
            self._emitted = self.labels | {i: s.encode() for s, i in self.special.items()}
        return self._emitted

    def __getstate__(self):
        return self.__dict__ | {"arcs": {}, "chunks": Recent(CACHED), "words": Recent(CACHED)}


def encode_texts(docs: DataFrame, automaton: BpeAutomaton) -> DataFrame:
    """doc_id, ids of every row; a NULL or empty text has no ids.

    The automaton goes to each executor once; its size is that of the vocabulary. Repeated rows stay,
    other columns are ignored, an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(automaton)

    def rows(ids, texts) -> Iterator[tuple]:
        bpe = shared.value
        for i, text in zip(ids, texts):
            yield i, bpe.encode(text or "")

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_rows(docs.select("doc_id", "text"), rows, f"doc_id {kind}, ids array<int>")


def round_trip_digests(docs: DataFrame, automaton: BpeAutomaton) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row, rows as in ``encode_texts``.

    The ids themselves stay in the task: digests of them are all that is asked.
    """
    shared = docs.sparkSession.sparkContext.broadcast(automaton)

    def rows(doc_ids, texts) -> Iterator[tuple]:
        bpe = shared.value
        for doc_id, text in zip(doc_ids, texts):
            ids = bpe.encode(text or "")
            named = ",".join(map(str, ids)).encode()
            decoded = bpe.decode(ids).encode("utf-8", "surrogatepass")
            yield doc_id, len(ids), hashlib.sha256(named).hexdigest(), hashlib.sha256(decoded).hexdigest()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_rows(
        docs.select("doc_id", "text"),
        rows,
        f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
