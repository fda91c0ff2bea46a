"""Secret scans: fixed patterns, and Markov models that tell random strings from ordinary ones."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

KINDS = ("assign", "access", "hex", "markov")
ALPHABET = "".join(map(chr, (*range(65, 91), *range(97, 123), *range(48, 58)))) + "+/_.=-"
ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
#: What every match of ASSIGN holds, in lower case.
KEYWORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
RUN = re.compile(r"[A-Za-z0-9+/_.=-]+")

Span = tuple[int, int, int]  # start, end, index in KINDS


def base_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns by start, then kind; offsets count code points."""
    spans = [(m.start(), m.end(), 1) for m in ACCESS.finditer(text)] if "AKIA" in text else []
    lowered = text.lower()
    if any(k in lowered for k in KEYWORDS):
        # A match with a short value still uses up its text, so it is dropped after matching.
        spans += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    spans += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], s[2]))


def _secret(text: str, span: Span) -> str:
    """The random part of a span."""
    found = text[span[0] : span[1]]
    return ASSIGN.fullmatch(found)[1] if span[2] == 0 else found


_CODES = np.zeros(256, np.int64)  # 0: any other byte
_CODES[[ord(c) for c in ALPHABET]] = np.arange(1, len(ALPHABET) + 1)
SIZE = len(ALPHABET) + 1


def _pairs(text: str) -> np.ndarray:
    """Code of each character with the one before it, as one number, for characters of the alphabet."""
    codes = _CODES[np.frombuffer((" " + text).encode("utf-8", "surrogatepass"), np.uint8)]
    return (codes[:-1] * SIZE + codes[1:])[codes[1:] > 0]


def pair_counts(docs: DataFrame) -> np.ndarray:
    """How often each character follows each other: in ordinary text [0] and in secrets [1].

    The labelled samples are what the fixed patterns find, and all the rest, of every document. What
    reaches the driver is at most one number per pair of characters and class.
    """

    def count(texts) -> Iterator[tuple[int, int, int]]:
        total = np.zeros((2, SIZE * SIZE), np.int64)
        for text in texts:
            if not text:
                continue
            total[0] += np.bincount(_pairs(text), minlength=SIZE * SIZE)
            for span in base_spans(text):
                pairs = np.bincount(_pairs(_secret(text, span)), minlength=SIZE * SIZE)
                total[0] -= np.minimum(pairs, total[0])
                total[1] += pairs
        for label, pair in zip(*np.nonzero(total)):
            yield int(label), int(pair), int(total[label, pair])

    counted = map_rows(docs.select("text"), count, "label int, pair int, n long")
    found = np.zeros((2, SIZE * SIZE))
    for row in counted.groupBy("label", "pair").agg(F.sum("n").alias("n")).collect():
        found[row["label"], row["pair"]] = row["n"]
    return found


@dataclass(frozen=True)
class MarkovScan:
    """log(P(c | before) under secrets / under ordinary text) for each pair of characters.

    Of what base spans leave of a run of characters, the part of largest sum is a secret if it has at least
    ``shortest`` characters and its sum exceeds ``log_odds``, the logarithm of how much rarer secrets are
    taken to be than other text; so are further parts beside it. Without base matches, or without other
    text, there is nothing to compare: all sums are 0, and only base spans are found.
    """

    ratios: np.ndarray
    shortest: int = 20
    log_odds: float = float(np.log(1e6))

    @classmethod
    def fit(cls, counts: np.ndarray, **options) -> MarkovScan:
        table = counts.reshape(2, SIZE, SIZE) + 0.5
        table = np.log(table[:, :, 1:] / table[:, :, 1:].sum(axis=2, keepdims=True))
        ratios = np.zeros((SIZE, SIZE))
        if counts[0].sum() and counts[1].sum():  # without samples of both there is nothing to compare
            ratios[:, 1:] = table[1] - table[0]
            # Marks join the parts of paths and names as they do those of secrets: they speak for neither.
            mark = np.array([False] + [not c.isalnum() for c in ALPHABET])
            either = mark[:, None] | mark[None, :]
            ratios[either] = np.minimum(ratios[either], 0.0)
        return cls(ratios.ravel(), **options)

    def spans(self, text: str) -> list[Span]:
        """Base spans, and parts of runs that look random and overlap none of them; by start, then kind."""
        found = base_spans(text)
        more: list[Span] = []
        for run in RUN.finditer(text):
            if run.end() - run.start() >= self.shortest:
                at = run.start()
                for start, end, _ in found:
                    if start >= run.end():
                        break
                    if end > at:
                        more += self._random(text, at, min(start, run.end()))
                        at = end
                more += self._random(text, at, run.end())
        return sorted(found + more, key=lambda s: (s[0], s[2]))

    def _random(self, text: str, begin: int, end: int) -> Iterator[Span]:
        """Parts of a run that look random. What lies beside one, too short for itself, goes with it."""
        if end - begin < self.shortest:
            return
        sums = np.concatenate([[0.0], np.cumsum(self.ratios[_pairs(text[begin:end])])])
        gains = sums - np.minimum.accumulate(sums)
        last = int(gains.argmax())
        if gains[last] <= self.log_odds:
            return
        first, last = begin + int(sums[: last + 1].argmin()), begin + last
        first = begin if first - begin < self.shortest else first
        last = end if end - last < self.shortest else last
        yield from self._random(text, begin, first)
        if last - first >= self.shortest:
            yield first, last, 3
        yield from self._random(text, last, end)


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def find_secrets(docs: DataFrame, scan: MarkovScan | None = None) -> DataFrame:
    """doc_id and ``found``, an array of (start, end, kind), for every row.

    Learns the models from ``docs`` unless given. NULL and empty texts hold nothing; repeated rows stay;
    other columns are ignored; an empty table gives no rows.
    """
    scan = scan or MarkovScan.fit(pair_counts(docs))

    def rows(ids, texts):
        for i, text in zip(ids, texts):
            yield i, [{"start": a, "end": b, "kind": KINDS[k]} for a, b, k in scan.spans(text or "")]

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_rows(
        docs.select("doc_id", "text"), rows, f"doc_id {kind}, found array<struct<start: int, end: int, kind: string>>"
    )


def secret_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans, from ``find_secrets``."""
    found = find_secrets(docs)

    def text(spans):
        said = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(said, ",")

    def count(kind):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *(count(k) for k in KINDS[:3]),
        F.sha2(text(F.filter("found", lambda s: s["kind"] != KINDS[3])), 256).alias("base_sha256"),
        text(F.col("found")).alias("spans"),
    )


def redact_secrets(docs: DataFrame, mark: str = "<secret>", scan: MarkovScan | None = None) -> DataFrame:
    """``docs`` with every secret replaced by ``mark`` (touching or overlapping spans by one), n_chars anew.

    Of an assignment only the value goes. NULL texts stay NULL; other columns are carried along.
    """
    scan = scan or MarkovScan.fit(pair_counts(docs))

    def clean(text: str) -> str:
        out, at = [], 0
        cuts = []
        for start, end, kind in scan.spans(text):
            if kind == 0:
                start = end - len(_secret(text, (start, end, kind)))
            cuts.append((start, end))
        for start, end in sorted(cuts):
            if start > at or not out:
                out += [text[at:start], mark]
            at = max(at, end)
        return "".join(out) + text[at:]

    names = docs.columns
    place = names.index("text")

    def rows(*columns):
        for row in zip(*columns):
            if row[place] is not None:
                row = (*row[:place], clean(row[place]), *row[place + 1 :])
            yield row

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    cleaned = map_rows(docs, rows, schema)
    return cleaned.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in names else cleaned
