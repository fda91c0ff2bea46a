"""Quality classifier: does a text compress better with a dictionary of good or of bad texts?"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import label_sample, map_rows, unused

#: Texts are compressed in pieces, or a long text would teach the compressor more than the dictionary.
PIECE = 1024
LEVEL = 3
#: Fewest examples of either kind to learn from.
FEWEST = 8


def pieces(text: str) -> list[bytes]:
    data = text.encode("utf-8", "surrogatepass")
    return [data[i : i + PIECE] for i in range(0, len(data), PIECE)]


@dataclass(frozen=True)
class CompressionClassifier:
    """Dictionaries by label and the curve from size difference to P(label 1), as points on it."""

    bad: bytes
    good: bytes
    at: tuple[float, ...]
    rate: tuple[float, ...]

    def differences(self, texts: list[str]) -> list[float]:
        """Bytes that the good dictionary saves over the bad one, per byte of text; 0 for no text."""
        bad, good = _compressor(self.bad), _compressor(self.good)
        found = []
        for text in texts:
            parts = pieces(text)
            more = sum(len(bad(p)) - len(good(p)) for p in parts)
            found.append(more / max(1, sum(map(len, parts))))
        return found

    def score(self, difference: np.ndarray) -> np.ndarray:
        return np.interp(difference, self.at, self.rate)


def _compressor(dictionary: bytes):
    trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    if trained:
        trained.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=trained, write_content_size=False, write_checksum=False, write_dict_id=False
    ).compress


def _dictionary(samples: list[bytes], size: int) -> bytes:
    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too few or too uniform samples: their own bytes serve as the dictionary
        return b"".join(samples)[-size:]


def rising_curve(x: np.ndarray, y: np.ndarray) -> tuple[tuple[float, ...], tuple[float, ...]]:
    """Points of the rising curve that fits P(y = 1 | x) best: pooled neighbours, joined by lines.

    Each pool counts half a row of either label on top of its own, so that no score is sure.
    """
    values, at = np.unique(x, return_inverse=True)
    rows, ones = np.bincount(at), np.bincount(at, weights=y)
    pools: list[list[float]] = []  # rows, rows of label 1, sum of x
    for value, n, n1 in zip(values.tolist(), rows.tolist(), ones.tolist()):
        pools.append([n, n1, value * n])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    rates = np.maximum.accumulate([(p[1] + 0.5) / (p[0] + 1.0) for p in pools])
    return tuple(p[2] / p[0] for p in pools), tuple(rates.tolist())


def fit(
    docs: DataFrame,
    labels: DataFrame,
    rows: int = 8_000,
    pieces_per_text: int = 8,
    dictionary_bytes: int = 32_768,
) -> CompressionClassifier:
    """Learn from at most ``rows`` labelled documents (see ``label_sample``).

    One half of them, by hash of the id, makes the dictionaries, from at most ``pieces_per_text`` evenly
    spaced pieces of each text; the whole texts of the other half calibrate the curve, since texts the
    dictionaries have seen compress too well. With fewer than 8 documents of either label in either half
    every score is the share of good documents (one half if there is none).
    """
    sample = F.broadcast(label_sample(labels, "quality", rows))
    known = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(sample, "doc_id")
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2))

    def some_pieces(ids, texts, marks):
        for i, t, y in zip(ids, texts, marks):
            parts = pieces(t)
            step = max(1, -(-len(parts) // pieces_per_text))
            yield str(i), y, parts[::step]

    told = (
        map_rows(known.where(half == 0), some_pieces, "doc_id string, quality int, parts array<binary>")
        .sort(F.xxhash64("doc_id"), "doc_id", F.xxhash64("parts"))
        .select("quality", "parts")
        .collect()
    )
    samples = {y: [bytes(p) for r in told if r["quality"] == y for p in r["parts"]] for y in (0, 1)}
    counted = [sum(r["quality"] == y for r in told) for y in (0, 1)]
    share = (counted[1] / sum(counted)) if sum(counted) else 0.5
    plain = CompressionClassifier(b"", b"", (0.0,), (share,))
    if min(counted) < FEWEST:
        return plain
    bad, good = (_dictionary(samples[y], dictionary_bytes) for y in (0, 1))
    untuned = CompressionClassifier(bad, good, (0.0,), (share,))

    def measure(ids, texts, marks):
        yield from zip(map(str, ids), marks, untuned.differences(texts))

    seen = map_rows(known.where(half == 1), measure, "doc_id string, quality int, difference double").toPandas()
    seen = seen.sort_values(["doc_id", "difference"])  # the same pools whatever order the rows come in
    y = seen["quality"].to_numpy()
    if min((y == 0).sum(), (y == 1).sum()) < FEWEST:
        return plain
    return CompressionClassifier(bad, good, *rising_curve(seen["difference"].to_numpy(), y))


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5))


def _scored(docs: DataFrame, model: CompressionClassifier, name: str) -> DataFrame:
    """``docs`` and the score of every row, as ``name``."""
    place = docs.columns.index("text")

    def score(*columns) -> Iterator[tuple]:
        difference = np.array(model.differences([t or "" for t in columns[place]]))
        yield from zip(*columns, model.score(difference).tolist())

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return map_rows(docs, score, f"{schema}, `{name}` double")


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that ``classify`` predicts to be good, each by its own text."""
    model = fit(docs, labels.where(fold(F.col("doc_id")) != 0))
    name = unused(docs.columns, "_score")
    return _scored(docs, model, name).where(F.col(f"`{name}`") >= threshold).drop(name)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of every row, learned from what is not held out.

    NULL and empty texts save nothing with either dictionary and get the curve's value at 0. A NULL
    doc_id is never held out. Repeated rows stay, other columns are ignored, an empty table gives no rows.
    """
    model = fit(docs, labels.where(fold(F.col("doc_id")) != 0))

    scored = _scored(docs.select("doc_id", "text"), model, "score")
    return scored.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
