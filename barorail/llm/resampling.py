"""Importance resampling towards a target text: hashed runs of words, log-ratio weights, a weighted draw."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import numbered
from .common import map_rows, saved

BUCKETS = 10_000
#: Words in the longest feature.
RUN = 3
#: Bytes of the texts whose features are hashed at once.
BLOCK = 1_000_000
#: Longer features are hashed in parts of this many bytes.
PART = 256
#: Bytes of a matrix of features.
MATRIX = 4_000_000

#: What each byte of a text becomes: A-Z in lower case, any other byte that is no part of a word a space.
_LOWER = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


CRC = _crc_table()


def _update(crc: np.ndarray, columns) -> np.ndarray:
    """The checksums of all rows after each of the columns in turn."""
    for column in columns:
        crc = CRC[(crc ^ column) & 0xFF] ^ (crc >> 8)
    return crc


#: What PART zero bytes make of a checksum, by each of its four bytes.
_SHIFT = np.stack(
    [_update(np.arange(256, dtype=np.uint32) << np.uint32(8 * i), [np.uint32(0)] * PART) for i in range(4)]
)


def _registers(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Checksum registers of the ranges of ``data``, begun at ``first``.

    Ranges of one length form a matrix of bytes, whose columns update the registers of all its rows.
    """
    out = np.empty(len(starts), np.uint32)
    order = np.argsort(lengths, kind="stable")
    ranked = lengths[order]
    edges = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])) if len(order) else []
    for low, high in zip(edges, [*edges[1:], len(order)]):
        length = int(ranked[low])
        step = max(1, MATRIX // max(1, length))
        columns = np.arange(length)[:, None]
        for at in range(low, high, step):
            rows = order[at : min(at + step, high)]
            out[rows] = _update(first[rows], data[columns + starts[rows][None, :]])
    return out


def crc32s(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of each range of bytes of ``data``.

    Ranges above PART bytes are cut into a head and parts of PART bytes, rows of their own in the same
    matrices: appending a part to a text takes its register through PART zero bytes, and joins the part's.
    """
    parts = np.where(lengths > 0, (lengths - 1) // PART, 0)
    heads = lengths - parts * PART
    crc = _registers(data, starts, heads, np.full(len(starts), 0xFFFFFFFF, np.uint32))
    longer = np.flatnonzero(parts)
    if len(longer):
        of = np.repeat(longer, parts[longer])
        turn = np.arange(len(of)) - np.repeat(np.cumsum(parts[longer]) - parts[longer], parts[longer])
        begins = starts[of] + heads[of] + turn * PART
        own = _registers(data, begins, np.full(len(of), PART), np.zeros(len(of), np.uint32))
        order = np.argsort(turn, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(turn[order])) + 1):
            now = crc[of[rows]]
            shifted = _SHIFT[0][now & 0xFF] ^ _SHIFT[1][(now >> 8) & 0xFF]
            shifted ^= _SHIFT[2][(now >> 16) & 0xFF] ^ _SHIFT[3][now >> 24]
            crc[of[rows]] = shifted ^ own[rows]
    return crc ^ np.uint32(0xFFFFFFFF)


class _Numbers(dict):
    """Numbers words as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def word_lists(texts: list[str | None]) -> list[list[bytes]]:
    return [(t or "").encode("utf-8", "surrogatepass").translate(_LOWER).split(b" ") for t in texts]


def feature_buckets(texts: list[str | None]) -> list[tuple[int, np.ndarray]]:
    """Words and the bucket of every feature, repeats counted, of each text.

    Words are numbered, so equal features are found as equal numbers and each is hashed once per call.
    Joined by single spaces, the words of all texts hold every feature as a range of bytes.
    """
    listed = [[w for w in words if w] for words in word_lists(texts)]
    words = [w for found in listed for w in found]
    counts = np.array([len(found) for found in listed], np.int64)
    numbers = _Numbers()
    number = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    data = np.frombuffer(b" ".join(words), np.uint8)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    text = np.repeat(np.arange(len(texts)), counts)

    per_run: list[tuple[np.ndarray, np.ndarray]] = []  # buckets of the runs of each length, runs per text
    run = number
    for size in range(1, RUN + 1):
        at = np.flatnonzero(text[: len(text) - size + 1] == text[size - 1 :]) if len(text) >= size else text[:0]
        if size > 1:
            run = run[at] * len(numbers) + number[at + size - 1]
        _, first, which = np.unique(run, return_index=True, return_inverse=True)
        begin = starts[at][first]
        crc = crc32s(data, begin, ends[at + size - 1][first] - begin)
        per_run.append(((crc % BUCKETS).astype(np.uint16)[which], np.bincount(text[at], minlength=len(texts))))
        # Runs are numbered anew by the word they begin with, for the next word to be put behind.
        again = np.zeros(len(words), np.int64)
        again[at] = which
        run = again
    edges = [np.concatenate([[0], np.cumsum(n)]) for _, n in per_run]
    return [
        (int(counts[i]), np.concatenate([b[e[i] : e[i + 1]] for (b, _), e in zip(per_run, edges)]))
        for i in range(len(texts))
    ]


def _hashed(texts) -> Iterator[tuple[int, np.ndarray]]:
    held, load = [], 0
    for text in texts:
        held.append(text)
        load += len(text or "")
        if load >= BLOCK:
            yield from feature_buckets(held)
            held, load = [], 0
    if held:
        yield from feature_buckets(held)


def bucketed(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_features, buckets (unsigned 16-bit little-endian) of every row."""

    def rows(ids, texts) -> Iterator[tuple]:
        for i, (n, buckets) in zip(ids, _hashed(texts)):
            yield i, n, len(buckets), buckets.astype("<u2").tobytes()

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, n_features long, buckets binary"
    return map_rows(docs.select("doc_id", "text"), rows, schema)


def bucket_counts(hashed: DataFrame) -> np.ndarray:
    """Features per bucket of a whole table. What reaches the driver is a number per bucket."""

    def rows(buckets) -> Iterator[tuple]:
        counts = np.bincount(np.frombuffer(b"".join(buckets), "<u2"), minlength=BUCKETS)
        yield from ((int(b), int(counts[b])) for b in np.flatnonzero(counts))

    counted = map_rows(hashed.select("buckets"), rows, "bucket int, n long")
    found = np.zeros(BUCKETS, object)  # whole numbers of any size
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        found[row["bucket"]] = row["n"]
    return found


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of how much likelier each bucket is in the target, both counts smoothed by one."""
    s_all, t_all = float(source.sum() + BUCKETS), float(target.sum() + BUCKETS)
    ratios = [(float(t) + 1.0) * s_all / ((float(s) + 1.0) * t_all) for s, t in zip(source, target)]
    return np.array([math.floor(1000.0 * math.log(r)) for r in ratios], np.int64)


def _noise(doc_id, seed: int) -> int:
    """A Gumbel number of the id, in thousandths: the largest sums of weight and it are a weighted draw."""
    named = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return math.floor(-1000.0 * math.log(-math.log((int(named[:8], 16) + 0.5) / 4294967296.0)))


def resampled(
    docs: DataFrame, target: DataFrame, percent: int = 5, fewest: int = 20, seed: int = 42
) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row of ``docs``; rank NULL where it is not drawn.

    Words are runs of letters a-z (A-Z in lower case), digits and anything beyond ASCII; features are all
    runs of one to three words, each in the bucket of its CRC-32. Of the rows with at least ``fewest``
    words ``percent`` in a hundred are drawn, those of the highest score, equal ones by doc_id.

    ``target`` is any table with a column text. NULL and empty texts have no features and weight 0. Repeated rows are rows of their own, with one
    score, and ranked one after the other; a NULL doc_id has the hash of an empty one and comes behind
    equal scores. Where the target holds no words, rare buckets of the source weigh most. Other
    columns are ignored; an empty table gives no rows.

    Each text is hashed once; its buckets, two bytes a feature, are written and read for counts and weights.
    """
    hashed = saved(bucketed(docs), "buckets")
    aimed = bucketed(target.select(F.lit(0).alias("doc_id"), "text"))
    gains = bucket_gains(bucket_counts(hashed), bucket_counts(aimed))
    shared = docs.sparkSession.sparkContext.broadcast(gains)  # a number per bucket

    def rows(ids, words, features, buckets) -> Iterator[tuple]:
        for i, w, n, b in zip(ids, words, features, buckets):
            weight = int(shared.value[np.frombuffer(b, "<u2")].sum())
            yield i, n, weight, weight + _noise(i, seed), w >= fewest

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_features long, weight long, score long, fits boolean"
    scored = map_rows(hashed, rows, schema).withColumn("_row", F.monotonically_increasing_id())
    order = [F.col("fits").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_row")]
    ranked = numbered(scored, order, "rank")
    drawn = percent * ranked.where("fits").count() // 100
    rank = F.when(F.col("fits") & (F.col("rank") <= drawn), F.col("rank")).cast("long")
    return ranked.select("doc_id", "n_features", "weight", "score", rank.alias("rank"))


def drawn_documents(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose doc_id is drawn by ``resampled``.

    Rows that share an id stay if one of them is drawn; a row with a NULL id never does.
    """
    return docs.join(resampled(docs, target, **options).where("rank IS NOT NULL"), "doc_id", "left_semi")
