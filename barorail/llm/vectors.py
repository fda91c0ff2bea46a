"""Near-duplicate vectors by spherical-cap filters: list-decoded product codes, a join, exact cosines."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_groups, map_rows, saved
from .graph import components, hung

PARTS = 4
#: Rows of a bucket that are compared at once; larger buckets are cut into blocks of about this size.
BLOCK = 256


#: Random pairs on which a threshold is set, and how many of them may miss each other: with these a pair at the
#: cosine asked for is missed at a rate of under 0.31 % at 95 % confidence.
PAIRS, MISSED = 2048, 2


def random_pairs(rng: np.random.Generator, count: int, dims: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors, and one at that cosine to each (the same one, in a single dimension)."""
    one = rng.normal(size=(count, dims))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    aside = rng.normal(size=one.shape)
    aside -= (aside * one).sum(axis=1, keepdims=True) * one
    size = np.linalg.norm(aside, axis=1, keepdims=True)
    return one, cosine * one + np.sqrt(1 - cosine**2) * aside / np.where(size > 1e-9, size, 1.0)


class CapFilters:
    """Filter directions made of one random code word for each of four parts of a rotated vector.

    ``code`` words a part make code**4 directions, none of which is written down. The caps a vector falls
    into are those of all directions whose product with it is at least ``threshold``, set so that a random
    vector falls into ``caps`` on average, or into more where that is not enough for two at ``cosine`` to
    meet, but for ``MISSED`` of ``PAIRS`` random pairs. One in fewer than ``fewest`` lowers the threshold for itself.
    """

    def __init__(
        self, dims: int, code: int, caps: float = 16.0, fewest: int = 8, cosine: float = 0.98, seed: int = 5
    ):
        self.dims, self.code, self.caps, self.fewest = dims, code, caps, fewest
        self.cosine, self.seed = cosine, seed

    @cached_property
    def words(self) -> np.ndarray:
        """(part, word, coordinate of the vector): the code words, rotated back to the vector's own axes."""
        rng = np.random.default_rng([self.seed, self.dims, self.code])
        size = max(PARTS, self.dims)
        turn = np.linalg.qr(rng.normal(size=(size, size)))[0][:, : self.dims]
        words = np.zeros((PARTS, self.code, self.dims))
        for part, axes in enumerate(np.array_split(np.arange(size), PARTS)):
            code = rng.normal(size=(self.code, len(axes)))
            words[part] = code / np.linalg.norm(code, axis=1, keepdims=True) / np.sqrt(PARTS) @ turn[axes]
        return words

    @cached_property
    def threshold(self) -> float:
        """Found on random unit vectors, and random pairs of them just similar enough."""
        rng = np.random.default_rng([self.seed, self.dims])
        sample = rng.normal(size=(512, self.dims))
        sample /= np.linalg.norm(sample, axis=1, keepdims=True)
        low, high = 0.0, 1.0
        for _ in range(25):
            middle = (low + high) / 2
            if self._count(sample, middle) > self.caps * len(sample):
                low = middle
            else:
                high = middle
        one, other = random_pairs(rng, PAIRS, self.dims, self.cosine)
        open_ = np.arange(PAIRS)  # pairs that have not met yet: a lower threshold only adds caps
        while high > 0:
            pairs = zip(self._decode(one[open_], high), self._decode(other[open_], high))
            open_ = open_[[not len(np.intersect1d(x, y)) for x, y in pairs]]
            if len(open_) <= MISSED:
                break
            high -= 0.01
        return high

    def _halves(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b, c, d = (unit @ w.T for w in self.words)
        n = len(unit)
        return (a[:, :, None] + b[:, None, :]).reshape(n, -1), (c[:, :, None] + d[:, None, :]).reshape(n, -1)

    def _count(self, unit: np.ndarray, threshold: float) -> int:
        left, right = self._halves(unit)
        right.sort(axis=1)
        return sum(int((r.shape[0] - np.searchsorted(r, threshold - x)).sum()) for x, r in zip(left, right))

    def decode(self, unit: np.ndarray) -> list[np.ndarray]:
        """Numbers of the caps of each unit vector, ascending."""
        return self._decode(unit, self.threshold)

    def _decode(self, unit: np.ndarray, threshold: float) -> list[np.ndarray]:
        """Decode by halves.

        Sums over the first two parts that no sum over the others can lift to the threshold are cut off
        before the two halves are put together.
        """
        left, right = self._halves(unit)
        order = np.argsort(-right, axis=1)
        found: list[np.ndarray] = []
        for x, r, o in zip(left, right, order):
            ranked, limit = r[o], threshold
            while True:
                first = np.flatnonzero(x >= limit - ranked[0])
                counts = np.searchsorted(-ranked, x[first] - limit, side="right")
                if counts.sum() >= min(self.fewest, len(x) * len(r)):
                    break
                limit -= 0.02
            second = o[np.concatenate([np.arange(c) for c in counts])]
            found.append(np.sort(np.repeat(first, counts) * len(r) + second))
        return found


def _unit(rows: list[bytes], kind: str) -> np.ndarray:
    x = np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # or squares of large components overflow
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _distinct(vectors: DataFrame, kind: str) -> DataFrame:
    """vec_id, label, copy_key, vector of every row; the last two NULL where it links with nothing."""

    def rows(ids, labels, embeddings) -> Iterator[tuple]:
        for i, label, e in zip(ids, labels, embeddings):
            told = None, None
            if i is not None and label is not None and e and None not in e:
                x = np.array(e, kind) + 0  # -0.0 equals 0.0
                if np.isfinite(x).all() and x.any():
                    told = xxhash.xxh128_digest(f"{label!r}:".encode() + x.tobytes()), x.tobytes()
            yield i, label, *told

    types = {f.name: f.dataType.simpleString() for f in vectors.schema}
    schema = f"vec_id {types['vec_id']}, label {types['label']}, copy_key binary, vector binary"
    return map_rows(vectors.select("vec_id", "label", "embedding"), rows, schema)


def near_vectors(vectors: DataFrame, cosine: float = 0.98, caps: float = 16.0, fewest: int = 8) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row.

    Rows link whose labels are equal and whose vectors have a cosine, in double precision, of at least
    ``cosine``. A NULL id, label, vector or component, a component that is not finite, an empty or a zero
    vector links with nothing (n_links 0, component_id the row's own id, kept); vectors of different
    dimension have no cosine. Equal rows are vectors of their own. Other columns are ignored; an empty
    table gives no rows.

    Equal vectors are compared as one and counted as many. A pair is found if both fall into one cap; the
    caps are set so that at ``cosine`` itself a few pairs in a thousand do not (tests measure it), and fewer
    above. The number of caps grows with the number of vectors, so that those that share one for no reason
    stay few. A cap that many vectors fall into is cut into blocks, and each two of its blocks are compared
    in a task of their own. Of pairs that share several caps the first counts, so pairs are summed up
    where they are found and never written out.
    """
    kind = "<f8" if vectors.schema["embedding"].dataType.elementType.simpleString() == "double" else "<f4"
    id_type = vectors.schema["vec_id"].dataType.simpleString()
    label_type = vectors.schema["label"].dataType.simpleString()
    own = saved(_distinct(vectors, kind), "vectors")
    valid = own.where("copy_key IS NOT NULL")
    copies = valid.groupBy("copy_key").agg(F.min("vec_id").alias("id"), F.count("*").alias("times"))
    copies = saved(copies, "copies")
    code = max(8, int(np.ceil((8.0 * max(1, copies.count())) ** (1 / PARTS))))

    def decode(ids, times, labels, bytes_) -> Iterator[tuple]:
        by_size: dict[int, list[int]] = {}
        for at, b in enumerate(bytes_):
            by_size.setdefault(len(b), []).append(at)
        for size, places in by_size.items():
            filters = _filters(size // int(kind[-1]), code, caps, fewest, cosine)
            for start in range(0, len(places), 256):
                some = places[start : start + 256]
                for at, found in zip(some, filters.decode(_unit([bytes_[i] for i in some], kind))):
                    yield ids[at], times[at], labels[at], size, bytes_[at], found.tolist()

    text = copies.join(valid.select("copy_key", "label", "vector").dropDuplicates(["copy_key"]), "copy_key")
    schema = f"id {id_type}, times long, label {label_type}, size int, vector binary, caps array<bigint>"
    coded = saved(map_rows(text.select("id", "times", "label", "vector"), decode, schema), "caps")

    keys = ["label", "size", "cap"]
    falls = coded.select("id", "label", "size", F.explode("caps").alias("cap"))
    sizes = falls.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    met = falls.join(sizes, keys).withColumn("blocks", blocks)
    met = met.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select(
        "id", *keys, F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block"
    )
    met = met.join(coded.select("id", "times", "vector", "caps"), "id")

    def compare(key, rows) -> Iterator[tuple]:
        cap, low, high = key[2:]
        ids, block, times, bytes_, held = zip(*rows)
        unit, block = _unit(bytes_, kind), np.array(block)
        near = unit @ unit.T >= cosine
        np.fill_diagonal(near, False)
        if low != high:  # two blocks: only pairs across
            near &= block[:, None] != block[None, :]
        if not near.any():
            return
        # Pairs that share a smaller cap, too, count there.
        lower = [[c for c in caps if c < cap] for caps in held]
        names, at = np.unique(np.concatenate([np.array(x, np.int64) for x in lower]), return_inverse=True)
        falls_in = np.zeros((len(rows), len(names)), np.float32)
        falls_in[np.repeat(np.arange(len(rows)), [len(x) for x in lower]), at] = 1
        counted = near & ~(falls_in @ falls_in.T > 0)
        links = counted @ np.array(times, np.int64)
        # Whatever hangs together here hangs on its first row.
        first = hung(near)
        for i in range(len(rows)):
            if near[i].any():
                yield ids[i], ids[first[i]], int(links[i])

    found = map_groups(met, [*keys, "low", "high"], compare, f"id {id_type}, root {id_type}, links long")
    found = saved(found, "links")
    classes = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    copies = copies.join(counts, "id", "left").join(classes, "id", "left")
    copies = saved(copies.select("copy_key", "id", "times", "links", "component"), "classes")
    linked = own.select("vec_id", "copy_key").join(copies, "copy_key", "left")
    component = F.coalesce("component", "id", "vec_id")
    links = F.coalesce(F.col("links"), F.lit(0)) + F.coalesce(F.col("times") - 1, F.lit(0))
    return linked.select(
        "vec_id",
        links.cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


_known: dict[tuple, CapFilters] = {}


def _filters(*parameters) -> CapFilters:
    """The filters of a dimension, made once in a worker."""
    if parameters not in _known:
        _known[parameters] = CapFilters(*parameters)
    return _known[parameters]
