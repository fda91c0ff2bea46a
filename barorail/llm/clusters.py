"""Clusters of vectors around moving centroids, where geometry tells which vectors can't have changed sides.

Every vector keeps a lower bound on its distance to all centroids but its own. When centroids move, the bound
of a vector of cluster i has to give way by no more than any centroid j can have come nearer to any point of
the sphere that holds the cluster. That is a matter of one plane: seen from the middle of j's way, the sphere
covers an angle, and no point of it is more than the way's length times the cosine of its angle to the way
nearer to j now than before. Vectors that are nearer to their own centroid than the bound stay; the others are
compared with all centroids. Vectors and centroids are whole numbers, so distances are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_dir
from .common import small_batches

#: Vectors of a row of the working table.
BLOCK = 2048
#: Largest component, as a whole number, of which squared distances are exact in 64 bits.
LARGEST = 2**26
#: Distances this close, by their size, count as ambiguous: far more than rounding can be.
MARGIN = 1e-9
#: What rounding may take from the cosine of an angle between two inverse functions.
ROUNDING = 1e-7


@dataclass(frozen=True)
class Move:
    """Centroids before and after they moved, and how far each cluster reached from where it was."""

    before: np.ndarray
    after: np.ndarray
    reach: np.ndarray

    def loosening(self) -> np.ndarray:
        """By how much the bound of each cluster's vectors gives way."""
        before, after = self.before.astype(np.float64), self.after.astype(np.float64)
        count = len(before)
        ways = after - before
        lengths = np.linalg.norm(ways, axis=1)
        nearer = np.zeros((count, count))  # [i, j]: how much nearer j can have come to vectors of i
        for j in np.flatnonzero(lengths):
            away = before - (before[j] + ways[j] / 2)  # of the clusters' centres from the middle of the way
            far = np.linalg.norm(away, axis=1)
            within = far <= self.reach
            safe = np.where(far > 0, far, 1.0)
            angle = np.arccos(np.clip(away @ ways[j] / (safe * lengths[j]), -1, 1))
            half = np.arcsin(np.clip(np.where(within, 1.0, self.reach / safe), 0, 1))
            least = np.where(within, 0.0, np.maximum(0.0, angle - half))
            nearer[:, j] = lengths[j] * np.minimum(1.0, np.maximum(0.0, np.cos(least)) + ROUNDING)
        np.fill_diagonal(nearer, 0.0)
        return nearer.max(axis=1, initial=0.0)


def squared_distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole numbers, row by centroid."""
    most = max(int(np.abs(vectors).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    if 4 * vectors.shape[1] * most * most < 2**53:  # sums of doubles are exact up to there
        x, c = vectors.astype(np.float64), centroids.astype(np.float64)
        found = (x * x).sum(axis=1)[:, None] - 2.0 * (x @ c.T) + (c * c).sum(axis=1)[None, :]
        return found.astype(np.int64)
    return np.stack([((vectors - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def scanned(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid (the smaller number of equal ones), squared distance, and distance to the next one."""
    found = squared_distances(vectors, centroids)
    nearest = found.argmin(axis=1)
    rows = np.arange(len(vectors))
    own = found[rows, nearest]
    if found.shape[1] == 1:
        return nearest, own, np.full(len(vectors), np.inf)
    found[rows, nearest] = np.iinfo(np.int64).max
    return nearest, own, np.sqrt(found.min(axis=1).astype(np.float64))


def moved(vectors: np.ndarray, clusters: np.ndarray, bounds: np.ndarray, move: Move, looser: np.ndarray):
    """Clusters, squared distances and bounds after a move, and how many vectors had to be compared with all."""
    bounds = bounds - looser[clusters]
    own = ((vectors - move.after[clusters]) ** 2).sum(axis=1)
    distance = np.sqrt(own.astype(np.float64))
    open_ = np.flatnonzero(~(distance < bounds - MARGIN * (1.0 + distance + np.abs(bounds))))
    clusters = clusters.copy()
    if len(open_):
        clusters[open_], own[open_], bounds[open_] = scanned(vectors[open_], move.after)
    return clusters, own, bounds, len(open_)


def _whole(embeddings: pa.ListArray, dims: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are vectors of ``dims`` finite components, and those as whole numbers."""
    fits = pc.fill_null(pc.equal(pc.list_value_length(embeddings), dims), False)
    rows = np.flatnonzero(fits.to_numpy(zero_copy_only=False))
    flat = embeddings.take(pa.array(rows)).flatten().cast(pa.float64())
    values = flat.to_numpy(zero_copy_only=False).reshape(len(rows), dims)  # a null becomes NaN
    good = np.isfinite(values).all(axis=1)
    scaled = np.floor(scale * values[good])
    if np.abs(scaled).max(initial=0) > LARGEST:
        raise ValueError(f"components above {LARGEST / scale} have no exact distances")
    return rows[good], scaled.astype(np.int64)


def whole_vectors(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """ids and vectors of up to BLOCK kept rows each: little-endian 32-bit numbers, row by row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = _whole(batch.column(1), dims, scale)
            for at in range(0, len(rows), BLOCK):
                ids = batch.column(0).take(pa.array(rows[at : at + BLOCK]))
                data = found[at : at + BLOCK].astype("<i4").tobytes()
                offsets = pa.array([0, len(ids)], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(offsets, ids), pa.array([data], pa.binary())], ["ids", "vectors"]
                )

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.select("vec_id", "embedding").mapInArrow(run, f"ids array<{kind}>, vectors binary")


def first_centroids(blocks: DataFrame, dims: int, count: int, seed: int) -> np.ndarray:
    """The kept vectors whose ids have the smallest hashes, in their order; rows of one id by components.

    Spark keeps the ``count`` best of every task; a NULL id comes last.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                names = [None if i is None else hashlib.sha256(f"{seed}:{i}".encode()).hexdigest() for i in ids]
                rows = np.frombuffer(data, "<i4").reshape(-1, dims).tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()), pa.array(rows, pa.list_(pa.int32()))], ["name", "components"]
                )

    named = blocks.select("ids", "vectors").mapInArrow(run, "name string, components array<int>")
    told = named.orderBy(F.col("name").asc_nulls_last(), "components").limit(count).collect()
    return np.array([row["components"] for row in told], np.int64).reshape(len(told), dims)


def _assigned(blocks: DataFrame, count: int, dims: int, assign) -> DataFrame:
    """``blocks`` with the clusters, bounds and squared distances that ``assign`` gives, and numbers to add up.

    Those are for each cluster its vectors and their squared distances, then how many vectors were compared
    with all centroids, the largest squared distance in each cluster, and the components of each cluster.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                ids, data, *state = (column[at].as_py() for column in batch.columns[:4])
                vectors = np.frombuffer(data, "<i4").reshape(-1, dims).astype(np.int64)
                if state:
                    state = [np.frombuffer(state[0], "<i4"), np.frombuffer(state[1], "<f8")]
                clusters, own, bounds, compared = assign(vectors, *state)
                squares, reach = np.zeros(count, np.int64), np.zeros(count, np.int64)
                sums = np.zeros((count, dims), np.int64)
                np.add.at(squares, clusters, own)
                np.maximum.at(reach, clusters, own)
                np.add.at(sums, clusters, vectors)
                held = np.bincount(clusters, minlength=count)
                numbers = np.concatenate([held, squares, [compared], reach, sums.ravel()])
                row = [data] + [x.astype(t).tobytes() for x, t in ((clusters, "<i4"), (bounds, "<f8"), (own, "<i8"))]
                told = [pa.array([x], pa.binary()) for x in row] + [pa.array([numbers], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 1), *told], names=names)

    names = ["ids", "vectors", "clusters", "bounds", "distances", "numbers"]
    kind = blocks.schema["ids"].dataType.simpleString()
    rest = "vectors binary, clusters binary, bounds binary, distances binary, numbers array<long>"
    columns = [c for c in names[:4] if c in blocks.columns]
    return blocks.select(*columns).mapInArrow(run, f"ids {kind}, {rest}")


@dataclass(frozen=True)
class Totals:
    """What the vectors of each cluster add up to, and how many were compared with all centroids."""

    counts: list[int]
    squares: list[int]
    compared: int
    reach: np.ndarray
    sums: list[list[int]]

    @classmethod
    def of(cls, state: DataFrame, count: int, dims: int) -> Totals:
        """Added up by Spark; the driver gets a number per cluster and component."""
        each = state.select(F.posexplode("numbers").alias("at", "n")).groupBy("at")
        added = each.agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("all"), F.max("n").alias("most"))
        found = {row["at"]: (int(row["all"]), row["most"]) for row in added.collect()}
        every = [found[at][0] for at in range(2 * count + 1)]
        reach = [found[2 * count + 1 + i][1] for i in range(count)]
        begin = 3 * count + 1
        sums = [[found[begin + i * dims + d][0] for d in range(dims)] for i in range(count)]
        return cls(every[:count], every[count:-1], every[-1], np.sqrt(np.array(reach, np.float64)), sums)

    def centroids(self, before: np.ndarray) -> np.ndarray:
        """Componentwise floor(sum / count); an empty cluster stays where it was."""
        pairs = zip(self.counts, self.sums, before.tolist())
        return np.array([[s // n for s in sums] if n else old for n, sums, old in pairs], np.int64)


@dataclass(frozen=True)
class Clusters:
    """The last assignment: a table of blocks of vectors, the centroids, and the totals of every round."""

    state: DataFrame
    centroids: np.ndarray
    rounds: list[Totals]


def fitted(
    vectors: DataFrame, dims: int = 64, scale: int = 1024, count: int = 8, rounds: int = 10, seed: int = 3
) -> Clusters | None:
    """Assign, move the centroids ``rounds`` times, and assign once more; None if no vector is kept.

    Every round writes blocks of vectors with their clusters and bounds and reads them back, so a lost
    executor costs its tasks only; a table that the next round has replaced is removed. No row is
    shuffled: what is added up is a row per block.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    path = _written(whole_vectors(vectors, dims, scale))
    blocks = spark.read.parquet(path)
    centroids = first_centroids(blocks, dims, count, seed)
    if not len(centroids):
        return None

    def scan(whole, after=centroids):
        nearest, own, bounds = scanned(whole, after)
        return nearest, own, bounds, len(whole)

    assign, told = scan, []
    while True:
        replaced, path = path, _written(_assigned(blocks, len(centroids), dims, assign))
        blocks = spark.read.parquet(path)
        _remove(spark, replaced)
        told.append(Totals.of(blocks, len(centroids), dims))
        if len(told) > rounds:
            return Clusters(blocks, centroids, told)
        move = Move(centroids, told[-1].centroids(centroids), told[-1].reach)
        centroids, looser = move.after, move.loosening()

        def assign(whole, clusters, bounds, move=move, looser=looser):
            return moved(whole, clusters, bounds, move, looser)


def _written(df: DataFrame) -> str:
    path = scratch_dir(df.sparkSession, "clusters")
    df.write.parquet(path)
    return path


def _remove(spark, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def cluster_vectors(vectors: DataFrame, **options) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector that is kept.

    Kept are vectors with exactly ``dims`` components, none NULL or not finite; each component x becomes
    floor(``scale`` x). The ``count`` vectors with the smallest hashes of ``seed``:vec_id are the first
    centroids (all of them, if there are fewer). Distances are squared; the smaller number wins where two
    centroids are equally near.

    Equal rows are vectors of their own, and where they share an id the smaller components come first among
    the first centroids; a NULL id comes last there. A component beyond 65,536 (``LARGEST`` / ``scale``) has
    no exact distances in 64 bits and is an error. Other columns are ignored; an empty table gives no rows.
    """
    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = (
        f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    found = fitted(vectors, **options)
    if found is None:
        return vectors.sparkSession.createDataFrame([], schema)
    squares = np.array(found.rounds[-1].squares, np.int64)
    named = [",".join(map(str, c)) for c in found.centroids.tolist()]
    hashes = pa.array([hashlib.sha256(n.encode()).hexdigest() for n in named])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clusters = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<i4")
            distances = np.frombuffer(b"".join(batch.column(2).to_pylist()), "<i8")
            all_ = np.full(len(clusters), squares.sum())
            told = [pa.array(x) for x in (clusters, distances, squares[clusters], all_)]
            columns = [batch.column(0).flatten(), *told, hashes.take(pa.array(clusters))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return found.state.select("ids", "clusters", "distances").mapInArrow(run, schema)
