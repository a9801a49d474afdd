"""Centroid clustering of whole-number vectors; Ptolemy's inequality over pivot pairs saves distances."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from seqprep.llm.vectors import is_finite
from seqprep.sources.spool import spool

CLUSTERS = 40
ROUNDS = 5
WIDTH = 64
SCALE = 256
SEED = 2
PIVOTS = 6  # all their pairs give bounds
LIMIT = 1 << 27  # largest size of a scaled component: squared distances of WIDTH components then fit 64 bits
BLOCK = 4096  # vectors worked on at a time
SLACK = 1e-12  # relative; far above what a few operations on doubles can be off


def whole_vectors(docs: DataFrame, identity: str, vector: str, width: int, scale: int) -> DataFrame:
    """(vec_id, point): vectors of exactly ``width`` finite components, each turned into floor(scale * x)."""

    def whole(x):
        value = F.floor(x.cast("double") * scale)
        return F.when(F.abs(x.cast("double") * scale) <= LIMIT, value).otherwise(
            F.raise_error(F.lit(f"a component times {scale} exceeds {LIMIT}: squared distances need more than 64 bits"))
        )

    usable = docs.filter(is_finite(F.col(vector)) & (F.size(vector) == width))
    return usable.select(F.col(identity).cast("bigint").alias("vec_id"), F.transform(vector, whole).alias("point"))


def first_centroids(points: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The points with the smallest SHA-256 of ``seed:vec_id``; at most ``clusters`` rows reach the driver."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = points.orderBy(mark, "point").select("point").limit(clusters).collect()
    return np.array([row["point"] for row in rows], dtype=np.int64)


def distances(points: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to rows (or to one row)."""
    return ((points - other) ** 2).sum(1)


def choose_pivots(centroids: np.ndarray, count: int) -> np.ndarray:
    """Of the first centroids some that lie far apart: each next one is the farthest from those chosen."""
    chosen = [0]
    nearest = distances(centroids, centroids[0])
    while len(chosen) < min(count, len(centroids)) and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, distances(centroids, centroids[chosen[-1]]))
    return centroids[chosen]


@dataclass
class Assignment:
    """Centroids, pivots, and what the bounds need of both."""

    centroids: np.ndarray
    pivots: np.ndarray

    def __post_init__(self) -> None:
        self.pairs = list(combinations(range(len(self.pivots)), 2))
        self.apart = [float(np.sqrt(distances(self.pivots[p : p + 1], self.pivots[q])[0])) for p, q in self.pairs]
        self.far = to_pivots(self.centroids, self.pivots)

    def bounds(self, near: np.ndarray) -> np.ndarray:
        """Lower bounds of the distances to every centroid, from cached distances to the pivots.

        For pivots p and q Ptolemy gives d(x, c) d(p, q) >= |d(x, p) d(c, q) - d(x, q) d(c, p)|. The products'
        sizes times ``SLACK`` are taken off, more than rounding can have added.
        """
        best = np.zeros((len(near), len(self.centroids)))
        for (p, q), apart in zip(self.pairs, self.apart):
            one = near[:, p, None] * self.far[None, :, q]
            two = near[:, q, None] * self.far[None, :, p]
            np.maximum(best, (np.abs(one - two) - SLACK * (one + two)) / apart * (1 - SLACK), out=best)
        return best

    def nearest(self, points: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Nearest centroid (ties: smaller number), exact squared distance, and how many distances were taken."""
        lower = self.bounds(near) ** 2 * (1 - SLACK)
        first = lower.argmin(1)
        cluster, least = first.copy(), distances(points, self.centroids[first])
        checked = len(points)
        for number, centroid in enumerate(self.centroids):
            rows = np.flatnonzero((lower[:, number] <= least * (1 + SLACK)) & (first != number))
            checked += len(rows)
            away = distances(points[rows], centroid)
            better = (away < least[rows]) | ((away == least[rows]) & (number < cluster[rows]))
            cluster[rows[better]], least[rows[better]] = number, away[better]
        return cluster, least, checked


def to_pivots(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.stack([distances(points, pivot) for pivot in pivots], axis=1).astype(float))


def _blocks(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _with_pivots(points: DataFrame, pivots: np.ndarray, width: int) -> DataFrame:
    """Add ``near``: the distances to the pivots, which stay the same in all rounds."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = to_pivots(_blocks(batch.column("point"), width), pivots)
            offsets = pa.array(np.arange(0, near.size + 1, near.shape[1]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(offsets, near.ravel())], names=["vec_id", "point", "near"]
            )

    return points.mapInArrow(measure, "vec_id bigint, point array<bigint>, near array<double>")


def _assigned(batch: pa.RecordBatch, known: Assignment) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    width, pivots = known.centroids.shape[1], len(known.pivots)
    for begin in range(0, batch.num_rows, BLOCK):
        part = batch.slice(begin, BLOCK)
        points = _blocks(part.column("point"), width)
        cluster, least, _ = known.nearest(points, _blocks(part.column("near"), pivots))
        yield slice(begin, begin + len(points)), points, cluster, least


def _moved(stored: DataFrame, known: Assignment) -> np.ndarray:
    """Centroids after one round: exact floors of means; a centroid without vectors stays.

    Tasks add up what they assign; (clusters x components) sums reach the driver, however many vectors there are.
    """

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(known.centroids.shape, np.int64)
        sizes = np.zeros(len(sums), np.int64)
        for batch in batches:
            for _, points, cluster, _ in _assigned(batch, known):
                order = np.argsort(cluster, kind="stable")
                names, starts = np.unique(cluster[order], return_index=True)
                sums[names] += np.add.reduceat(points[order], starts, axis=0)
                sizes += np.bincount(cluster, minlength=len(sizes))
        used = np.flatnonzero(sizes)
        if len(used):
            yield pa.RecordBatch.from_pydict(
                {"cluster": pa.array(used), "n": pa.array(sizes[used]), "sums": pa.array(list(sums[used]), pa.list_(pa.int64()))}
            )

    parts = stored.mapInArrow(add_up, "cluster bigint, n bigint, sums array<bigint>")
    cells = parts.select("cluster", "n", F.posexplode("sums").alias("place", "part"))
    totals = cells.groupBy("cluster", "place").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    moved = known.centroids.copy()
    for row in totals.collect():
        moved[row["cluster"], row["place"]] = int(row["total"]) // row["n"]
    return moved


def cluster_vectors(
    docs: DataFrame,
    identity: str = "vec_id",
    vector: str = "embedding",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    width: int = WIDTH,
    scale: int = SCALE,
    seed: int = SEED,
) -> DataFrame:
    """Lloyd's rounds in whole numbers: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Vectors that are null, have another number of components, or hold null or non-finite ones take no part. The
    first centroids are the ``clusters`` vectors (all, if fewer) with the smallest hash of seed and id; equal
    ids are told apart by their vectors, null ids count as empty text. A round gives every vector to its nearest
    centroid, by squared distance, ties to the smaller number, and moves centroids to the floor of the mean.
    After ``rounds`` rounds vectors are assigned once more. Repeated rows are vectors like any others; an empty
    table gives an empty result; other columns are not looked at. A scaled component beyond ``LIMIT`` is refused.

    The points are stored once, with their distances to a few fixed pivots. Each round's tasks bound the
    distance to every centroid by Ptolemy's inequality over the pivot pairs and take exact distances only to
    centroids whose bound is not above the best found.
    """
    points = whole_vectors(docs, identity, vector, width, scale)
    centroids = first_centroids(points, clusters, seed)
    schema = "vec_id bigint, cluster int, distance bigint"
    if not len(centroids):
        empty = docs.sparkSession.createDataFrame([], schema)
        return empty.selectExpr("*", "0L AS cluster_inertia", "0L AS inertia", "'' AS centroid_sha256")
    pivots = choose_pivots(centroids, PIVOTS)
    stored = spool(_with_pivots(points, pivots, width), "cluster-points")
    for _ in range(rounds):
        centroids = _moved(stored, Assignment(centroids, pivots))
    known = Assignment(centroids, pivots)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, _, cluster, least in _assigned(batch, known):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").slice(place.start, len(cluster)), pa.array(cluster, pa.int32()), pa.array(least)],
                    names=["vec_id", "cluster", "distance"],
                )

    assigned = spool(stored.mapInArrow(assign, schema), "cluster-assigned")
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum")).collect()
    inertia = sum(int(row["sum"]) for row in sums)
    names = [hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest() for centroid in centroids]
    per_cluster = docs.sparkSession.createDataFrame(
        [(row["cluster"], int(row["sum"]), inertia, names[row["cluster"]]) for row in sums],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
    )
    return assigned.join(F.broadcast(per_cluster), "cluster").select("vec_id", "cluster", "distance", *per_cluster.columns[1:])
