"""Exact search for the highest inner products: a ball tree per shard, searched best bound first."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from seqprep.llm.vectors import is_finite, matrix
from seqprep.sources.spool import spool

TOP = 5
SCALE = 256
SHARD = 8192  # candidates of a ball tree, about
QUERY_BLOCK = 4096  # queries that meet a shard in one task, about
LEAF = 64
_EXACT = float(1 << 53)


class BallTree:
    """Nodes hold a centre, a radius and a slice of the reordered rows."""

    def __init__(self, rows: np.ndarray) -> None:
        self.order = np.arange(len(rows))
        self.rows = rows
        centres, self.radii, self.slices, self.children = [], [], [], []
        todo = [(0, len(rows), -1)]
        while todo:
            begin, end, parent = todo.pop()
            number = len(centres)
            part = rows[self.order[begin:end]]
            centre = part.mean(0)
            away = np.sqrt(((part - centre) ** 2).sum(1))
            centres.append(centre)
            self.radii.append(away.max())
            self.slices.append((begin, end))
            self.children.append([])
            if parent >= 0:
                self.children[parent].append(number)
            if end - begin > LEAF and away.max() > 0:
                far = part[away.argmax()]
                other = part[((part - far) ** 2).sum(1).argmax()]
                side = np.argsort(part @ (other - far), kind="stable")
                self.order[begin:end] = self.order[begin:end][side]
                middle = (begin + end) // 2
                todo += [(begin, middle, number), (middle, end, number)]
        self.centres = np.array(centres)
        self.radii = np.array(self.radii)
        self.rows = rows[self.order]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Highest inner product that each node can hold for each query, rounding included."""
        length = np.sqrt((queries**2).sum(1))[:, None]
        reach = queries @ self.centres.T + length * self.radii
        size = np.sqrt((self.centres**2).sum(1)) + self.radii
        return reach + 1e-9 * length * size + 1e-6

    def leaf(self, node: int) -> bool:
        return not self.children[node]


def search(
    tree: BallTree, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, top: int, floor: np.ndarray
) -> list[list[tuple[int, int]]]:
    """Per query the best (score, id) of the tree's rows; ``floor`` holds scores that ``top`` others reach already.

    Nodes are taken in order of their bound; a node below the score of the current last place is left out with
    everything after it. Equal scores go to smaller ids, so a node that can only tie is still looked at.
    """
    ids = ids[tree.order]
    bounds = tree.bounds(queries)
    exact = np.abs(queries).max(initial=0) * np.abs(tree.rows).max(initial=0) * max(queries.shape[1], 1) < _EXACT
    results = []
    for number, query in enumerate(queries):
        ahead = [(-bounds[number, 0], 0)]
        best: list[tuple[int, int]] = []  # smallest first: (score, -id)
        while ahead:
            bound, node = heapq.heappop(ahead)
            last = max(floor[number], best[0][0] if len(best) == top else -np.inf)
            if -bound < last:
                break
            if not tree.leaf(node):
                for child in tree.children[node]:
                    heapq.heappush(ahead, (-bounds[number, child], child))
                continue
            begin, end = tree.slices[node]
            if exact:
                scores = tree.rows[begin:end] @ query
            else:
                whole = np.array([int(x) for x in query], dtype=object)
                scores = np.array([sum(int(a) * b for a, b in zip(row, whole)) for row in tree.rows[begin:end]], dtype=object)
            for place in np.flatnonzero((scores >= last) & (ids[begin:end] != own[number])):
                entry = (int(scores[place]), -int(ids[begin + place]))
                if len(best) < top:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        results.append([(score, -identity) for score, identity in best])
    return results


def _found(own: np.ndarray, results: list[list[tuple[int, int]]]) -> pa.Table:
    rows = [(int(q), identity, score) for q, found in zip(own, results) for score, identity in found]
    columns = list(zip(*rows)) if rows else [[], [], []]
    return pa.table(
        {name: pa.array(column, pa.int64()) for name, column in zip(("query_id", "vec_id", "score"), columns)}
    )


_FOUND = "query_id long, vec_id long, score long"


def _ranked(rows: DataFrame, top: int) -> DataFrame:
    """Best ``top`` per query: a bounded aggregate, so no query's rows are sorted in one place."""
    entry = F.struct((-F.col("score")).alias("minus"), "vec_id")
    best = rows.groupBy("query_id").agg(F.slice(F.sort_array(F.collect_set(entry)), 1, top).alias("best"))
    return best.select("query_id", F.posexplode("best").alias("place", "entry")).select(
        "query_id",
        (F.col("place") + 1).alias("rank"),
        F.col("entry.vec_id").alias("vec_id"),
        (-F.col("entry.minus")).alias("score"),
    )


def top_inner_products(
    table: DataFrame,
    is_query: Column,
    identity: str = "vec_id",
    vector: str = "embedding",
    top: int = TOP,
    scale: int = SCALE,
) -> DataFrame:
    """The ``top`` highest integer inner products of every query row: query_id, rank, vec_id, score.

    Components become ``floor(scale * x)``. Vectors are dealt into shards by a hash. Each shard builds a ball
    tree and first answers the queries that live in it; the last score found is the floor with which these
    queries, in blocks, meet all other shards. What a task returns is at most ``top`` rows per query.

    Vectors that are null or hold null or non-finite components, and rows without id, take no part. Shorter
    vectors count as filled up with zeros. Rows with the query's id are its own and no candidates; repeated
    rows count once. With fewer candidates than ``top`` all are returned; ties go to the smaller id. An empty
    table or no query gives an empty result; other columns are not looked at. Scores must fit 64 bits.
    """
    floors = F.transform(F.col(vector).cast("array<double>"), lambda x: F.floor(x * scale).cast("double"))
    rows = table.filter(F.col(identity).isNotNull() & is_finite(F.col(vector).cast("array<double>")))
    rows = rows.select(
        F.col(identity).cast("long").alias("vec_id"), floors.alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks")
    )
    size = rows.agg(F.count("*").alias("rows"), F.max(F.size("vector")).alias("width")).first()
    if not size["rows"]:
        return table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    shards, width = max(1, round(size["rows"] / SHARD)), size["width"]
    # Rows of one id and vector lie in one shard, where they count once.
    rows = spool(rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")), "search-rows")

    def unpack(part: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids = part.column("vec_id").to_numpy()
        vectors = matrix(part.column("vector"), width)
        packed = np.column_stack((ids, (vectors + 0.0).view(np.int64)))
        _, first = np.unique(packed, axis=0, return_index=True)
        first.sort()
        return ids[first], vectors[first], part.column("asks").to_numpy(zero_copy_only=False)[first]

    def at_home(part: pa.Table) -> pa.Table:
        ids, vectors, asks = unpack(part)
        if not asks.any():
            return _found(ids[:0], [])
        lowest = np.full(int(asks.sum()), -np.inf)
        return _found(ids[asks], search(BallTree(vectors), ids, vectors[asks], ids[asks], top, lowest))

    home = spool(rows.groupBy("shard").applyInArrow(at_home, _FOUND), "search-home")
    if shards == 1:
        return _ranked(home, top)
    reached = home.groupBy("query_id").agg(F.min("score").alias("least"), F.count("*").alias("found"))
    reached = reached.select("query_id", F.when(F.col("found") >= top, F.col("least")).alias("floor"))
    queries = rows.filter("asks").join(reached, F.col("vec_id") == F.col("query_id"), "left")
    count = rows.filter("asks").select("vec_id").count()
    blocks = max(1, round(count / QUERY_BLOCK))
    # Named apart from the candidates, which are rows of the same table.
    queries = queries.select(
        F.col("vec_id").alias("query_id"),
        F.col("vector").alias("query"),
        F.col("shard").alias("home"),
        F.col("floor").cast("double").alias("least"),
        F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int").alias("at_block"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("at_shard"),
    ).filter("at_shard <> home")
    candidates = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def elsewhere(ours: pa.Table, theirs: pa.Table) -> pa.Table:
        ids, vectors, _ = unpack(ours)
        own = theirs.column("query_id").to_numpy()
        if not len(ids) or not len(own):
            return _found(own[:0], [])
        floor = theirs.column("least").fill_null(-np.inf).to_numpy()
        return _found(own, search(BallTree(vectors), ids, matrix(theirs.column("query"), width), own, top, floor))

    met = candidates.groupBy("shard", "block").cogroup(queries.groupBy("at_shard", "at_block"))
    return _ranked(home.unionByName(met.applyInArrow(elsewhere, _FOUND)), top)
