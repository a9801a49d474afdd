"""Connected components of an edge table, as joins and aggregations."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from seqprep.sources.spool import spool


class Forest:
    """Union-find over ``size`` places of one task's rows; the smallest place leads its set."""

    def __init__(self, size: int) -> None:
        self.parent = list(range(size))

    def find(self, place: int) -> int:
        parent = self.parent
        while parent[place] != place:
            parent[place] = parent[parent[place]]
            place = parent[place]
        return place

    def join(self, left: int, right: int) -> None:
        left, right = self.find(left), self.find(right)
        if left != right:
            self.parent[max(left, right)] = min(left, right)

    def leaders(self) -> np.ndarray:
        return np.array([self.find(place) for place in range(len(self.parent))], dtype=np.int64)


def _are_stars(edges: DataFrame) -> bool:
    """Whether every larger end ``u`` has one edge only and is nobody's smaller end ``v``."""
    several = edges.groupBy("u").agg(F.count("*").alias("edges")).filter("edges > 1").select("u")
    between = edges.select("u").join(edges.select(F.col("v").alias("u")).distinct(), "u", "left_semi")
    return several.unionByName(between).isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v: long) to (node, component): every node of an edge, with its component's smallest node.

    Alternating star contraction: every node points its larger neighbours, then its smaller ones, to the
    smallest node that it knows, until all edges lead to the smallest node of their component. A round moves rows of two longs, stores them in the
    shared folder, and never holds a node's neighbours in one place; minima are pre-aggregated and the joins
    back may be split by Spark where one node has most of the edges. Loops, repeated edges and nulls add
    nothing; an empty table gives an empty result.
    """
    u, v = F.greatest("u", "v"), F.least("u", "v")
    stored = spool(
        edges.dropna(subset=["u", "v"]).select(u.alias("u"), v.alias("v")).filter("u <> v").distinct(), "edges"
    )
    while not _are_stars(stored):
        both = stored.select(F.col("u").alias("a"), F.col("v").alias("b")).unionByName(
            stored.select(F.col("v").alias("a"), F.col("u").alias("b"))
        )
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # Stored minima meet the edges in a join of its own, which Spark may split by node.
        large = both.join(spool(least, "edges"), "a").filter("b > a").select(F.col("b").alias("u"), F.col("m").alias("v"))
        large = spool(large, "edges")
        lowest = spool(large.groupBy("u").agg(F.min("v").alias("m")), "edges")
        small = (
            large.join(lowest, "u")
            .filter("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(lowest.select("u", F.col("m").alias("v")))
        )
        stored = spool(small.distinct(), "edges")
    return stored.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        stored.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
