"""Centroid clustering against plain rounds over all distances."""

import hashlib
import math

import numpy as np
import pytest

from seqprep.llm import ptolemaic
from seqprep.sources.package import ship_package

SCHEMA = "vec_id long, embedding array<double>, cluster int, point string, near int, distance int, inertia int"


def frame(spark, rows):
    ship_package(spark)
    return spark.createDataFrame([(i, v, 1, "p", 2, 3, 4) for i, v in rows], SCHEMA).repartition(3)


def expected(rows, clusters, rounds, width):
    kept = [
        (i, [math.floor(256 * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)
    ]
    mark = lambda entry: (hashlib.sha256(f"2:{'' if entry[0] is None else entry[0]}".encode()).hexdigest(), entry[1])
    centroids = [v for _, v in sorted(kept, key=mark)[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), number) for number, c in enumerate(centroids))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for number in set(own):
            members = [v for (_, v), c in zip(kept, own) if c == number]
            centroids[number] = [sum(column) // len(members) for column in zip(*members)]
    found = [(i, *nearest(v)) for i, v in kept]
    sums = {c: sum(d for _, d, other in found if other == c) for _, _, c in found}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, sums[c], sum(sums.values()), names[c]) for i, d, c in found), key=str)


def run(spark, rows, **options):
    found = ptolemaic.cluster_vectors(frame(spark, rows), **options)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(row) for row in found.collect()), key=str)


@pytest.mark.parametrize("scale", [0.01, 1.0, 4e4])
def test_rounds_match_plain_ones(spark, scale):
    random = np.random.default_rng(4)
    rows = [(i, (random.normal(size=5) * scale + 3 * scale * (i % 4)).tolist()) for i in range(160)]
    rows += [(i, rows[i][1]) for i in range(30)] + [(500 + i, rows[0][1]) for i in range(40)]  # repeated rows and copies
    rows += [(None, rows[3][1]), (900, None), (901, []), (902, [1.0] * 4), (903, [1.0] * 4 + [None])]
    rows += [(904, [1.0] * 4 + [math.nan]), (905, [math.inf] * 5), (906, [0.0] * 5)]
    assert run(spark, rows, clusters=7, rounds=4, width=5) == expected(rows, 7, 4, 5)


def test_fewer_vectors_than_clusters_and_none(spark):
    rows = [(i, [float(i), -float(i)]) for i in range(5)]
    assert run(spark, rows, width=2) == expected(rows, 40, 5, 2)
    equal = [(i, [1.0, 2.0]) for i in range(50)]
    assert run(spark, equal, width=2) == expected(equal, 40, 5, 2)
    assert run(spark, [(1, None)]) == [] and run(spark, []) == []


def test_bounds_never_exceed_distances_and_save_some():
    random = np.random.default_rng(8)
    centres = random.integers(-900, 900, size=(12, 16))
    points = (centres[random.integers(0, 12, 800)] + random.integers(-40, 40, size=(800, 16))).astype(np.int64)
    points[:40] = points[0]
    known = ptolemaic.Assignment(points[::67], ptolemaic.choose_pivots(points[::67], 6))
    near = ptolemaic.to_pivots(points, known.pivots)
    exact = np.stack([ptolemaic.distances(points, c) for c in known.centroids], axis=1)
    assert (known.bounds(near) ** 2 <= exact * (1 + 1e-15)).all()
    cluster, least, checked = known.nearest(points, near)
    assert (cluster == exact.argmin(1)).all() and (least == exact.min(1)).all()
    assert checked < exact.size / 2


def test_components_too_large_are_refused(spark):
    with pytest.raises(Exception, match="exceeds"):
        run(spark, [(1, [1e30, 0.0])], width=2)
