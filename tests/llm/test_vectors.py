"""Embedding links and top-k search against all pairs."""

import math
from fractions import Fraction

import numpy as np
import pytest

from pyspark.sql import functions as F

from seqprep.llm import epsilon_join, topk
from seqprep.sources.package import ship_package

SCHEMA = "vec_id long, embedding array<float>, label int, pos int, block string, vector int, score int"


def frame(spark, rows):
    ship_package(spark)
    return spark.createDataFrame([(i, v, 1, 2, "b", 3, 4) for i, v in rows], SCHEMA).repartition(4)


def clouds(seed, count=300, width=8):
    random = np.random.default_rng(seed)
    rows = []
    for centre in random.normal(size=(12, width)):
        for _ in range(random.integers(1, count // 8)):
            rows.append((centre + random.normal(size=width) * random.choice((0.02, 0.12, 0.3))).tolist())
    rows += [rows[0], [2 * x for x in rows[1]], [-x for x in rows[2]]]
    return [(3 * number + 1, row) for number, row in enumerate(rows)]


def usable(vector):
    return vector is not None and len(vector) > 0 and all(x is not None and math.isfinite(x) for x in vector)


def expected_links(rows):
    ids, links, parent = [i for i, _ in rows], [0] * len(rows), list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    exact = [np.array(np.array(v, np.float32), np.float64) if usable(v) else None for _, v in rows]
    for i, one in enumerate(exact):
        for j in range(i):
            two = exact[j]
            if one is None or two is None or len(one) != len(two) or not one.any() or not two.any():
                continue
            if one @ two / (np.sqrt(one @ one) * np.sqrt(two @ two)) >= 0.95:
                links[i] += 1
                links[j] += 1
                parent[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, identity in enumerate(ids):
        if identity is not None:
            least[find(i)] = min(least.get(find(i), identity), identity)
    named = [least.get(find(i)) for i in range(len(rows))]
    return sorted(((i, n, c, i == c and i is not None) for i, n, c in zip(ids, links, named)), key=str)


def run_links(spark, rows):
    return sorted((tuple(row) for row in epsilon_join.embedding_links(frame(spark, rows)).collect()), key=str)


@pytest.mark.parametrize("block", [2048, 16])
def test_links_match_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(epsilon_join, "BLOCK", block)
    monkeypatch.setattr(epsilon_join, "STRIP", 2)
    rows = clouds(3)
    assert run_links(spark, rows) == expected_links(rows)


def test_copies_of_a_vector_are_joined_as_one(spark, monkeypatch):
    """Most rows are copies of three vectors, two of which are linked; ids repeat and are missing."""
    rows = clouds(4, 60)
    many = [rows[0][1], [x + 1e-3 for x in rows[0][1]], rows[-1][1]]
    rows += [(1000 + number, many[number % 3]) for number in range(400)] + [(None, many[0]), (1000, many[0]), (None, rows[5][1])]
    joined = []
    compare = epsilon_join._sequence
    monkeypatch.setattr(epsilon_join, "_sequence", lambda vectors, *rest: joined.append(vectors.count()) or compare(vectors, *rest))
    assert run_links(spark, rows) == expected_links(rows)
    assert joined == [len({tuple(np.float32(vector)) for _, vector in rows})]


def test_interval_join_at_every_leaf_size(monkeypatch):
    random = np.random.default_rng(1)
    rows = np.repeat(random.normal(size=(20, 3)), 6, axis=0) + random.normal(size=(120, 3)) * 0.1
    lengths = np.full(len(rows), 3)
    unit = rows / np.linalg.norm(rows, axis=1)[:, None]
    linked = (unit @ unit.T >= 0.95) & ~np.eye(len(rows), dtype=bool)
    for leaf in (1, 3, 128):
        monkeypatch.setattr(epsilon_join, "LEAF", leaf)
        task = epsilon_join.IntervalJoin((rows, lengths, np.ones(len(rows), np.int64)), None, np.eye(3), 0.95)
        task.join(0, len(rows), 0, len(rows))
        links, labels = task.result()
        assert links.tolist() == linked.sum(1).tolist()
        assert (labels[np.nonzero(linked)[0]] == labels[np.nonzero(linked)[1]]).all()


ODD = [
    (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]),
    (7, [1.0, 0.0]), (8, [1.0, 0.0, 0.0]), (9, [2.0, 0.0]), (9, [2.0, 0.0]), (None, [1.0, 0.01]), (10, [-1.0, 0.0]),
]


def test_links_of_odd_vectors(spark):
    assert run_links(spark, ODD) == expected_links(ODD)


def test_links_of_one_vector_and_of_none(spark):
    assert run_links(spark, [(5, [1.0, 2.0])]) == [(5, 0, 5, True)]
    assert run_links(spark, [(5, None)]) == [(5, 0, 5, True)]
    assert run_links(spark, []) == []


def expected_top(rows, divisor, top=5):
    whole = {}
    for identity, vector in rows:
        if identity is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            scaled = tuple(math.floor(Fraction(float(np.float32(x))) * 256) for x in vector)
            whole.setdefault((identity, scaled), None)
    result = set()
    for query, x in whole:
        if query % divisor:
            continue
        pool = {}
        for (own, one) in whole:
            if own == query:
                scores = [(-sum(a * b for a, b in zip(one, two)), i) for (i, two) in whole if i != query]
                pool.update(dict.fromkeys(scores))
        for rank, (minus, found) in enumerate(sorted(pool)[:top], start=1):
            result.add((query, rank, found, -minus))
    return sorted(result)


def run_top(spark, rows, divisor):
    found = topk.top_inner_products(frame(spark, rows), F.col("vec_id") % divisor == 0)
    return sorted(tuple(row) for row in found.collect())


@pytest.mark.parametrize("shard", [8192, 20])
def test_top_matches_all_pairs(spark, monkeypatch, shard):
    monkeypatch.setattr(topk, "SHARD", shard)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 10)
    rows = [(i, [round(x * 4) / 256 for x in v]) for i, v in clouds(5)]  # many ties
    assert run_top(spark, rows, 7) == expected_top(rows, 7)


def test_top_of_odd_vectors(spark):
    rows = ODD + [(14, [0.5, 0.25]), (14, [0.5, 0.25]), (21, [1e18, 3.0])]
    rows = [(i, v) for i, v in rows]
    assert run_top(spark, rows[:-1], 7) == expected_top(rows[:-1], 7)


def test_scores_beyond_double_precision():
    rows = np.array([[2.0**40, 1.0], [2.0**40, 3.0], [1.0, 1.0]])
    found = topk.search(topk.BallTree(rows), np.array([1, 2, 3]), np.array([[2.0**20, 1.0]]), np.array([9]), 2, np.array([-np.inf]))
    assert sorted(found[0]) == [(2**60 + 1, 1), (2**60 + 3, 2)]


def test_top_without_rows_or_queries(spark):
    assert run_top(spark, [], 2) == []
    assert run_top(spark, [(1, [1.0]), (3, [1.0])], 2) == []
    assert run_top(spark, [(2, [1.0])], 2) == []
