"""Connected components against union-find."""

import random

from seqprep.llm.components import Forest, connected_components


def test_matches_union_find(spark):
    rng = random.Random(1)
    edges = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(300)] + [(i, i + 1) for i in range(1000, 1080)]
    edges += [(2000, i) for i in range(2001, 2100)] + [(5, 5), (None, 3), (7, None)]
    forest = Forest(2200)
    nodes = set()
    for u, v in edges:
        if u is not None and v is not None and u != v:
            forest.join(u, v)
            nodes |= {u, v}
    found = connected_components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert sorted((r["node"], r["component"]) for r in found) == sorted((n, forest.find(n)) for n in nodes)


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "u long, v long")).collect() == []
