"""Source mix: targets by hand, thresholds, reruns."""

import random

import pytest

from seqprep.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, digits int, at int, words int, left int, bucket int"


def mixed(spark, rows, **options):
    docs = spark.createDataFrame([(*row, "x", 1, 2, 3, 4, 5) for row in rows], SCHEMA).repartition(3)
    return [row.asDict() for row in mixing.mix_sources(docs, **options).collect()]


def expected_targets(sizes, weights=(3, 1, 2)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {name: weights[place % len(weights)] for place, name in enumerate(names)}
    budget, fixed, open_names = 1.5 * sum(sizes.values()), {}, set(names)
    while open_names:
        share = {n: (budget - sum(fixed.values())) * weight[n] / sum(weight[m] for m in open_names) for n in open_names}
        over = {n for n in open_names if share[n] >= 2 * sizes[n]}
        if not over:
            return fixed | share
        fixed |= {n: 2.0 * sizes[n] for n in over}
        open_names -= over
    return fixed


def corpus(seed, count=400):
    random.seed(seed)
    names = ["a", "B", "é", "zz", None, "tiny"]
    rows = [(i, " ".join(["w"] * random.randint(0, 40)), random.choices(names, [30, 8, 5, 4, 3, 0.2])[0]) for i in range(count)]
    return rows + [(1000, None, "a"), (1001, "", "only empty"), (1002, " \t\n\v\f\r ", "only empty"), (1003, "w " * 9000, "zz")]


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_and_amounts(spark, seed):
    rows = corpus(seed)
    found = mixed(spark, rows)
    assert sorted(r["doc_id"] for r in found) == sorted(r[0] for r in rows)
    text = {i: t for i, t, _ in rows}
    sizes = {}
    for r in found:
        assert r["size"] == len((text[r["doc_id"]] or "").split())
        assert r["taken"] in {0, r["size"], 2 * r["size"]} and r["copies"] in (0, 1, 2)
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    targets = expected_targets(sizes)
    for source, size in sizes.items():
        own = [r for r in found if r["source"] == source]
        assert all(r["source_size"] == size and r["target"] == pytest.approx(targets[source]) for r in own)
        largest = max(r["size"] for r in own)
        assert abs(sum(r["taken"] for r in own) - targets[source]) <= max(1, largest / 2 + 1e-6)


def test_reruns_agree_and_partitioning_does_not_matter(spark):
    rows = corpus(3)
    key = lambda r: r["doc_id"]
    first = sorted(mixed(spark, rows), key=key)
    random.shuffle(rows)
    assert sorted(mixed(spark, rows), key=key) == first


def test_repeated_rows_and_null_ids_stand_or_fall_together(spark):
    rows = [(1, "a b c", "s")] * 5 + [(None, "a b", "s")] * 3 + [(2, "a", "t")] * 4
    found = mixed(spark, rows)
    assert len(found) == len(rows)
    for identity in (1, None, 2):
        assert len({r["taken"] for r in found if r["doc_id"] == identity}) == 1


def test_no_words_at_all_and_no_rows(spark):
    assert [(r["target"], r["taken"]) for r in mixed(spark, [(1, None, None), (2, "", "s")])] == [(0.0, 0), (0.0, 0)]
    assert mixed(spark, []) == []
