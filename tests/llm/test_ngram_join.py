"""The n-gram join against all pairs."""

import random
import re
from pathlib import Path
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pytest

from seqprep.llm import ngram_join
from seqprep.sources.package import ship_package


def shingles(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def expected(rows, percent=90, size=3):
    sets = [shingles(text, size) if i is not None else frozenset() for i, text in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (identity, _) in enumerate(rows):
        if identity is not None:
            least[find(i)] = min(least.get(find(i), identity), identity)
    return sorted(
        (
            (identity, len(shingles(text, size)), least[find(i)] if identity is not None else None)
            for i, (identity, text) in enumerate(rows)
        ),
        key=str,
    )


def corpus(seed, families=12, copies=12, words=60):
    random.seed(seed)
    letters = [f"w{i}" for i in range(400)]
    common = random.choices(letters, k=25)
    texts = ["", None, " \t\n", "one", "One", "one two", "ONE two", "a b c", "a  b\tc", "é é é", "x" * 5000]
    for _ in range(families):
        base = random.choices(letters, k=random.randint(3, words))
        if random.random() < 0.4:
            base = base[:10] + common + base[10:]
        for _ in range(random.randint(1, copies)):
            near = list(base)
            for _ in range(random.choice((0, 0, 1, 1, 2, 3))):
                near[random.randrange(len(near))] = random.choice(letters)
            if random.random() < 0.2:
                near.append(random.choice(letters))
            texts.append(random.choice((" ", "\n", "  ")).join(near))
    random.shuffle(texts)
    return texts


def run(spark, rows, **options):
    ship_package(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    docs = docs.selectExpr("doc_id", "text", "1 AS n", "'x' AS component", "2 AS set_key", "3 AS id")
    return sorted((tuple(row) for row in ngram_join.ngram_join(docs, **options).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_all_pairs(spark, seed):
    rows = [(100 - i, text) for i, text in enumerate(corpus(seed))]
    assert run(spark, rows) == expected(rows)


def test_low_threshold(spark):
    rows = list(enumerate(corpus(3)))
    assert run(spark, rows, percent=60, size=2) == expected(rows, 60, 2)


def test_groups_above_every_limit(spark, monkeypatch):
    """Stars, hot shingles, several tiles a group, leaders and stragglers."""
    monkeypatch.setattr(ngram_join, "PAIRED", 2)
    monkeypatch.setattr(ngram_join, "HOT_ROWS", 3)
    monkeypatch.setattr(ngram_join, "HOT_SHARE", 1 << 30)
    monkeypatch.setattr(ngram_join, "TILE_SETS", 3)
    rows = list(enumerate(corpus(4, families=4, copies=30, words=40)))
    assert run(spark, rows) == expected(rows)


def test_nulls_and_repeated_rows(spark):
    long = " ".join(f"v{i}" for i in range(40))
    rows = [(7, long), (7, long), (3, long), (None, long), (None, None), (5, None), (5, ""), (9, "a b c"), (9, "d e f")]
    assert run(spark, rows) == expected(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_wholly_different_sets_with_equal_sizes_stay_apart(spark):
    rows = [(i, " ".join(f"{i}-{j}" for j in range(30))) for i in range(20)]
    assert {row[2] for row in run(spark, rows)} == set(range(20))


def test_unrelated_texts_that_share_frequent_shingles_are_not_compared(spark, monkeypatch):
    """Few words, so every shingle is in several texts, more than are paired one by one."""
    monkeypatch.setattr(ngram_join, "PAIRED", 3)
    compared, compare = [], ngram_join._compare

    def counted(rows, percent):
        compared.append(rows.select("set_key").distinct().count())
        return compare(rows, percent)

    monkeypatch.setattr(ngram_join, "_compare", counted)
    random.seed(6)
    letters = [f"w{i}" for i in range(12)]
    texts = [" ".join(random.choices(letters, k=40)) for _ in range(300)]
    near = [f"{text} w1" for text in texts[:3]]
    rows = list(enumerate(texts + near))
    assert run(spark, rows) == expected(rows)
    assert 6 <= sum(compared) < 20


def test_crowded_shingles_lose_no_link(spark, monkeypatch):
    """One pair a set makes a crowd; sizes differ, so counts of different width meet."""
    monkeypatch.setattr(ngram_join, "PAIRS_A_SET", 0)
    monkeypatch.setattr(ngram_join, "CELL_SIZE", 1)
    monkeypatch.setattr(ngram_join, "CELLS", 8)
    rows = list(enumerate(corpus(7, families=6, copies=20)))
    assert run(spark, rows) == expected(rows)
    assert run(spark, rows, percent=60, size=2) == expected(rows, 60, 2)


def packed(sets):
    bounds = np.concatenate(([0], np.cumsum([len(members) for members in sets])))
    return ngram_join._packed_counts(np.concatenate(sets), bounds)


def test_cell_counts_of_large_sets_tell_unrelated_ones_apart():
    """Also where one has twice the cells of the other; a copy with members exchanged stays within the bound."""
    make = np.random.default_rng(3)
    for percent in (80, 90):
        for n, m in ((20, 20), (500, 520), (1000, 1100), (3000, 3000), (20_000, 18_100)):
            one, two = (make.integers(0, 1 << 63, size, dtype=np.uint64) for size in (n, m))
            changed = np.concatenate((one[: n - n // 20], two[: n // 20]))
            counts = packed([one, two, changed])
            cells = int(ngram_join._cell_widths(counts).min())
            table = ngram_join._folded(counts, cells)
            apart = ngram_join.least_difference(table[[0, 0]], table[[1, 2]])
            needed = ngram_join.least_overlap(np.array([n]), np.array([m]), percent)[0]
            assert apart[0] > n + m - 2 * needed and apart[1] <= 2 * (n // 20)


def test_a_crowd_gives_fewer_edges_than_sets():
    make = np.random.default_rng(4)
    base = make.integers(0, 1 << 63, 200, dtype=np.uint64)
    near = [np.concatenate((base[:195], make.integers(0, 1 << 63, 5, dtype=np.uint64))) for _ in range(300)]
    other = [make.integers(0, 1 << 63, 200, dtype=np.uint64) for _ in range(300)]
    n, pos = np.full(600, 200), np.zeros(600, np.int64)
    u, v = ngram_join.tie_group(n, pos, packed(near + other), 90)
    assert len(u) == 299 and max(u.max(), v.max()) < 300
    assert len(ngram_join.tie_group(n, pos + 100, packed(near + other), 90)[0]) == 0
    assert isinstance(packed(near), pa.BinaryArray)


def test_only_components_and_sets_stay_stored(spark):
    """Prefixes and pairs are emptied when candidates are known, and only texts of candidates are joined."""
    random.seed(8)
    rows = [(i, " ".join(f"v{random.randrange(10**6)}" for _ in range(30))) for i in range(200)]
    rows.append((900, rows[0][1] + " end"))
    stored, joined, spool, mark = [], [], ngram_join.spool, ngram_join.maybe_among

    def kept(df, name, **options):
        frame = spool(df, name, **options)
        stored.extend((name, file) for file in frame.inputFiles())
        return frame

    def marked(*arguments):
        found = mark(*arguments)
        joined.append(found.count())
        return found

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(ngram_join, "spool", kept)
        patch.setattr(ngram_join, "maybe_among", marked)
        assert run(spark, rows) == expected(rows)
    assert joined and max(joined) < 10
    left = {name for name, file in stored if Path(urlparse(file).path).exists()}
    assert "join-sets" in left and not left & {"join-prefixes", "join-pairs"} and "join-prefixes" in dict(stored)
