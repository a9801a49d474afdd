"""Language-model scores: exact counts by brute force, the filter's errors, odd input."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from seqprep.llm import bloom_lm
from seqprep.sources.package import ship_package

TEXTS = [None, "", " \n", "One two  THREE", "one two three", "one two", "é É", "x" * 3000, "one " * 3000]


def corpus(count=200, seed=4):
    rng = random.Random(seed)
    pool = [f"w{int(rng.paretovariate(1.1))}" for _ in range(4000)]
    return TEXTS + [" ".join(rng.choices(pool, k=rng.randint(0, 60))) for _ in range(count)]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


def frame(spark, rows):
    ship_package(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return docs.selectExpr("*", "1 AS m", "2 AS row", "3 AS score", "4 AS n_tokens", "5 AS key")


@pytest.mark.parametrize("hot", [1 << 20, 30, 0])
def test_base_scores_match_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(bloom_lm, "HOT_WORDS", hot)
    monkeypatch.setattr(bloom_lm, "SHARD_BYTES", 500)
    rows = list(enumerate(corpus())) + [(None, "one unknown"), (3, "again"), (3, "again")]
    docs = frame(spark, rows)
    model, rare = bloom_lm.train(docs.filter("doc_id % 7 <> 2"))
    found = sorted((tuple(r) for r in bloom_lm.score(docs, model, rare).collect()), key=str)
    counts = Counter(w for i, text in rows if i is not None and i % 7 != 2 for w in words(text))
    total, distinct = sum(counts.values()), len(counts)
    expected = []
    for identity, text in rows:
        own = words(text)
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in own)
        expected.append((identity, len(own), sum(w in counts for w in own), total, base))
    expected.sort(key=str)
    key = lambda r: (str(r[0]), r[1], r[2])
    for one, two in zip(sorted(found, key=key), sorted(expected, key=key)):
        assert one[:4] == two[:4] and one[4] == pytest.approx(two[4]) and one[5] < 0


def test_model_beats_the_base_on_its_own_text(spark):
    rows = [(i, "the cat sat on the mat and the dog sat on the log") for i in range(30)]
    docs = frame(spark, rows)
    model, rare = bloom_lm.train(docs)
    found = bloom_lm.score(docs, model, rare).first()
    assert found["score"] > found["base_score"]


def test_filter_never_reads_too_little_and_seldom_too_much():
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(0, 1 << 63, 20_000, dtype=np.uint64))
    counts = rng.zipf(1.5, len(keys)).clip(1, 10**6).astype(np.int64)
    for most in (1 << 30, 1 << 15):
        segment, cutoff = bloom_lm.build_segment(keys, counts, most)
        bits = np.frombuffer(segment, np.uint8)
        assert 8 * len(bits) <= most
        model = bloom_lm.BloomModel(
            64, np.zeros(1, np.int64), np.array([8 * len(bits) - 1], np.uint64), np.array([float(cutoff)]), bits, keys[:0], counts[:0], 1, 1
        )
        levels = bloom_lm.levels_of(counts, cutoff)
        right = bloom_lm.count_of(levels, np.full(len(keys), float(cutoff)))
        read = model.counts(keys)
        assert (read >= right).all()
        assert (read > right).mean() < 0.1
        assert (model.counts(rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)) > 0).mean() < 0.1
    assert cutoff > 1


def test_no_training_text_and_no_rows(spark):
    docs = frame(spark, [(1, "a b"), (2, None)])
    model, rare = bloom_lm.train(docs.filter("false"))
    found = {r["doc_id"]: r for r in bloom_lm.score(docs, model, rare).collect()}
    assert found[1]["n_tokens"] == 3 and found[2]["n_tokens"] == 1
    assert found[1]["n_known"] == found[1]["train_tokens"] == found[1]["base_score"] == 0
    assert bloom_lm.score(docs.filter("false"), model, rare).collect() == []
