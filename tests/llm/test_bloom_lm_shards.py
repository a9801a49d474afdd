"""Pair and word counts behind the score, whatever their number."""

from collections import Counter

import numpy as np
import pytest

from seqprep.llm import bloom_lm
from tests.llm.test_bloom_lm import corpus, frame, words


@pytest.mark.parametrize("hot", [1 << 20, 0])
def test_scores_hold_every_pair_at_any_filter_size(spark, monkeypatch, hot):
    monkeypatch.setattr(bloom_lm, "FILTER_BYTES", 1024, raising=False)  # a limit the filter had
    monkeypatch.setattr(bloom_lm, "HOT_WORDS", hot)
    monkeypatch.setattr(bloom_lm, "SHARD_BYTES", 2000)
    monkeypatch.setattr(bloom_lm, "GROUP_BYTES", 1500, raising=False)
    rows = list(enumerate(corpus()))
    docs = frame(spark, rows)
    model, shards = bloom_lm.train(docs.filter("doc_id % 7 <> 2"))
    found = {r["doc_id"]: r["score"] for r in bloom_lm.score(docs, model, shards).collect()}
    counted = [words(text) for i, text in rows if i % 7 != 2]
    single = Counter(w for text in counted for w in text)
    pairs = Counter(pair for text in counted for pair in zip([None, *text], text))
    total = sum(single.values()) + len(single) + 1
    gaps = []
    for i, text in rows:
        own = words(text)
        before = np.array([single[w] for w in [None, *own[:-1]]], float)
        levels = bloom_lm.levels_of(np.array([pairs[p] for p in zip([None, *own], own)]), 1)
        both = np.minimum(bloom_lm.count_of(levels, np.ones(len(levels))), before)
        alone = np.array([single[w] + 1 for w in own]) / total
        logs = np.log10((both + bloom_lm.PRIOR * alone) / (before + bloom_lm.PRIOR))
        gaps.append((found[i] - logs.sum()) / len(own))
    # A Bloom filter reads too much at times (one in 40 at 8 bits and 4 probes), never too little.
    assert min(gaps) > -1e-9 and np.median(gaps) < 0.05


def test_more_text_scored_than_counted(spark, monkeypatch):
    monkeypatch.setattr(bloom_lm, "SHARD_BYTES", 20)
    rows = list(enumerate(corpus()))
    docs = frame(spark, rows)
    model, shards = bloom_lm.train(docs.filter("doc_id = 5"))
    few = {r["doc_id"]: r for r in bloom_lm.score(docs.filter("doc_id < 40"), model, shards).collect()}
    many = {r["doc_id"]: r for r in bloom_lm.score(docs, model, shards).collect()}
    assert len(many) == len(rows) and all(many[i] == few[i] for i in few)


def test_packed_keys():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 64, 500, dtype=np.uint64))
    for some in (keys, keys[:0], keys[-1:]):
        assert (bloom_lm.unpack_keys(bloom_lm.pack_keys(some)) == some).all()
