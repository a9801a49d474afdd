"""Factorisation machine: identity, learning, odd input."""

import random

import numpy as np
import pyarrow as pa
import pytest

from seqprep.llm import quality
from seqprep.llm.text import chunks
from seqprep.sources.package import ship_package


def corpus(count=300, seed=1):
    rng = random.Random(seed)
    rows = []
    for number in range(count):
        words = ["".join(rng.choices(["ba", "ke", "lo", "mi", "tu"], k=rng.randint(1, 4))) for _ in range(rng.randint(5, 80))]
        good = number % 3 > 0
        text = " ".join(words) + "." if good else rng.choice((" | ".join(words), " ".join(words[:2] * 40), "!! ".join(words).upper()))
        rows.append((number, text, int(good)))
    return rows


def frames(spark, rows):
    ship_package(spark)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    docs = docs.selectExpr("*", "1 AS label", "2 AS id", "3 AS quality_score", "4 AS quality").repartition(3)
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")
    return docs, labels.selectExpr("*", "0 AS toxic", "'x' AS text", "5 AS id")


def test_pairwise_terms_in_linear_time():
    chunk = next(chunks(pa.array(["a b c a", "", "x | y | z!! Q1\n", None, "é" * 50])))
    rows = quality.features(chunk)
    random = np.random.default_rng(3)
    size = quality.BUCKETS + quality.STATISTICS
    machine = quality.FactorisationMachine(
        0.3, random.normal(size=size), random.normal(size=(size, quality.FACTORS)), np.full(quality.STATISTICS, 0.1), np.full(quality.STATISTICS, 0.5)
    )
    extra = machine.standard(rows.statistics)
    for number, logit in enumerate(machine.logit(rows)):
        part = slice(rows.bounds[number], rows.bounds[number + 1])
        ids = np.concatenate((rows.buckets[part], np.arange(quality.BUCKETS, size)))
        x = np.concatenate((rows.values[part], extra[number]))
        plain = machine.bias + machine.linear[ids] @ x
        for i in range(len(ids)):
            for j in range(i):
                plain += machine.factors[ids[i]] @ machine.factors[ids[j]] * x[i] * x[j]
        assert logit == pytest.approx(plain)


def test_held_out_labels(spark):
    rows = corpus()
    docs, labels = frames(spark, rows)
    machine = quality.train(docs, labels, keep=labels.doc_id % 5 != 0)
    found = {r["doc_id"]: r["quality_score"] for r in quality.score(docs, machine).collect()}
    held = [(found[i] >= quality.THRESHOLD) == bool(q) for i, _, q in rows if i % 5 == 0]
    assert sum(held) / len(held) > 0.95


def test_odd_texts(spark):
    rows = corpus(60) + [(100, None, 1), (101, "", 0), (102, "\x00 \t", 1), (103, "ba ke lo. " * 20_000, 1), (None, "ba ke", 1), (5, "again", None)]
    docs, labels = frames(spark, rows + [rows[0]])
    machine = quality.train(docs, labels)
    found = quality.score(docs, machine).collect()
    assert len(found) == len(rows) + 1 and all(0 <= r["quality_score"] <= 1 for r in found)
    scores = {r["doc_id"]: r["quality_score"] for r in found}
    assert scores[100] == scores[101]


def test_one_label_no_labels_no_rows(spark):
    docs, labels = frames(spark, [(i, "a b", 1) for i in range(5)])
    assert all(r["quality_score"] > 0.5 for r in quality.score(docs, quality.train(docs, labels)).collect())
    machine = quality.train(docs, labels.filter("false"))
    assert {r["quality_score"] for r in quality.score(docs, machine).collect()} == {0.5}
    assert quality.score(docs.filter("false"), machine).collect() == []
