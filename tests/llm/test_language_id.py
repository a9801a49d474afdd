"""Language ID: codes, held-out accuracy, odd input."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from seqprep.llm import language_id
from seqprep.sources.package import ship_package

PARTS = {"aa": "the ing and of tion er".split(), "bb": "ung ein sch ß der ich".split(), "cc": "ción ñ el que os ar".split()}


def sentence(lang, words, rng):
    return " ".join("".join(rng.choices(PARTS[lang], k=rng.randint(1, 3))) for _ in range(words))


def corpus(count=240, seed=1, langs=("aa", "bb", "cc")):
    rng = random.Random(seed)
    rows = []
    for number in range(count):
        lang = langs[number % len(langs)]
        rows.append((number, sentence(lang, rng.randint(4, 60), rng), lang))
    return rows


def frame(spark, rows):
    ship_package(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return docs.selectExpr("*", "1 AS place", "2 AS rows", "'x' AS language", "3 AS score", "'y' AS lang_pred").repartition(3)


@pytest.mark.parametrize("languages", [1, 2, 3, 5, 6, 40])
def test_codewords_differ(languages):
    code = language_id.codewords(languages)
    assert code.shape[0] == languages and set(np.unique(code)) <= {-1.0, 1.0}
    apart = (code[:, None, :] != code[None, :, :]).sum(2) + languages * np.eye(languages, dtype=int) * 1000
    assert languages == 1 or apart.min() >= max(1, code.shape[1] // 4)


def test_held_out_accuracy(spark):
    docs = frame(spark, corpus())
    held = docs.doc_id % 4 == 2
    model = language_id.train(docs, keep=~held)
    rows = language_id.predict(docs.filter(held), model).select("lang", *language_id.columns()).collect()
    assert sum(r["lang"] == r[1] for r in rows) / len(rows) > 0.95
    assert all(0 <= r[2] <= 1 for r in rows)


def test_odd_texts(spark):
    rng = random.Random(2)
    rows = corpus(60) + [(500, None, "aa"), (501, "", "bb"), (502, "123 !? \n", "cc"), (503, sentence("bb", 30_000, rng), "bb"), (504, "ñ", None), (None, "the and ing", "aa")]
    docs = frame(spark, rows + [rows[0]])
    model = language_id.train(docs)
    found = language_id.predict(docs, model).select("doc_id", *language_id.columns()).collect()
    assert len(found) == len(rows) + 1
    by_id = {r[0]: r for r in found}
    assert [tuple(by_id[i])[1:3] for i in (500, 501, 502)] == [("und", 0.0)] * 3
    assert by_id[503][1] == "bb" and by_id[504][1] == "cc" and by_id[None][1] == "aa"
    assert len({tuple(r) for r in found if r[0] == rows[0][0]}) == 1


def test_texts_that_lie_between_languages_are_flagged(spark):
    docs = frame(spark, corpus(langs=("aa", "bb")))
    model = language_id.train(docs)
    between = frame(spark, [(1, "qqq", None), (2, sentence("aa", 50, random.Random(3)), None)])
    found = {r[0]: r[1] for r in language_id.predict(between, model).select("doc_id", "language.ambiguous").collect()}
    assert found[2] is False


def test_one_language_none_and_no_rows(spark):
    one = frame(spark, corpus(20, langs=("aa",)))
    assert {r[0] for r in language_id.predict(one, language_id.train(one)).select("language.lang_pred").collect()} == {"aa"}
    none = frame(spark, [(1, "words", None)])
    assert language_id.predict(none, language_id.train(none)).select(*language_id.columns()).first()[:2] == ("und", 0.0)
    empty = frame(spark, [])
    assert language_id.predict(empty, language_id.train(empty)).collect() == []


def _plain_margins(model, text):
    data = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    total = np.zeros(model.code.shape[1])
    for i in range(len(data) - 1):
        total += model.weights[data[i] | data[i + 1] << 8]
        if i + 2 < len(data):
            gram = data[i] | data[i + 1] << 8 | data[i + 2] << 16
            total += model.weights[language_id.BUCKETS + (gram * 0x9E3779B1 % (1 << 32) >> 16)]
    return total / max(len(data), 1) / model.scale


def _plain_decision(model, margins):
    """Share of every language and the nearest codeword, by the loss written out."""
    losses = []
    for word, trust in zip(model.code, model.trust):
        losses.append(sum(t * np.exp(-b * min(3, max(-3, m))) for b, t, m in zip(word, trust, margins)))
    weights = [np.exp(-4 * (loss - min(losses))) for loss in losses]
    shares = sorted((w / sum(weights) for w in weights), reverse=True)
    return losses.index(min(losses)), shares[0], shares[0] - shares[1]


@pytest.mark.parametrize("window", [1, 2, 5, 1 << 16])
def test_decoding_matches_brute_force(spark, monkeypatch, window):
    model = language_id.train(frame(spark, corpus(90)))
    monkeypatch.setattr(language_id, "WINDOW_BYTES", window)
    texts = [t for _, t, _ in corpus(12, seed=4)] + ["", None, "A", "ab", "Ab ", "ß", "THE ung", ""]
    (chunk,) = list(language_id.chunks(pa.array(texts)))
    margins = model.margins(chunk)
    best, share, lead, _ = model.decide(margins)
    for row, text in enumerate(texts):
        assert margins[row] == pytest.approx(_plain_margins(model, text), rel=1e-4, abs=1e-5)
        name, most, ahead = _plain_decision(model, margins[row])
        assert (best[row], share[row], lead[row]) == (name, pytest.approx(most), pytest.approx(ahead))


def test_ambiguous_texts_are_flagged_somewhere(spark):
    rng = random.Random(7)
    mixed = [(i, " ".join(sentence(g, 1, rng) for g in rng.choices(("aa", "bb"), k=2)), None) for i in range(400)]
    model = language_id.train(frame(spark, corpus()))
    found = language_id.predict(frame(spark, mixed), model).select(*language_id.columns()).collect()
    flagged = [r for r in found if r["ambiguous"]]
    assert 0 < len(flagged) < len(found) and all(r["score"] < 0.6 for r in flagged)


def test_memory_does_not_grow_with_languages_or_text(spark):
    """20 languages have 75 bits; a text of 50 MB is walked in windows."""
    counts = np.random.default_rng(3).integers(0, 9, size=(20, 2 * language_id.BUCKETS)).astype(float)
    model = language_id._bit_classifiers([f"l{i}" for i in range(20)], counts)
    (chunk,) = list(language_id.chunks(pa.array(["the ung ción " * 3_800_000])))
    tracemalloc.start()
    margins = model.margins(chunk)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert margins.shape == (1, 75) and peak < 200 << 20


def test_letters_of_no_language_are_not_known(spark):
    model = language_id.train(frame(spark, corpus()))
    rows = [(1, "漢字かな混じり文", None), (2, "ℵℶ ⵣⴰⵎ", None), (3, "12 !", None), (4, None, None), *corpus(90, seed=3)]
    found = language_id.predict(frame(spark, rows), model).select("text", "language.known").collect()
    texts = {t for _, t, _ in rows[4:]}
    assert all(r["known"] == (r["text"] in texts) for r in found)
