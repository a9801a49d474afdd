"""Phrase mining against plain counting."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from seqprep.llm import collocations as mining
from seqprep.sources.package import ship_package

SCHEMA = "doc_id long, text string, lang string, phrase string, ids string, a int, n int, rank int, block int"


def frame(spark, rows, parts=3):
    ship_package(spark)
    return spark.createDataFrame([(i, t, g, "p", "i", 1, 2, 3, 4) for i, (t, g) in enumerate(rows)], SCHEMA).repartition(parts)


def pieces(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", piece) for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower)]


def expected(rows, least=10, most_words=3, top=2000):
    counts, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            n[lang] += len(words)
            for size in range(1, most_words + 1):
                for i in range(len(words) - size + 1):
                    counts[lang, tuple(words[i : i + size])] += 1
    candidates = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= least}
    found = []
    for (lang, words), a in candidates.items():
        inside = any(
            100 * b >= 50 * a
            for (other, longer), b in candidates.items()
            if other == lang and len(longer) > len(words)
            and any(longer[i : i + len(words)] == words for i in range(len(longer) - len(words) + 1))
        )
        if not inside:
            cuts = [(counts[lang, words[:k]], counts[lang, words[k:]], k) for k in range(1, len(words))]
            score, _, l, r = min((1_000_000 * a * a // (l * r), k, l, r) for l, r, k in cuts)
            found.append((lang, " ".join(words), a, l, r, n[lang], score))
    result = []
    for lang in {row[0] for row in found}:
        own = sorted((r for r in found if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:top]
        result += [(lang, rank, *row[1:]) for rank, row in enumerate(own, start=1)]
    return sorted(result)


def run(spark, rows, parts=3, **options):
    found = mining.collocations(frame(spark, rows, parts), **options)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(row) for row in found.collect())


def corpus(seed, count):
    source = random.Random(seed)
    words = ["The", "the", "é", "É", "of", "new", "York", "a\x00b", "city", "x" * 40, "no", "日本"]
    rows = []
    for _ in range(count):
        size = source.choice((0, 1, 2, 3, 9, 40))
        text = "".join(source.choice(words[: source.choice((3, 12))]) + source.choice([" "] * 9 + ["\t", "  ", ", ", ".", "\n", "\r", "\v", " ; "]) for _ in range(size))
        rows.append((text, source.choice(["en", "en", "en", "de", None, "und", "a b"])))
    return rows + [(None, "en"), ("", None), (" ,. ", "fr"), ("new york city " * 30, "en"), ("ha " * 50, "de")] + rows[:20]


@pytest.mark.parametrize("block", [8 << 20, 300, 1])
def test_matches_plain_counting(spark, monkeypatch, block):
    monkeypatch.setattr(mining, "BLOCK_BYTES", block)
    monkeypatch.setattr(mining, "SHARD_WORDS", 20)
    monkeypatch.setattr(mining, "SHARD_PHRASES", 900)
    rows = corpus(3, 300)
    found = run(spark, rows)
    assert len(found) > 20 and found == expected(rows)


@pytest.mark.parametrize("window", [1, 7, 64, 1 << 20])
def test_splitting_in_windows(monkeypatch, window):
    monkeypatch.setattr(mining, "WINDOW_BYTES", window)
    texts = [text for text, _ in corpus(9, 60)]
    found = [[]]
    for words, new in mining.split_words(pa.array(texts)):
        for word, first in zip(words.to_pylist(), new):
            found += [[]] if first else []
            found[-1].append(word.decode())
    assert found[1:] == [words for text in texts for words in pieces(text) if words] and found[0] == []
    assert list(mining.split_words(pa.array([], pa.string()))) == []


def test_longer_phrases_and_few_places(spark):
    rows = corpus(5, 90)
    assert run(spark, rows, most_words=5, least=4, top=7) == expected(rows, 4, 5, 7)
    assert run(spark, rows, most_words=2, least=30) == expected(rows, 30, 2)


def test_one_hot_language_and_one_long_piece(spark, monkeypatch):
    monkeypatch.setattr(mining, "BLOCK_BYTES", 2000)
    rows = [("ab cd ef " * 4000, "en")] + [("ab cd", "en")] * 400 + [("z" * 5000 + " y " + "z" * 5000 + " y", "de")] * 11
    assert run(spark, rows, parts=7) == expected(rows)


def test_empty_tables(spark):
    assert run(spark, []) == [] and run(spark, [(None, None), ("", "en"), ("one two", "en")]) == []


def test_large_products_are_exact(spark):
    a, l, r = 3_000_000_019, 7_000_000_000_001, 5_000_000_000_053
    sql = f"CAST(1000000 AS decimal(38,0)) * CAST({a}L AS decimal(38,0)) * CAST({a}L AS decimal(38,0)) div (CAST({l}L AS decimal(38,0)) * CAST({r}L AS decimal(38,0))) AS s"
    assert spark.sql(f"SELECT {sql}").first()["s"] == 1_000_000 * a * a // (l * r)


def test_packing():
    for values in ([], [0], [1, 255], [256, 0, 3], [2**63 + 1, 5], list(range(1000))):
        assert mining.unpack(mining.pack(pa.array(values, pa.uint64()).to_numpy())).tolist() == values
