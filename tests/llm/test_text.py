"""Words and their hashes, window by window."""

import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from seqprep.llm import quality, text


def plain_hash(word):
    total, power = 0, 1
    for byte in word.encode():
        total += (byte + 33 if 65 <= byte <= 90 else byte + 1) * power
        power = power * text._BASE % (1 << 64)
    return int(text.mix(np.array([total % (1 << 64)], np.uint64))[0])


@pytest.mark.parametrize("window", [1, 3, 50, 1 << 18])
def test_words_match_plain_hashes(monkeypatch, window):
    monkeypatch.setattr(text, "WINDOW_BYTES", window)
    source = random.Random(2)
    texts = ["".join(source.choice("aBé \t\n\x0b漢") for _ in range(source.choice((0, 1, 5, 60)))) for _ in range(80)]
    texts += [None, "", "x" * 5000 + " y", " ", "end"]
    (chunk,) = list(text.chunks(pa.array(texts)))
    found = text.words(chunk)
    for row, own in enumerate(texts):
        expected = [plain_hash(w) for w in re.findall(r"[^\x20\x09-\x0D]+", own or "")]
        assert found.hashes[found.bounds[row] : found.bounds[row + 1]].tolist() == expected


def test_long_texts_take_little_besides_their_words():
    (chunk,) = list(text.chunks(pa.array(["word and more " * 3_600_000])))
    tracemalloc.start()
    found = text.words(chunk)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found.hashes) == 3 * 3_600_000 and peak < 40 * len(found.hashes)


def test_statistics_do_not_depend_on_windows(monkeypatch):
    texts = pa.array(["Ab, 1.\n" * 30, "", "é|x!" * 9, None, "z"])
    (chunk,) = list(text.chunks(texts))
    whole = quality.features(chunk).statistics
    monkeypatch.setattr(quality, "WINDOW_BYTES", 7)
    assert np.allclose(quality.features(chunk).statistics, whole)
