"""Words, word hashes and n-gram hashes of whole Arrow text batches, computed with NumPy.

A word is a maximal run of bytes other than ASCII white space (0x20, 0x09-0x0D); A-Z are lower-cased, all
other characters stay as they are. Hashes have 64 bits and depend on the word alone, so every task gets the
same ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Bytes of text worked on at a time; a longer document is a chunk of its own, and walked in windows.
CHUNK_BYTES = 1 << 20
WINDOW_BYTES = 1 << 18

_U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[ord("A") : ord("Z") + 1] += _U64(32)
_LOWER += _U64(1)  # no byte counts as zero
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def _geometric(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, from 0 on."""
    pair = []
    for base in (_BASE, _BASE_INVERSE):
        steps = np.full(length, base, dtype=np.uint64)
        steps[:1] = 1
        pair.append(np.multiply.accumulate(steps))
    return pair[0], pair[1]


_WINDOW_POWERS = _geometric(2 * WINDOW_BYTES)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    values = values ^ (values >> _U64(30))
    values = values * _U64(0xBF58476D1CE4E5B9)
    values ^= values >> _U64(27)
    values *= _U64(0x94D049BB133111EB)
    values ^= values >> _U64(31)
    return values


@dataclass
class Chunk:
    """Documents ``first`` to ``first + len(bounds) - 1`` of a batch."""

    first: int
    data: np.ndarray  # bytes of all documents
    bounds: np.ndarray  # document i is data[bounds[i]:bounds[i + 1]]

    @property
    def size(self) -> int:
        return len(self.bounds) - 1


@dataclass
class Words:
    hashes: np.ndarray  # one per word, in text order
    bounds: np.ndarray  # document i has hashes[bounds[i]:bounds[i + 1]]

    @property
    def documents(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cut a text column (null: empty) into chunks of whole documents."""
    if len(texts) == 0:
        return
    texts = texts.fill_null("") if texts.null_count else texts
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    start = 0
    while start < len(texts):
        end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        end = max(start + 1, min(end, len(texts)))
        yield Chunk(start, data[offsets[start] : offsets[end]], offsets[start : end + 1] - offsets[start])
        start = end


def windows(data: np.ndarray, bounds: np.ndarray, ends: np.ndarray | None, size: int) -> Iterator[tuple[int, int, int, int]]:
    """(begin, end, first, last): stretches of about ``size`` bytes, and the documents that have bytes in them.

    With ``ends``, a mark per byte value, a stretch ends behind a marked byte (or with the data), so nothing
    between marked bytes is cut; without, it may end anywhere.
    """
    begin = 0
    while begin < len(data):
        end = min(begin + size, len(data))
        while ends is not None and end < len(data) and not ends[data[end - 1]]:
            found = np.flatnonzero(ends[data[end : end + size]])
            end = end + int(found[0]) + 1 if len(found) else min(end + size, len(data))
        first = int(np.searchsorted(bounds, begin, side="right")) - 1
        yield begin, end, first, int(np.searchsorted(bounds, end, side="left"))
        begin = end


def words(chunk: Chunk) -> Words:
    """Hashes of all words of a chunk; besides them memory holds one window."""
    data, bounds = chunk.data, chunk.bounds
    hashes, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for begin, end, first, last in windows(data, bounds, _SPACE, WINDOW_BYTES):
        part = data[begin:end]
        blank = _SPACE[part]
        opens = np.ones(len(part), dtype=bool)  # preceded by white space or a document's start
        opens[1:] = blank[:-1]
        borders = bounds[first:last] - begin
        opens[borders[(borders >= 0) & (borders < len(part))]] = True
        closes = np.ones(len(part), dtype=bool)
        closes[:-1] = opens[1:] | blank[1:]
        starts = np.flatnonzero(opens & ~blank)
        ends = np.flatnonzero(closes & ~blank) + 1
        # A window goes on to the end of its last word; it is longer than the table only where a word is very long.
        power, inverse = _WINDOW_POWERS if len(part) <= len(_WINDOW_POWERS[0]) else _geometric(len(part))
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(_LOWER[part] * power[: len(part)], out=sums[1:])
        hashes.append(mix((sums[ends] - sums[starts]) * inverse[starts]))
        places.append(starts + begin)
    starts = np.concatenate(places)
    return Words(np.concatenate(hashes), np.searchsorted(starts, bounds))


def ngrams(found: Words, size: int) -> Words:
    """Hashes of all runs of ``size`` words inside a document, in text order."""
    hashes, bounds = found.hashes, found.bounds
    counts = np.maximum(np.diff(bounds) - (size - 1), 0)
    total = int(counts.sum())
    result_bounds = np.concatenate(([0], np.cumsum(counts)))
    if total == 0:
        return Words(np.zeros(0, np.uint64), result_bounds)
    starts = np.arange(total) + np.repeat(bounds[:-1] - result_bounds[:-1], counts)
    joined = hashes[starts]
    for step in range(1, size):
        joined = mix(joined * _U64(0x9FB21C651E98DF25) + hashes[starts + step])
    return Words(joined, result_bounds)


def per_document(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` (any number of columns) over each document's slice; empty slices give 0."""
    sums = np.zeros((len(bounds) - 1, *values.shape[1:]), dtype=np.float64)
    filled = np.flatnonzero(np.diff(bounds) > 0)
    if len(filled):
        sums[filled] = np.add.reduceat(values, bounds[filled], axis=0, dtype=np.float64)
    return sums
