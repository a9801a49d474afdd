"""Text quality by a factorisation machine over hashed words and structure statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from seqprep.llm.text import WINDOW_BYTES, Chunk, chunks, ngrams, per_document, windows, words

TRAIN_DOCS = 12_000  # labelled documents that the machine is fitted on, at most
BUCKETS = 1 << 14  # of hashed words
FACTORS = 8
EPOCHS = 8
BATCH = 128
RATE = 0.1
DECAY = 1e-5
THRESHOLD = 0.3

# Kinds of bytes whose shares of the text are statistics, besides all others.
_KINDS = np.zeros(256, dtype=np.int64)
for _place, _members in enumerate(
    ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\r\f\v", "\n", ".", ",", "!?", ";:'\"-()", "|"),
    start=1,
):
    _KINDS[[ord(c) for c in _members]] = _place
_KINDS[128:] = 11
KINDS = 12
STATISTICS = KINDS + 10


@dataclass
class Features:
    """Sparse rows: document i has buckets[bounds[i]:bounds[i + 1]] with values, and a row of statistics."""

    buckets: np.ndarray
    values: np.ndarray
    bounds: np.ndarray
    statistics: np.ndarray


def _most_repeated(hashes: np.ndarray, documents: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and the count of the most frequent one, per document."""
    order = np.lexsort((hashes, documents))
    hashes, documents = hashes[order], documents[order]
    first = np.ones(len(hashes), dtype=bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (documents[1:] != documents[:-1])
    starts = np.flatnonzero(first)
    runs = np.diff(np.append(starts, len(hashes)))
    distinct = np.bincount(documents[starts], minlength=rows)
    most = np.zeros(rows)
    np.maximum.at(most, documents[starts], runs)
    return distinct, most


def features(chunk: Chunk) -> Features:
    """Features of every document of a chunk; an empty text has no buckets and statistics of zero."""
    rows = chunk.size
    found = words(chunk)
    documents = found.documents
    keys = documents.astype(np.int64) * BUCKETS + (found.hashes >> np.uint64(50)).astype(np.int64)
    keys, times = np.unique(keys, return_counts=True)
    owner, values = keys // BUCKETS, np.log1p(times)
    bounds = np.searchsorted(owner, np.arange(rows + 1))
    norms = np.sqrt(per_document(values**2, bounds))
    values = values / np.maximum(norms, 1e-9)[owner]
    size = np.diff(chunk.bounds)
    number = np.diff(found.bounds)
    spread = np.maximum(size, 1)[:, None]
    kinds = np.zeros((rows, KINDS))
    for begin, end, first, last in windows(chunk.data, chunk.bounds, None, WINDOW_BYTES):
        taken = np.diff(np.clip(chunk.bounds[first : last + 1], begin, end))
        place = np.repeat(np.arange(last - first), taken) * KINDS + _KINDS[chunk.data[begin:end]]
        kinds[first:last] += np.bincount(place, minlength=(last - first) * KINDS).reshape(-1, KINDS)
    kinds /= spread
    distinct, most = _most_repeated(found.hashes, documents, rows)
    pairs = ngrams(found, 2)
    pair_count = np.diff(pairs.bounds)
    pair_kinds, pair_most = _most_repeated(pairs.hashes, pairs.documents, rows)
    letters = kinds[:, 1] + kinds[:, 2] + kinds[:, 11]
    statistics = np.column_stack(
        (
            kinds,
            np.log1p(size),
            np.log1p(number),
            size / np.maximum(number, 1) / 10,
            distinct / np.maximum(number, 1),
            distinct / np.sqrt(np.maximum(number, 1)) / 10,
            most / np.maximum(number, 1),
            pair_kinds / np.maximum(pair_count, 1),
            pair_most / np.maximum(pair_count, 1),
            kinds[:, 2] / np.maximum(letters, 1e-9),
            kinds[:, 0] / np.maximum(letters, 1e-9),
        )
    )
    return Features(keys % BUCKETS, values, bounds, statistics * (size > 0)[:, None])


@dataclass
class FactorisationMachine:
    bias: float
    linear: np.ndarray  # buckets, then statistics
    factors: np.ndarray  # the same x FACTORS
    mean: np.ndarray
    spread: np.ndarray

    def standard(self, statistics: np.ndarray) -> np.ndarray:
        return np.clip((statistics - self.mean) / self.spread, -4, 4) / 2

    def logit(self, rows: Features) -> np.ndarray:
        """Sum of linear terms and, from sums and sums of squares of factors, of all pairwise terms."""
        extra = self.standard(rows.statistics)
        count = len(self.mean)
        linear = per_document(self.linear[rows.buckets] * rows.values, rows.bounds) + extra @ self.linear[-count:]
        part = self.factors[rows.buckets] * rows.values[:, None]
        sums = per_document(part, rows.bounds) + extra @ self.factors[-count:]
        squares = per_document(part**2, rows.bounds) + extra**2 @ self.factors[-count:] ** 2
        return self.bias + linear + 0.5 * (sums**2 - squares).sum(1)

    def score(self, rows: Features) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(rows), -30, 30)))


def fit(rows: Features, labels: np.ndarray) -> FactorisationMachine:
    """Logistic loss, AdaGrad over mini-batches in a fixed order; one label only gives that label's rate."""
    random = np.random.default_rng(11)
    count = rows.statistics.shape[1]
    size = BUCKETS + count
    mean = rows.statistics.mean(0) if len(labels) else np.zeros(count)
    spread = np.maximum(rows.statistics.std(0), 1e-6) if len(labels) else np.ones(count)
    rate = (labels.sum() + 1) / (len(labels) + 2)
    machine = FactorisationMachine(
        float(np.log(rate / (1 - rate))), np.zeros(size), random.normal(0, 0.05, (size, FACTORS)), mean, spread
    )
    if len(set(labels.tolist())) < 2:
        machine.factors[:] = 0
        return machine
    extra = machine.standard(rows.statistics)
    names = np.arange(BUCKETS, size)
    lengths = np.diff(rows.bounds)
    linear_past, factor_past = np.full(size, 1e-3), np.full((size, FACTORS), 1e-3)
    for _ in range(EPOCHS):
        order = random.permutation(len(labels))
        for start in range(0, len(order), BATCH):
            chosen = order[start : start + BATCH]
            took = lengths[chosen]
            places = np.arange(took.sum()) + np.repeat(rows.bounds[chosen] - np.cumsum(took) + took, took)
            ids = np.concatenate((rows.buckets[places], np.tile(names, len(chosen))))
            x = np.concatenate((rows.values[places], extra[chosen].ravel()))
            owner = np.concatenate((np.repeat(np.arange(len(chosen)), took), np.repeat(np.arange(len(chosen)), count)))
            part = machine.factors[ids] * x[:, None]
            sums = np.zeros((len(chosen), FACTORS))
            squares = np.zeros(len(chosen))
            linear = np.bincount(owner, machine.linear[ids] * x, len(chosen))
            for k in range(FACTORS):
                sums[:, k] = np.bincount(owner, part[:, k], len(chosen))
            squares = np.bincount(owner, (part**2).sum(1), len(chosen))
            logit = machine.bias + linear + 0.5 * ((sums**2).sum(1) - squares)
            error = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[chosen]
            touched, where = np.unique(ids, return_inverse=True)
            slope = np.bincount(where, error[owner] * x, len(touched)) / len(chosen) + DECAY * machine.linear[touched]
            linear_past[touched] += slope**2
            machine.linear[touched] -= RATE * slope / np.sqrt(linear_past[touched])
            pull = (error[owner] * x)[:, None] * (sums[owner] - part)
            for k in range(FACTORS):
                bend = np.bincount(where, pull[:, k], len(touched)) / len(chosen) + DECAY * machine.factors[touched, k]
                factor_past[touched, k] += bend**2
                machine.factors[touched, k] -= RATE * bend / np.sqrt(factor_past[touched, k])
            machine.bias -= 0.05 * error.mean()
    return machine


def train(
    docs: DataFrame,
    labels: DataFrame,
    keep: Column | None = None,
    identity: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    limit: int = TRAIN_DOCS,
) -> FactorisationMachine:
    """Fit on at most ``limit`` labelled rows that ``keep`` admits, the first by a hash of their ids.

    Features are made by the tasks; the driver receives those of the sample, a bounded amount, and fits.
    Null labels, ids and texts teach nothing.
    """
    kept = labels.filter(F.col(label).isNotNull() & F.col(identity).isNotNull() & (F.lit(True) if keep is None else keep))
    kept = kept.select(F.col(identity).alias("id"), (F.col(label) > 0).cast("double").alias("label"))
    picked = kept.orderBy(F.xxhash64("id"), "id", "label").limit(limit)
    texts = docs.select(F.col(identity).alias("id"), F.col(text).alias("text")).filter("text IS NOT NULL")
    rows = texts.join(F.broadcast(picked), "id").select("text", "label")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                found = features(chunk)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("label").slice(chunk.first, chunk.size),
                        pa.array([found.buckets[a:b].astype("<i2").tobytes() for a, b in _slices(found)], pa.binary()),
                        pa.array([found.values[a:b].astype("<f4").tobytes() for a, b in _slices(found)], pa.binary()),
                        pa.array([row.astype("<f8").tobytes() for row in found.statistics], pa.binary()),
                    ],
                    names=["label", "buckets", "strengths", "statistics"],
                )

    table = rows.mapInArrow(extract, "label double, buckets binary, strengths binary, statistics binary")
    found = table.toArrow().sort_by([("statistics", "ascending"), ("buckets", "ascending"), ("label", "ascending")])
    packed = {name: found.column(name).to_pylist() for name in ("buckets", "strengths", "statistics")}
    lengths = [len(p) // 2 for p in packed["buckets"]]
    sample = Features(
        np.frombuffer(b"".join(packed["buckets"]), "<i2").astype(np.int64),
        np.frombuffer(b"".join(packed["strengths"]), "<f4").astype(float),
        np.concatenate(([0], np.cumsum(lengths))).astype(np.int64),
        np.frombuffer(b"".join(packed["statistics"]), "<f8").reshape(len(lengths), STATISTICS),
    )
    return fit(sample, np.array(found.column("label").to_pylist(), dtype=float))


def _slices(found: Features) -> list[tuple[int, int]]:
    return list(zip(found.bounds[:-1].tolist(), found.bounds[1:].tolist()))


def score(docs: DataFrame, machine: FactorisationMachine, text: str = "text", output: str = "quality_score") -> DataFrame:
    """Add ``output``: the probability (0 to 1) that the whole text is of good quality.

    Null counts as empty; an empty text has features of zero and gets the score that goes with them, every
    time the same. Equal texts get equal scores. A column already called ``output`` is replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(machine)

    @F.arrow_udf("double")
    def probability(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [sent.value.score(features(chunk)) for chunk in chunks(texts)]
            yield pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return docs.withColumn(output, probability(F.col(text)))
