"""Language identification by error-correcting output codes over byte n-grams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from seqprep.llm.text import Chunk, chunks, per_document, windows

TRAIN_DOCS = 2000  # labelled documents per language that the classifiers are fitted on, about
BUCKETS = 1 << 16  # of hashed byte trigrams; byte pairs have one of their own each
SMOOTHING = 0.5
WINDOW_BYTES = 1 << 16  # of text that are looked up in the weights at a time
AMBIGUOUS = 0.05  # a decision is flagged if the second best language scores within this of the best
NO_EVIDENCE = 0.98  # loss to the nearest codeword from which a text's language counts as not known
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[ord("A") : ord("Z") + 1] += 32


def codewords(languages: int) -> np.ndarray:
    """One row of +1/-1 per language.

    Up to 5 languages get every split of the languages in two (the exhaustive code); more get columns of
    random even splits, as many as keep any two rows apart in about half of them.
    """
    if languages <= 1:
        return np.ones((languages, 1))
    if languages <= 5:
        splits = range(1, 1 << (languages - 1))
        return np.array([[1 - 2 * (split >> row & 1) for split in splits] for row in range(languages)], dtype=float)
    length = 15 * int(np.ceil(np.log2(languages)))
    random = np.random.default_rng(7)
    half = np.where(np.arange(languages) < languages / 2, 1.0, -1.0)
    best, spread = None, -1.0
    for _ in range(50):
        code = np.stack([random.permutation(half) for _ in range(length)], axis=1)
        apart = (length - code @ code.T) / 2
        least = apart[~np.eye(languages, dtype=bool)].min()
        if least > spread:
            best, spread = code, least
    return best


def _grams(chunk: Chunk) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Window by window: its documents, their bounds in it, the feature numbers of the byte pair and of the byte
    trigram at every byte, and how many bytes of the document follow (2 stands for more)."""
    for begin, end, first, last in windows(chunk.data, chunk.bounds, None, WINDOW_BYTES):
        low = _LOWER[chunk.data[begin : end + 2]]
        pad = np.concatenate((low, np.zeros(end + 2 - begin - len(low), np.uint32)))
        pairs = pad[:-2] | pad[1:-1] << np.uint32(8)
        triples = ((pairs | pad[2:] << np.uint32(16)) * np.uint32(0x9E3779B1)) >> np.uint32(16)
        left = np.full(end - begin, 2, np.int8)
        for back in (1, 2):  # the last byte of a document, and the one before it
            tails = chunk.bounds[first + 1 : last + 1] - begin - back
            at = tails[(tails >= 0) & (tails < len(left)) & (np.diff(chunk.bounds[first : last + 1]) >= back)]
            left[at] = np.minimum(left[at], back - 1)
        bounds = np.clip(chunk.bounds[first : last + 1], begin, end) - begin
        yield slice(first, last), bounds, pairs, triples + np.uint32(BUCKETS), left


@dataclass
class LanguageModel:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # features x bits: what each n-gram says for each bit
    scale: np.ndarray  # typical size of each bit's margin
    trust: np.ndarray  # languages x bits: how often the bit's classifier is right on that language

    def margins(self, chunk: Chunk) -> np.ndarray:
        """Mean of the n-grams' weights per document and bit; memory holds one window, whatever a text's length."""
        total = np.zeros((chunk.size, self.code.shape[1]))
        for rows, bounds, pairs, triples, left in _grams(chunk):
            gains = self.weights[pairs]
            gains[left < 1] = 0
            total[rows] += per_document(gains, bounds)
            gains = self.weights[triples]
            gains[left < 2] = 0
            total[rows] += per_document(gains, bounds)
        return total / np.maximum(np.diff(chunk.bounds), 1)[:, None] / self.scale

    def decide(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Nearest codeword under exponential loss, weighted by trust; its share; the lead over the next; its loss.

        Trusts of a language add up to 1, so a text whose n-grams say nothing is at a loss of 1 from all."""
        margins = np.clip(margins, -3, 3)
        loss = np.stack(
            [(trust * np.exp(-word * margins)).sum(1) for word, trust in zip(self.code, self.trust)], axis=1
        )
        share = np.exp(-4 * (loss - loss.min(1, keepdims=True)))
        share /= share.sum(1, keepdims=True)
        order = np.sort(share, axis=1)
        lead = order[:, -1] - order[:, -2] if share.shape[1] > 1 else order[:, -1]
        return loss.argmin(1), order[:, -1], lead, loss.min(1)


def _sample(docs: DataFrame, identity: str, text: str, lang: str, keep: Column, per_language: int) -> DataFrame:
    """About ``per_language`` labelled documents of each language, picked by a hash of the id."""
    labelled = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & keep)
    counts = labelled.groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("rows"))
    place = F.pmod(F.xxhash64(F.col(identity)), F.lit(1 << 20)) / float(1 << 20)
    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text"), place.alias("place"))
    picked = rows.join(F.broadcast(counts), "lang").filter(F.col("place") * F.col("rows") < per_language)
    return picked.select("lang", "text")


def train(
    docs: DataFrame,
    identity: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    keep: Column | None = None,
    per_language: int = TRAIN_DOCS,
) -> LanguageModel:
    """Fit one classifier per bit of the codewords on a bounded sample of the rows that ``keep`` admits.

    N-grams are counted by the tasks and summed by (language, feature). Every bit's classifier weighs an n-gram
    by the log ratio of its frequency in the languages whose bit is +1 to that in the others. A second pass
    over the sample measures margins and how far each bit can be trusted on each language. The driver holds
    (languages x features) numbers, whatever the size of the corpus.
    """
    sample = _sample(docs, identity, text, lang, F.lit(True) if keep is None else keep, per_language)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            for chunk in chunks(batch.column("text")):
                own = langs[chunk.first : chunk.first + chunk.size]
                for rows, bounds, pairs, triples, left in _grams(chunk):
                    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
                    for name in dict.fromkeys(own[rows]):
                        here = (own[rows] == name)[row]
                        found = np.concatenate((pairs[here & (left >= 1)], triples[here & (left >= 2)]))
                        totals.setdefault(name, np.zeros(2 * BUCKETS, np.int64))
                        np.add.at(totals[name], found, 1)
        for name, total in totals.items():
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(seen), pa.string()), pa.array(seen), pa.array(total[seen])],
                names=["lang", "feature", "n"],
            )

    counted = sample.mapInArrow(count, "lang string, feature long, n long")
    table = counted.groupBy("lang", "feature").agg(F.sum("n").alias("n")).toArrow()
    names = np.array(table.column("lang").to_pylist(), dtype=object)
    languages = sorted(set(names.tolist()))
    counts = np.zeros((len(languages), 2 * BUCKETS))
    if languages:
        place = {name: number for number, name in enumerate(languages)}
        counts[[place[name] for name in names], table.column("feature").to_numpy()] = table.column("n").to_numpy()
    model = _bit_classifiers(languages, counts)
    if len(languages) > 1:
        _calibrate(sample, model)
    return model


def _bit_classifiers(languages: list[str], counts: np.ndarray) -> LanguageModel:
    code = codewords(len(languages))
    bits = code.shape[1] if len(languages) else 1
    weights = np.zeros((2 * BUCKETS, bits), dtype=np.float32)
    frequency = np.zeros_like(counts)
    for half in (slice(0, BUCKETS), slice(BUCKETS, 2 * BUCKETS)):
        part = counts[:, half] + SMOOTHING
        frequency[:, half] = part / part.sum(1, keepdims=True)
    for bit in range(bits if len(languages) > 1 else 0):
        plus = code[:, bit] > 0
        weights[:, bit] = np.log(frequency[plus].mean(0) / frequency[~plus].mean(0))
    return LanguageModel(
        languages, code, weights, np.ones(bits), np.full((max(len(languages), 1), bits), 1.0 / bits)
    )


def _calibrate(sample: DataFrame, model: LanguageModel) -> None:
    """Set each bit's usual margin and its trust per language from sums over the sample."""
    sent = sample.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        place = {name: number for number, name in enumerate(known.languages)}
        sums = np.zeros((len(known.languages), 2, known.code.shape[1]))
        rows = np.zeros(len(known.languages))
        for batch in batches:
            own = np.array([place[name] for name in batch.column("lang").to_pylist()], dtype=int)
            for chunk in chunks(batch.column("text")):
                margins = known.margins(chunk)
                where = own[chunk.first : chunk.first + chunk.size]
                right = (margins * known.code[where] > 0).astype(float)
                np.add.at(sums, where, np.stack((np.abs(margins), right), axis=1))
                np.add.at(rows, where, 1)
        seen = np.flatnonzero(rows)
        if len(seen):
            yield pa.RecordBatch.from_pylist(
                [
                    {"language": int(i), "bit": b, "margin": sums[i, 0, b], "right": sums[i, 1, b], "rows": rows[i]}
                    for i in seen
                    for b in range(known.code.shape[1])
                ]
            )

    seen = sample.mapInArrow(measure, "language long, bit long, margin double, right double, rows double")
    found = seen.groupBy("language", "bit").agg(*[F.sum(c).alias(c) for c in ("margin", "right", "rows")]).toArrow()
    margin, right, rows = (np.zeros(model.code.shape) for _ in range(3))
    at = found.column("language").to_numpy(), found.column("bit").to_numpy()
    for table, name in ((margin, "margin"), (right, "right"), (rows, "rows")):
        table[at] = found.column(name).to_numpy()
    model.scale = np.maximum(margin.sum(0) / np.maximum(rows.sum(0), 1), 1e-9)
    trust = (right + 1) / (rows + 2)
    model.trust = trust / trust.sum(1, keepdims=True)


def predict(docs: DataFrame, model: LanguageModel, text: str = "text", output: str = "language") -> DataFrame:
    """Add the struct ``output``: lang_pred, score (0 to 1), ambiguous, known.

    ``known`` says whether the nearest codeword is nearer than it is to a text without any evidence, so it is
    false for texts in letters that no language of the model has; ``und`` is never known.
    The whole text is read. Null texts and texts without a letter are ``und`` with score 0; so is everything if
    the model knows no language. With one known language every other text is that one. Equal texts get equal
    answers, ties go to the language first in order; a column already called ``output`` is replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("lang_pred string, score double, ambiguous boolean, known boolean")
    def decide(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = sent.value
        for texts in batches:
            names: list[str] = [UNKNOWN] * len(texts)
            scores, close = np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
            told = np.zeros(len(texts), dtype=bool)
            for chunk in chunks(texts) if known.languages else ():
                best, share, lead, loss = known.decide(known.margins(chunk))
                for row in range(chunk.size):
                    place = chunk.first + row
                    value = texts[place].as_py()
                    if value and _LETTER.search(value):
                        names[place] = known.languages[best[row]]
                        scores[place], close[place] = min(1.0, share[row]), lead[row] < AMBIGUOUS
                        told[place] = loss[row] < NO_EVIDENCE or len(known.languages) == 1
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(scores), pa.array(close), pa.array(told)],
                names=["lang_pred", "score", "ambiguous", "known"],
            )

    return docs.withColumn(output, decide(F.col(text)))


def columns(output: str = "language") -> Sequence[Column]:
    return [F.col(f"{output}.{name}") for name in ("lang_pred", "score", "ambiguous")]
