"""Language-model scores from exact word counts and a sharded Bloom filter of log-quantised pair counts."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from seqprep.llm.text import Chunk, chunks, mix, per_document, words
from seqprep.sources.spool import spool

HOT_WORDS = 1 << 20  # words whose exact counts are broadcast, at most
SHARD_BYTES = 16 << 20  # text per shard of the n-gram counts, at most
GROUP_BYTES = 4 << 20  # text of the rows that ask for their n-grams together, about
BLOCK = 1 << 18  # keys that are answered at a time, about
ANY_BITS = 1 << 62
BUFFER = 2_000_000  # n-grams that a task counts before it sends them on
PROBES = 4  # bits per member
BITS = 8  # of the filter per member, at least
PRIOR = 200.0  # weight of the one-word probability against the context's count

_U64 = np.uint64
_END = np.uint64(0x5851F42D4C957F2D)  # the token after the last word


@dataclass
class Tokens:
    """Words of each document and one end, with the token before each (the end, at a document's start)."""

    hashes: np.ndarray
    before: np.ndarray
    bounds: np.ndarray


def tokens(chunk: Chunk) -> Tokens:
    found = words(chunk)
    rows = len(found.bounds) - 1
    bounds = found.bounds + np.arange(rows + 1)
    hashes = np.full(bounds[-1], _END, dtype=np.uint64)
    inside = np.ones(len(hashes), dtype=bool)
    inside[bounds[1:] - 1] = False
    hashes[inside] = found.hashes
    return Tokens(hashes, np.concatenate(([_END], hashes[:-1])), bounds)


def pair_keys(found: Tokens) -> np.ndarray:
    """Keys of 48 bits, the low ones 0: they are sent in half the bytes, and the filter errs far more often."""
    return mix(found.before * _U64(0x9FB21C651E98DF25) + found.hashes + _U64(1)) & ~_U64(0xFFFF)


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as the bytes of their differences, all first bytes ahead of all second ones, to be compressed."""
    return np.diff(keys, prepend=_U64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack_keys(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(packed, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def _sums(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first)


def levels_of(counts: np.ndarray, cutoff: int) -> np.ndarray:
    """Quantised count: 0 below the cutoff, then 1 + floor(log2(count / cutoff))."""
    return np.where(counts >= cutoff, 1 + np.floor(np.log2(np.maximum(counts, 1) / cutoff + 1e-12)), 0).astype(np.int64)


def count_of(levels: np.ndarray, cutoff: np.ndarray) -> np.ndarray:
    """The count that a level stands for: the middle of its range."""
    power = np.exp2(levels - 1.0)
    return np.where(levels > 0, cutoff * (3 * power - 1) / 2, 0.0)


def _places(keys: np.ndarray, level: int | np.ndarray, probe: int) -> np.ndarray:
    spread = mix(keys + np.asarray(level, dtype=np.uint64) * _U64(0x9E3779B97F4A7C15))
    return spread + _U64(probe) * (spread >> _U64(32) | _U64(1))


def build_segment(keys: np.ndarray, counts: np.ndarray, most_bits: int) -> tuple[bytes, int]:
    """Bits of one shard's filter, a power of two of them, and its cutoff.

    Every n-gram is entered once per level up to its own. The cutoff is 1 unless the segment would need more
    than ``most_bits``; then rarer n-grams are left to the smoothing.
    """
    cutoff, levels = 1, levels_of(counts, 1)
    while int(levels.sum()) * BITS > most_bits:
        cutoff += max(1, cutoff // 4)
        levels = levels_of(counts, cutoff)
    bits = 64
    while bits < min(int(levels.sum()) * BITS, most_bits):
        bits *= 2
    segment = np.zeros(bits // 8, np.uint8)
    for level in range(1, int(levels.max(initial=0)) + 1):
        members = keys[levels >= level]
        for probe in range(PROBES):
            at = _places(members, level, probe) & _U64(bits - 1)
            np.bitwise_or.at(segment, (at >> _U64(3)).astype(np.int64), (1 << (at & _U64(7))).astype(np.uint8))
    return segment.tobytes(), cutoff


@dataclass
class BloomModel:
    shift: int  # of a key, to get its shard
    offsets: np.ndarray  # of the shards' segments, in bytes
    masks: np.ndarray  # bits of each segment less one
    cutoffs: np.ndarray
    bits: np.ndarray
    hot_keys: np.ndarray  # sorted hashes of frequent words, with their exact counts
    hot_counts: np.ndarray
    total: int
    distinct: int
    prior: float = PRIOR

    def shard(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> _U64(self.shift)).astype(np.int64) if self.shift < 64 else np.zeros(len(keys), np.int64)

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Levels are probed upwards until one is missing."""
        shard = self.shard(keys)
        levels = np.zeros(len(keys), np.int64)
        alive = np.arange(len(keys))
        level = 0
        while len(alive):
            level += 1
            for probe in range(PROBES):
                at = _places(keys[alive], level, probe) & self.masks[shard[alive]]
                byte = self.bits[self.offsets[shard[alive]] + (at >> _U64(3)).astype(np.int64)]
                alive = alive[(byte >> (at & _U64(7)).astype(np.uint8)) & 1 > 0]
            levels[alive] = level
        return levels

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """Quantised counts."""
        return count_of(self.levels(keys), self.cutoffs[self.shard(keys)])

    def exact(self, keys: np.ndarray) -> np.ndarray:
        """Exact counts of frequent words; 0 for all others."""
        if not len(self.hot_keys):
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.hot_keys, keys), len(self.hot_keys) - 1)
        return np.where(self.hot_keys[at] == keys, self.hot_counts[at], 0)

    def log_probability(
        self, single: np.ndarray, pairs: np.ndarray, place: np.ndarray, before: np.ndarray
    ) -> np.ndarray:
        """log10 of each token's smoothed probability after the token before it.

        ``single`` has exact word counts, to be taken at ``place`` and ``before``. The pair's count, at most its
        context's, is topped up with ``prior`` times the one-word probability.
        """
        context = single[before]
        both = np.minimum(pairs, context)
        alone = (single[place] + 1) / (self.total + self.distinct + 1)
        return np.log10((both + self.prior * alone) / (context + self.prior))


def segment_model(segment: bytes) -> BloomModel:
    """One shard's segment, to be probed."""
    bits = np.frombuffer(segment, np.uint8)
    none = np.zeros(0, np.int64)
    masks = np.array([8 * len(bits) - 1], np.uint64)
    return BloomModel(64, np.zeros(1, np.int64), masks, np.ones(1), bits, none.view(np.uint64), none, 0, 0)


def _by_shard(keys: np.ndarray, shards: int) -> Iterator[tuple[int, int, int]]:
    """(shard, begin, end) of sorted keys."""
    width = shards.bit_length() - 1
    edges = np.searchsorted(keys >> _U64(64 - width) if width else np.zeros(len(keys)), np.arange(shards + 1))
    for shard, (begin, end) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
        if end > begin:
            yield shard, begin, end


def _count_ngrams(texts: DataFrame, shards: int) -> DataFrame:
    """(shard, kind, keys, counts): n-grams counted by the tasks, packed by shard; kind 0 is words, 1 pairs."""

    def pack(kind: int, keys: np.ndarray, counts: np.ndarray) -> Iterator[dict]:
        for shard, begin, end in _by_shard(keys, shards):
            yield {
                "shard": shard,
                "kind": kind,
                "keys": pack_keys(keys[begin:end]),
                "counts": counts[begin:end].astype("<u4").tobytes(),
            }

    schema = pa.schema([("shard", pa.int32()), ("kind", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[tuple[np.ndarray, np.ndarray]]] = [[], []]

        def flush() -> Iterator[pa.RecordBatch]:
            for kind in (0, 1):
                if held[kind]:
                    keys, counts = _sums(*(np.concatenate(part) for part in zip(*held[kind])))
                    yield pa.RecordBatch.from_pylist(list(pack(kind, keys, counts)), schema=schema)
                    held[kind].clear()

        for batch in batches:
            for chunk in chunks(batch.column("text")):
                found = tokens(chunk)
                held[0].append(np.unique(found.hashes, return_counts=True))
                held[1].append(np.unique(pair_keys(found), return_counts=True))
                if sum(len(keys) for keys, _ in held[1]) > BUFFER:
                    yield from flush()
        yield from flush()

    return texts.mapInArrow(count, "shard int, kind int, keys binary, counts binary")


_SHARD = "shard int, total long, distinct long, words binary, counts binary, segment binary"


def _merge_shards(counted: DataFrame) -> DataFrame:
    """One row per shard: its words with exact counts, and its pairs' segment of the filter."""

    def merge(group: pa.Table) -> pa.Table:
        kinds = group.column("kind").to_numpy()
        merged = []
        for kind in (0, 1):
            rows = group.filter(pa.array(kinds == kind))
            parts = [unpack_keys(packed) for packed in rows.column("keys").to_pylist()]
            keys = np.concatenate([np.zeros(0, np.uint64), *parts])
            counts = np.frombuffer(b"".join(rows.column("counts").to_pylist()), "<u4").astype(np.int64)
            merged.append(_sums(keys, counts))
        (keys, counts), (pairs, pair_counts) = merged
        segment, _ = build_segment(pairs, pair_counts, ANY_BITS)
        return pa.table(
            {
                "shard": group.column("shard").slice(0, 1),
                "total": [int(counts.sum())],
                "distinct": [len(keys)],
                "words": pa.array([keys.astype("<u8").tobytes()], pa.binary()),
                "counts": pa.array([counts.astype("<i8").tobytes()], pa.binary()),
                "segment": pa.array([segment], pa.binary()),
            }
        )

    return counted.groupBy("shard").applyInArrow(merge, _SHARD)


def _unpacked(merged: DataFrame, least: int) -> DataFrame:
    """(key, count) of words with at least ``least``."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(batch.column("words").to_pylist(), batch.column("counts").to_pylist()):
                keys, counts = np.frombuffer(keys, "<i8"), np.frombuffer(counts, "<i8")
                keep = counts >= least
                yield pa.RecordBatch.from_arrays([pa.array(keys[keep]), pa.array(counts[keep])], names=["key", "count"])

    return merged.select("words", "counts").mapInArrow(unpack, "key long, count long")


def train(docs: DataFrame, text: str = "text", prior: float = PRIOR) -> tuple[BloomModel, DataFrame]:
    """Count words and pairs of ``docs``; returns the model without its filter, and the shards with it.

    Counts cover all texts: tasks count, counts are packed by shard of the hash, and one task per shard merges
    them, keeps its words with exact counts and builds its segment of the filter. The number of shards follows
    the text and a segment its pairs, so none is left out at any size. The driver collects the most frequent
    words (``HOT_WORDS`` at most); all else stays a table.
    """
    texts = docs.select(F.col(text).alias("text"))
    shards = 1 << max(4, int(_bytes(texts) // SHARD_BYTES).bit_length())
    merged = spool(_merge_shards(_count_ngrams(texts, shards)), "ngram-shards")
    sums = merged.agg(F.sum("total").alias("total"), F.sum("distinct").alias("distinct")).first()
    hot = _unpacked(merged, _hot_limit(merged)).toArrow()
    keys = hot.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    model = BloomModel(
        shift=64 - (shards.bit_length() - 1),
        offsets=np.zeros(0, np.int64),
        masks=np.zeros(0, np.uint64),
        cutoffs=np.zeros(0),
        bits=np.zeros(0, np.uint8),
        hot_keys=keys[order],
        hot_counts=hot.column("count").to_numpy()[order],
        total=sums["total"] or 0,
        distinct=sums["distinct"] or 0,
        prior=prior,
    )
    return model, merged.select("shard", "words", "counts", "segment")


def _bytes(texts: DataFrame) -> int:
    return texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def _hot_limit(merged: DataFrame) -> int:
    """Smallest count, in steps of a quarter of a binary order, that at most ``HOT_WORDS`` words reach."""

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for counts in batch.column("counts").to_pylist():
                step = np.floor(4 * np.log2(np.frombuffer(counts, "<i8"))).astype(np.int64)
                found, rows = np.unique(step, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(rows)], names=["step", "rows"])

    found = merged.select("counts").mapInArrow(steps, "step long, rows long")
    rows = sorted(found.groupBy("step").agg(F.sum("rows").alias("rows")).collect(), reverse=True)  # 256 at most
    least, kept = 1 << 62, 0
    for step, count in rows:
        kept += count
        if kept > HOT_WORDS:
            return least
        least = int(np.ceil(2 ** (step / 4) - 1e-9))
    return 1


def _texts_tokens(rows: pa.Table) -> list[Tokens]:
    column = rows.column("text").combine_chunks()
    texts = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    return [tokens(chunk) for chunk in chunks(texts)]


def _different(parts: Iterable[np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *(np.unique(part) for part in parts)]))


def _ask(rows: pa.Table, model: BloomModel) -> pa.Table:
    """A group's words that the model does not hold (kind 1) and its pairs (kind 2), packed by shard."""
    found = _texts_tokens(rows)
    kinds = _different(one.hashes for one in found)
    pairs = _different(pair_keys(one) for one in found)
    packed = [
        (kind, shard, pack_keys(keys[begin:end]))
        for kind, keys in ((1, kinds[model.exact(kinds) == 0]), (2, pairs))
        for shard, begin, end in _by_shard(keys, 1 << (64 - model.shift))
    ]
    return pa.table(
        {
            "kind": pa.array([kind for kind, _, _ in packed], pa.int32()),
            "group": pa.array(np.full(len(packed), rows.column("group")[0].as_py(), np.int64)),
            "shard": pa.array([shard for _, shard, _ in packed], pa.int32()),
            "keys": pa.array([keys for _, _, keys in packed], pa.binary()),
        }
    )


def _answer(asked: pa.Table, held: pa.Table) -> pa.Table:
    """Exact counts of the words and levels of the pairs that groups ask of one shard."""
    kinds = asked.column("kind").to_numpy()
    packed = asked.column("keys").to_pylist()
    answers: list[bytes] = [b""] * len(packed)
    words_here = counts = np.zeros(0, np.int64)
    filled = None
    if held.num_rows:
        words_here = np.frombuffer(held.column("words")[0].as_py(), "<u8")
        counts = np.frombuffer(held.column("counts")[0].as_py(), "<i8")
        filled = segment_model(held.column("segment")[0].as_py())

    def look_up(kind: int, keys: np.ndarray) -> np.ndarray:
        if kind == 2:
            return (np.zeros(len(keys)) if filled is None else filled.levels(keys)).astype("u1")
        if not len(words_here):
            return np.zeros(len(keys), "<i8")
        place = np.minimum(np.searchsorted(words_here, keys), len(words_here) - 1)
        return np.where(words_here[place] == keys, counts[place], 0).astype("<i8")

    for kind in (1, 2):
        block: list[int] = []
        keys: list[np.ndarray] = []
        at = np.flatnonzero(kinds == kind).tolist()
        for i in at:
            block.append(i)
            keys.append(unpack_keys(packed[i]))
            if i == at[-1] or sum(map(len, keys)) > BLOCK:
                found = look_up(kind, np.concatenate(keys))
                ends = np.cumsum([len(part) for part in keys])
                for j, part in zip(block, np.split(found, ends[:-1])):
                    answers[j] = part.tobytes()
                block, keys = [], []
    return pa.table(
        {
            "group": asked.column("group"),
            "shard": asked.column("shard"),
            "kind": asked.column("kind"),
            "found": pa.array(answers, pa.binary()),
        }
    )


def score(
    docs: DataFrame, model: BloomModel, shards: DataFrame, identity: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, n_known, train_tokens, base_score, score.

    Null counts as empty, and an empty text has one token, its end. Rows go in groups of about ``GROUP_BYTES``
    of text; a group sends its different words and pairs to their shards, which answer words (but the broadcast
    ones) with exact counts and pairs from the shard's segment of the filter, and is scored with the answers.
    Without training text the base score is 0. Rows may repeat or lack an id. An empty table gives an empty
    result; other columns are not looked at.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(identity).alias("doc_id"), F.col(text).alias("text"))
    kind_of_id = dict(rows.dtypes)["doc_id"]
    size = _bytes(rows)
    # The row and its partition decide on the group, so repeated tasks give the same one and copies spread out.
    group = F.pmod(F.xxhash64("doc_id", "text", F.spark_partition_id()), F.lit(1 + size // GROUP_BYTES).cast("long"))
    grouped = rows.select(group.alias("group"), "doc_id", "text").repartition("group")

    def ask(left: pa.Table) -> pa.Table:
        return _ask(left, sent.value)

    keys = grouped.groupBy("group").applyInArrow(ask, "kind int, group long, shard int, keys binary")
    # Should more text be scored than counted, several tasks answer for a shard.
    parts = 1 + size // (SHARD_BYTES << (64 - model.shift))
    keys = keys.withColumn("part", F.pmod(F.xxhash64("group"), F.lit(parts).cast("long")))
    everywhere = shards.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    answers = (
        keys.groupBy("shard", "part")
        .cogroup(everywhere.groupBy("shard", "part"))
        .applyInArrow(_answer, "group long, shard int, kind int, found binary")
    )

    def measure(left: pa.Table, right: pa.Table) -> pa.Table:
        return _measure(left, right, sent.value)

    return (
        grouped.groupBy("group")
        .cogroup(answers.groupBy("group"))
        .applyInArrow(
            measure,
            f"doc_id {kind_of_id}, n_tokens long, n_known long, train_tokens long, base_score double, score double",
        )
    )


def _measure(rows: pa.Table, answers: pa.Table, model: BloomModel) -> pa.Table:
    """Scores of a group's rows from what its shards answered, which is in the order of the sorted keys."""
    found = _texts_tokens(rows)
    kinds = _different(one.hashes for one in found)
    keys = [pair_keys(one) for one in found]
    pairs = _different(keys)
    answers = answers.sort_by("shard")
    kind = answers.column("kind").to_numpy()
    packed = answers.column("found").to_pylist()
    single = model.exact(kinds).copy()
    single[single == 0] = np.frombuffer(b"".join(packed[i] for i in np.flatnonzero(kind == 1)), "<i8")
    levels = np.frombuffer(b"".join(packed[i] for i in np.flatnonzero(kind == 2)), "u1")
    counts = count_of(levels.astype(np.int64), np.ones(len(levels)))
    base = np.log10((single + 1) / float(model.total + model.distinct + 1))
    columns: list[list[np.ndarray]] = [[], [], [], []]
    for one, own in zip(found, keys):
        place, before = np.searchsorted(kinds, one.hashes), np.searchsorted(kinds, one.before)
        logs = model.log_probability(single, counts[np.searchsorted(pairs, own)], place, before)
        columns[0].append(np.diff(one.bounds))
        columns[1].append(per_document((single[place] > 0).astype(float), one.bounds).astype(np.int64))
        columns[2].append(per_document(base[place], one.bounds))
        columns[3].append(per_document(logs, one.bounds))
    n_tokens, n_known, base_score, scores = (np.concatenate(column) if column else np.zeros(0) for column in columns)
    return pa.table(
        {
            "doc_id": rows.column("doc_id"),
            "n_tokens": pa.array(n_tokens.astype(np.int64)),
            "n_known": pa.array(n_known.astype(np.int64)),
            "train_tokens": pa.array(np.full(len(n_tokens), model.total, np.int64)),
            "base_score": pa.array(base_score),
            "score": pa.array(scores),
        }
    )
