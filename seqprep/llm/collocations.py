"""Phrase collocations, mined set by set over sorted occurrence relations."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from seqprep.llm.text import mix
from seqprep.sources.spool import spool

LEAST = 10  # occurrences of a candidate
MOST_WORDS = 3  # of a phrase
TOP = 2000  # phrases of a language
SCALE = 1_000_000
COVERED = 50  # percent of a candidate's occurrences that lie in one longer candidate and drop it
UNKNOWN = "und"

BLOCK_BYTES = 4 << 20  # of words in a block, about
WINDOW_BYTES = 1 << 20  # of text that is split into words at a time
SHARD_WORDS = 500_000  # (block, word) pairs of a shard, about
SHARD_PHRASES = 2_000_000  # occurrences that a shard of phrases stands for, about
RANK_PARTS = 16  # of a language, each ranked for itself before the language is
TASK_BLOCKS = 16  # blocks, or a quarter of it shards, that a task works through one by one
_ID_BITS = 32

_BREAK = np.zeros(256, dtype=bool)  # ends a piece
_BREAK[[ord(c) for c in ".,;:!?\n\v\f\r"]] = True
_BLANK = _BREAK.copy()  # ends a word
_BLANK[[0x20, 0x09]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_POWERS = np.multiply.accumulate(np.full(1024, 0x9E3779B97F4A7C15, dtype=np.uint64))


def pack(values: np.ndarray) -> bytes:
    """Non-negative whole numbers, byte plane by byte plane, in as few planes as the largest one needs."""
    values = np.ascontiguousarray(values, dtype="<u8")
    planes = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return bytes([planes]) + values.view(np.uint8).reshape(-1, 8)[:, :planes].T.tobytes()


def unpack(data: bytes) -> np.ndarray:
    planes = data[0]
    rows = np.frombuffer(data, np.uint8, offset=1).reshape(planes, -1)
    values = np.zeros((rows.shape[1], 8), np.uint8)
    values[:, :planes] = rows.T
    return values.view("<u8").ravel()


def _windows(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bytes of whole words, and the places in them where documents begin, some ``WINDOW_BYTES`` at a time."""
    begin, last = int(bounds[0]), int(bounds[-1])
    while begin < last:
        end = min(begin + WINDOW_BYTES, last)
        while end < last and not _BLANK[data[end - 1]]:  # on to the end of the word
            blanks = np.flatnonzero(_BLANK[data[end : end + WINDOW_BYTES]])
            end = end + int(blanks[0]) + 1 if len(blanks) else min(end + WINDOW_BYTES, last)
        low, high = np.searchsorted(bounds, (begin, end))
        yield data[begin:end], bounds[low:high] - begin
        begin = end


def split_words(texts: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Words of whole texts (null: empty) in order, and of each word whether a piece begins with it.

    Pieces end at ``.,;:!?``, at 0x0A to 0x0D and with the text; words also end at spaces and tabs. A-Z are
    lower-cased. Texts are worked on in windows that are cut between words; a piece goes on across them.
    """
    texts = texts.cast(pa.large_string())
    texts = texts.fill_null("") if texts.null_count else texts
    _, offsets, data = texts.buffers()
    if data is None or not len(texts):
        return
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    fresh = True
    for part, documents in _windows(np.frombuffer(data, np.uint8), offsets):
        letter = ~_BLANK[part]
        opens = letter.copy()
        opens[1:] &= ~letter[:-1]
        opens[documents] = letter[documents]
        starts = np.flatnonzero(opens)
        ended = _BREAK[part].astype(np.int64)  # piece ends up to each byte; a document's start counts as one
        ended[documents] += 1
        ended = np.cumsum(ended)
        if not len(starts):
            fresh = fresh or bool(ended[-1])
            continue
        at = ended[starts]
        new = np.diff(at, prepend=at[0]) > 0
        new[0] = fresh or at[0] > 0
        fresh = bool(ended[-1] > at[-1])
        letters = _LOWER[part[letter]]
        cuts = np.append(np.cumsum(letter)[starts] - 1, len(letters)).astype(np.int64)
        buffers = [None, pa.py_buffer(cuts), pa.py_buffer(letters)]
        yield pa.Array.from_buffers(pa.large_binary(), len(starts), buffers), new


def _hashes(keys: pa.Array) -> np.ndarray:
    """A hash of every key (none is empty); it only decides where a key is counted."""
    offsets = np.frombuffer(keys.buffers()[1], np.int64)[keys.offset : keys.offset + len(keys) + 1]
    data = np.frombuffer(keys.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    place = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    return mix(np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * _POWERS[place & 1023], offsets[:-1]))


def _shards(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each hash; higher hashes never have lower shards."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


class _Block:
    """Occurrences of some pieces, by language."""

    def __init__(self) -> None:
        self.parts: dict[str, list[tuple[pa.Array, np.ndarray]]] = {}
        self.bytes = 0

    def add(self, lang: str, words: pa.Array, new: np.ndarray) -> None:
        if len(words):
            self.parts.setdefault(lang, []).append((words, new))
            self.bytes += int(pc.sum(pc.binary_length(words)).as_py()) + len(words)

    def rows(self, number: int) -> Iterator[pa.RecordBatch]:
        """One row: distinct keys (word, space, language) in order of their hashes with their counts, and the
        occurrences, in order, as places of keys from 1, with 0 where a piece begins."""
        if not self.parts:
            return
        keys, streams, sizes, before = [], [], [], 0
        for lang, parts in self.parts.items():
            coded = pa.chunked_array([words for words, _ in parts]).combine_chunks().dictionary_encode()
            new = np.concatenate([new for _, new in parts])
            stream = np.full(len(new) + int(new.sum()), -1, np.int64)
            stream[np.arange(len(new)) + np.cumsum(new)] = coded.indices.to_numpy() + before
            streams.append(stream)
            sizes.append(len(new))
            name = pa.scalar(lang.encode(), pa.large_binary())
            keys.append(pc.binary_join_element_wise(coded.dictionary, name, pa.scalar(b" ", pa.large_binary())))
            before += len(coded.dictionary)
        keys, stream = pa.chunked_array(keys).combine_chunks(), np.concatenate(streams)
        order = np.argsort(_hashes(keys), kind="stable")
        place = np.zeros(before + 1, np.int64)
        place[order] = np.arange(1, before + 1)
        stream = place[stream]  # -1 is the last place, which holds 0
        counts = np.bincount(stream, minlength=before + 1)[1:]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([number]),
                pa.array([before]),
                pa.array([sum(sizes)]),
                pa.array([list(self.parts)], pa.list_(pa.string())),
                pa.array([sizes], pa.list_(pa.int64())),
                pa.ListArray.from_arrays(pa.array([0, before], pa.int32()), keys.take(pa.array(order)).cast(pa.binary())),
                pa.array([pack(counts)], pa.binary()),
                pa.array([pack(stream)], pa.binary()),
            ],
            names=["block", "kinds", "words", "langs", "sizes", "keys", "counts", "stream"],
        )


_RELATION = (
    "block bigint, kinds bigint, words bigint, langs array<string>, sizes array<bigint>, "
    "keys array<binary>, counts binary, stream binary"
)


def occurrences(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The stored relation of word occurrences, sorted by piece and position, in blocks of whole pieces.

    Null languages are ``und``. A block ends where a piece does, so only a single piece can make it large.
    """
    named = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, block = TaskContext.get().partitionId() << _ID_BITS, _Block()
        for batch in batches:
            langs, texts = batch.column("lang"), batch.column("text")
            for name in pc.unique(langs).to_pylist():
                for words, new in split_words(texts.filter(pc.equal(langs, name))):
                    first = int(new.argmax())
                    if block.bytes >= BLOCK_BYTES and new[first]:
                        block.add(name, words[:first], new[:first])
                        yield from block.rows(number)
                        number, block = number + 1, _Block()
                        words, new = words[first:], new[first:]
                    block.add(name, words, new)
        yield from block.rows(number)

    return spool(named.mapInArrow(cut, _RELATION), "phrase-occurrences")


def _spread(df: DataFrame, key: str, groups: int, each: int) -> DataFrame:
    """Deal rows out by a key; the number of tasks follows from the number of groups."""
    tasks = max(1, min(groups, 4 * df.sparkSession.sparkContext.defaultParallelism), -(-groups // each))
    return df.repartition(tasks, key)


# What a shard says: to each block the numbers of the keys that it sent (0: not frequent), and to all the
# frequent keys themselves with their numbers and counts.
_ANSWERS = "block bigint, shard bigint, numbers binary, keys array<binary>, pairs binary, ids binary, totals binary"


def _answers(shard: int, blocks: list, numbers: np.ndarray, sizes: list[int], **frequent) -> pa.Table:
    cuts = np.cumsum([0, *sizes])
    rows = [
        {"block": block, "shard": shard, "numbers": pack(numbers[a:b])} for block, a, b in zip(blocks, cuts[:-1], cuts[1:])
    ]
    rows.append({"shard": shard} | frequent)
    kinds = [("block", pa.int64()), ("shard", pa.int64()), ("numbers", pa.binary()), ("keys", pa.list_(pa.binary()))]
    kinds += [(name, pa.binary()) for name in ("pairs", "ids", "totals")]
    return pa.Table.from_pylist(rows, pa.schema(kinds))


def _number(kept: np.ndarray, shard: int, shards: int) -> np.ndarray:
    """Numbers from 1 for the kept of some sorted keys, unlike those of any other shard; 0 for the rest."""
    numbers = np.zeros(len(kept), np.int64)
    numbers[kept] = np.arange(kept.sum()) * shards + shard + 1
    if len(numbers) and numbers.max() >= 1 << _ID_BITS:
        raise OverflowError(f"more than 2**{_ID_BITS} frequent phrases of one length")
    return numbers


def _frequent_words(relation: DataFrame, shards: int, least: int) -> DataFrame:
    """Count words by shard."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                keys = batch.column("keys")[row].values.cast(pa.large_binary())
                counts = unpack(batch.column("counts")[row].as_py())
                shard = _shards(_hashes(keys), shards)
                used, cuts = np.unique(shard, return_index=True)  # keys are in order of their hashes
                cuts = np.append(cuts, len(shard))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column("block")[row].as_py()] * len(used), pa.int64()),
                        pa.array(used),
                        pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), keys.cast(pa.binary())),
                        pa.array([pack(counts[a:b]) for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
                    ],
                    names=["block", "shard", "keys", "counts"],
                )

    def count(rows: pa.Table) -> pa.Table:
        rows, shard = rows.combine_chunks(), rows.column("shard")[0].as_py()
        listed = rows.column("keys").combine_chunks()
        coded = listed.flatten().dictionary_encode()
        place = coded.indices.to_numpy()
        totals = np.zeros(len(coded.dictionary), np.int64)
        np.add.at(totals, place, np.concatenate([unpack(part) for part in rows.column("counts").to_pylist()]).astype(np.int64))
        order = np.array(pc.sort_indices(coded.dictionary))  # so that numbers do not depend on who came first
        kept = totals[order] >= least
        ids = np.zeros(len(order), np.int64)
        ids[order] = _number(kept, shard, shards)
        chosen = order[kept]
        return _answers(
            shard, rows.column("block").to_pylist(), ids[place], pc.list_value_length(listed).to_pylist(),
            keys=coded.dictionary.take(pa.array(chosen)).to_pylist(), ids=pack(ids[chosen]), totals=pack(totals[chosen]),
        )

    sent = relation.select("block", "keys", "counts").mapInArrow(
        send, "block bigint, shard bigint, keys array<binary>, counts binary"
    )
    counted = _spread(sent, "shard", shards, TASK_BLOCKS // 4).groupBy("shard").applyInArrow(count, _ANSWERS)
    return spool(counted, "phrase-words")


def extend(stream: np.ndarray, answers: list[np.ndarray], shards: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge-join of a block's sorted occurrences: keys of the phrases one word longer than the last answers.

    ``answers`` holds, for each length so far, the numbers of the block's keys in the order they were sent.
    Occurrences of phrases that are not frequent fall out at each length; what is left at a position meets the
    word at the adjacent one, where the phrase that begins one word later must be frequent too. Returns the
    distinct keys, (number of the phrase, number of the word), their counts and shards, in the order to send.
    """
    words = np.concatenate(([0], answers[0].astype(np.int64)))[stream]
    found = words
    for length, shard_count in enumerate(shards, start=1):
        held = np.zeros(len(words), dtype=bool)
        held[: len(words) - length] = (found[: len(words) - length] > 0) & (found[1 : len(words) - length + 1] > 0)
        at = np.flatnonzero(held)
        keys = found[at].astype(np.uint64) << np.uint64(_ID_BITS) | words[at + length].astype(np.uint64)
        keys, place, counts = np.unique(keys, return_inverse=True, return_counts=True)
        shard = _shards(mix(keys), shard_count)
        order = np.argsort(shard, kind="stable")
        if length < len(shards):
            numbers = np.zeros(len(keys), np.int64)
            numbers[order] = answers[length]
            found = np.zeros(len(words), np.int64)
            found[at] = numbers[place]
    return keys[order], counts[order], shard[order]


def _frequent_phrases(relation: DataFrame, earlier: list[DataFrame], shards: list[int], blocks: int, least: int) -> DataFrame:
    """Join, count and answer phrases one word longer than those of the last of ``earlier``.

    ``shards`` has the number of shards of each length from 2 on.
    """
    answers = [
        table.filter("block IS NOT NULL").select("block", F.lit(length).alias("length"), "shard", "numbers")
        for length, table in enumerate(earlier)
    ]
    answers = _spread(reduce(DataFrame.unionByName, answers), "block", blocks, TASK_BLOCKS)
    streams = _spread(relation.select("block", "stream"), "block", blocks, TASK_BLOCKS)
    steps = len(earlier)

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by([("length", "ascending"), ("shard", "ascending")])
        length = right.column("length").to_numpy()
        parts = [unpack(part) for part in right.column("numbers").to_pylist()]
        numbers = [
            np.concatenate([p for p, own in zip(parts, length) if own == step] or [np.zeros(0, np.uint64)])
            for step in range(steps)
        ]
        stream = unpack(left.column("stream")[0].as_py()).astype(np.int64)
        keys, counts, shard = extend(stream, numbers, shards)
        used, cuts = np.unique(shard, return_index=True)
        cuts = np.append(cuts, len(shard))
        between = list(zip(cuts[:-1], cuts[1:]))
        return pa.table(
            {
                "block": pa.array([left.column("block")[0].as_py()] * len(used), pa.int64()),
                "shard": pa.array(used, pa.int64()),
                "pairs": pa.array([pack(np.diff(keys[a:b], prepend=np.uint64(0))) for a, b in between], pa.binary()),
                "counts": pa.array([pack(counts[a:b]) for a, b in between], pa.binary()),
            }
        )

    def count(rows: pa.Table) -> pa.Table:
        shard = rows.column("shard")[0].as_py()
        parts = [np.cumsum(unpack(part), dtype=np.uint64) for part in rows.column("pairs").to_pylist()]
        keys, place = np.unique(np.concatenate(parts), return_inverse=True)
        totals = np.zeros(len(keys), np.int64)
        np.add.at(totals, place, np.concatenate([unpack(part) for part in rows.column("counts").to_pylist()]).astype(np.int64))
        kept = totals >= least
        ids = _number(kept, shard, shards[-1])
        return _answers(
            shard, rows.column("block").to_pylist(), ids[place], [len(part) for part in parts],
            pairs=pack(keys[kept]), ids=pack(ids[kept]), totals=pack(totals[kept]),
        )

    joined = streams.groupBy("block").cogroup(answers.groupBy("block"))
    sent = joined.applyInArrow(join, "block bigint, shard bigint, pairs binary, counts binary")
    counted = _spread(sent, "shard", shards[-1], TASK_BLOCKS // 4).groupBy("shard").applyInArrow(count, _ANSWERS)
    return spool(counted, "phrase-pairs")


def _listed(answers: DataFrame, length: int) -> DataFrame:
    """Frequent keys of one length as rows: (id, key, a) for words, (id, start, word, a) for longer phrases."""
    own = answers.filter("block IS NULL").select("keys", "pairs", "ids", "totals")

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, totals = (unpack(batch.column(name)[row].as_py()).astype(np.int64) for name in ("ids", "totals"))
                if length == 1:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids), batch.column("keys")[row].values, pa.array(totals)], names=["id", "key", "a"]
                    )
                else:
                    pairs = unpack(batch.column("pairs")[row].as_py())
                    start, word = pairs >> np.uint64(_ID_BITS), pairs & np.uint64((1 << _ID_BITS) - 1)
                    arrays = [pa.array(part.astype(np.int64)) for part in (ids, start, word, totals)]
                    yield pa.RecordBatch.from_arrays(arrays, names=["id", "start", "word", "a"])

    schema = "id bigint, key binary, a bigint" if length == 1 else "id bigint, start bigint, word bigint, a bigint"
    return own.mapInArrow(unfold, schema)


def frequent_phrases(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, most_words: int = MOST_WORDS
) -> tuple[DataFrame, DataFrame]:
    """All phrases of 1 to ``most_words`` words that occur ``least`` times in a language, and words per language.

    The first table has (lang, phrase, ids, a): the words' numbers identify a phrase; the second (lang, n).
    """
    relation = occurrences(docs, text, lang)
    seen = relation.agg(F.count("*").alias("blocks"), F.sum("kinds").alias("kinds"), F.sum("words").alias("words")).first()
    shards = [max(1, -(-(seen["kinds"] or 0) // SHARD_WORDS))]
    shards += [max(1, -(-(seen["words"] or 0) // SHARD_PHRASES))] * (most_words - 1)
    found = [_frequent_words(relation, shards[0], least)]
    while len(found) < most_words:
        found.append(_frequent_phrases(relation, found, shards[1 : len(found) + 1], max(1, seen["blocks"]), least))
    cut = F.instr(F.col("key").cast("string"), " ")
    words = _listed(found[0], 1).select(
        "id", "a", F.expr("substring_index(string(key), ' ', 1)").alias("phrase"),
        F.col("key").cast("string").substr(cut + 1, F.length(F.col("key").cast("string"))).alias("lang"),
        F.array("id").alias("ids"),
    )
    words = spool(words, "phrase-names")
    tables = [words]
    for length, answers in enumerate(found[1:], start=2):
        longer = _listed(answers, length).withColumnRenamed("id", "longer").withColumnRenamed("a", "times")
        start = tables[-1].select(F.col("id").alias("start"), "lang", "phrase", "ids")
        last = words.select(F.col("id").alias("word"), F.col("phrase").alias("last"))
        named = longer.join(start, "start").join(last, "word")
        named = named.select(
            F.col("longer").alias("id"), F.col("times").alias("a"), F.concat_ws(" ", "phrase", "last").alias("phrase"),
            "lang", F.concat("ids", F.array("word")).alias("ids"),
        )
        tables.append(spool(named, "phrase-names"))
    sizes = relation.select(F.explode(F.arrays_zip("langs", "sizes")).alias("part")).select("part.*")
    totals = sizes.groupBy(F.col("langs").alias("lang")).agg(F.sum("sizes").alias("n"))
    return reduce(DataFrame.unionByName, tables).drop("id"), totals


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST,
    most_words: int = MOST_WORDS,
    top: int = TOP,
) -> DataFrame:
    """The best phrases of every language: lang, rank, phrase, a, l, r, n, score.

    Texts (null: empty) are split into pieces and words as ``split_words`` says; null languages are ``und``.
    Candidates are phrases of 2 to ``most_words`` words that occur ``least`` times, overlaps included. A cut
    after the first k words scores floor(SCALE * a * a / (l * r)), in exact decimals, l and r being the
    occurrences of the two parts; the lowest score counts, then the smallest k. A candidate goes if one longer
    candidate that contains it has at least ``COVERED`` percent of its occurrences. Ranks go by score, then a,
    then phrase in byte order. Equal texts count as often as they occur; a language with no candidate, and an
    empty table, give no rows; other columns are not looked at.

    Occurrences are stored sorted by piece and position. Of each length, blocks send their distinct phrases to
    shards, which add them up and answer with numbers for the frequent ones; the next length is the merge-join
    of what is left at adjacent positions. No phrase's or language's occurrences meet in one task.
    """
    phrases, totals = frequent_phrases(docs, text, lang, least, most_words)
    size = F.size("ids")
    candidates = phrases.filter(size >= 2)
    inner = F.expr(
        "flatten(transform(sequence(2, size(ids) - 1), n ->"
        " transform(sequence(1, size(ids) - n + 1), k -> slice(ids, k, n))))"
    )
    contained = candidates.filter(size >= 3).select(F.explode(inner).alias("ids"), "a")
    covered = contained.groupBy("ids").agg(F.max("a").alias("longer"))
    kept = candidates.join(covered, "ids", "left").filter(
        F.coalesce(F.col("longer") * 100 < F.col("a") * COVERED, F.lit(True))
    )
    cuts = kept.select(
        "lang", "phrase", "ids", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k")
    ).select("*", F.slice("ids", F.lit(1), F.col("k")).alias("first"), F.slice("ids", F.col("k") + 1, size).alias("rest"))
    parts = phrases.filter(size < most_words).select("ids", "a")
    cuts = cuts.join(parts.select(F.col("ids").alias("first"), F.col("a").alias("l")), "first")
    cuts = cuts.join(parts.select(F.col("ids").alias("rest"), F.col("a").alias("r")), "rest")
    exact = "decimal(38,0)"
    score = F.expr(
        f"CAST({SCALE} AS {exact}) * CAST(a AS {exact}) * CAST(a AS {exact}) div (CAST(l AS {exact}) * CAST(r AS {exact}))"
    )
    best = F.min(F.struct(score.alias("score"), "k", "l", "r"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(best.alias("best")).select("lang", "phrase", "a", "best.*")
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))  # so that a language's last task sees a bounded number
    for group in ([F.col("lang"), part], [F.col("lang")]):
        scored = scored.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
        scored = scored.filter(F.col("rank") <= top)
    return scored.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
