"""Similarity join of texts on word n-grams: rare-first prefixes, then length, positional and suffix filters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from seqprep.llm.among import maybe_among
from seqprep.llm.components import connected_components
from seqprep.llm.text import Chunk, chunks, mix, ngrams, words
from seqprep.sources.spool import spool, spool_scope

WORDS = 3  # words of a shingle
PERCENT = 90  # of the union that two sets must share
COUNTERS = 1 << 20  # hash counters of shingle frequency; they only decide the order, never a result
COUNTER_BLOCK = 1 << 12
PAIRED = 100  # sets that share a prefix shingle are paired one by one up to this many,
PAIRS_A_SET = 2  # and this many pairs a set; above, they meet again with their cell counts
HOT_ROWS = 2000  # a prefix shingle with this many rows, and over 1/4096 of all, is grouped without a shuffle
HOT_SHARE = 4096
TILE_SETS = 4096  # different sets that one task compares
TILE_SHINGLES = 4_000_000
CELLS = 64  # at least, of the counts that pairs are filtered with before any texts move;
CELL_SIZE = 8  # as many as give a cell up to this many members, a power of two,
MOST_CELLS = 1 << 16
TILE_CELLS = 512  # of the counts that the comparison of a tile filters with

_U64 = np.uint64
_LEVEL_SHIFT = _U64(58)


def least_overlap(left: np.ndarray, right: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Fewest common shingles with which sets of these sizes reach the threshold."""
    return -(-percent * (left + right) // (100 + percent))


def prefix_length(size: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Shingles of a set, rarest first, of which a linked set must hold one."""
    return size + (-percent * size // 100) + 1


def shingle_sets(chunk: Chunk, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Document numbers and hashes of all shingles of a chunk, repeats included.

    A text of fewer words than a shingle has its whole word sequence as its one shingle.
    """
    found = words(chunk)
    grams = ngrams(found, size)
    owners, hashes = [grams.documents], [grams.hashes]
    counts = np.diff(found.bounds)
    for row in np.flatnonzero((counts > 0) & (counts < size)):
        value = np.array([counts[row]], dtype=np.uint64)
        for word in found.hashes[found.bounds[row] : found.bounds[row + 1]]:
            value = mix(value * _U64(0xD6E8FEB86659FD93) + word)
        owners.append(np.array([row]))
        hashes.append(value)
    return np.concatenate(owners), np.concatenate(hashes)


def _distinct(owners: np.ndarray, values: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct (owner, value), and where each owner's values begin."""
    order = np.lexsort((values, owners))
    owners, values = owners[order], values[order]
    keep = np.ones(len(values), dtype=bool)
    keep[1:] = (owners[1:] != owners[:-1]) | (values[1:] != values[:-1])
    owners, values = owners[keep], values[keep]
    return owners, values, np.searchsorted(owners, np.arange(rows + 1))


def cell_counts(owners: np.ndarray, values: np.ndarray, rows: int, cells: int) -> np.ndarray:
    """How many members of each set fall on each of ``cells`` cells of the hash.

    Two sets differ in at least as many members as these counts differ, summed over all cells.
    """
    place = owners * cells + ((values >> _U64(24)) & _U64(cells - 1)).astype(np.int64)
    return np.bincount(place, minlength=rows * cells).reshape(rows, cells)


def _packed_counts(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """``cell_counts`` modulo 256 of every set, over more cells the larger the set is."""
    sizes = np.diff(bounds)
    cells = np.full(len(sizes), CELLS, dtype=np.int64)
    while (short := (cells * CELL_SIZE < sizes) & (cells < MOST_CELLS)).any():
        cells[short] *= 2
    starts = np.concatenate(([0], np.cumsum(cells)))
    inside = (values >> _U64(24)).astype(np.int64) & np.repeat(cells - 1, sizes)
    counts = np.bincount(np.repeat(starts[:-1], sizes) + inside, minlength=starts[-1]).astype(np.uint8)
    return pa.Array.from_buffers(
        pa.binary(), len(sizes), [None, pa.py_buffer(starts.astype(np.int32).tobytes()), pa.py_buffer(counts.tobytes())]
    )


def _cell_widths(counts: pa.Array) -> np.ndarray:
    return np.asarray(pc.binary_length(counts)).astype(np.int64)


def _folded(counts: pa.Array, cells: int) -> np.ndarray:
    """Counts over ``cells`` cells of sets that have at least as many: cells fold onto those of the same low bits."""
    widths = _cell_widths(counts)
    result = np.empty((len(widths), cells), dtype=np.uint8)
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        flat = np.frombuffer(b"".join(counts.take(pa.array(rows)).to_pylist()), np.uint8)
        result[rows] = flat.reshape(len(rows), width // cells, cells).sum(1, dtype=np.uint8)
    return result


def least_difference(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Lower bound on the members that one set has and the other lacks, from counts kept modulo 256."""
    apart = one - two
    return np.minimum(apart, two - one).sum(1, dtype=np.int64)


def _set_keys(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit number per set that does not depend on the order of its members."""
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(values ^ _U64(0xA24BAED4963EE407)))))
    return mix(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(np.uint64)).view(np.int64)


def _describe(docs: DataFrame, size: int) -> DataFrame:
    """Rows of kind 0: (id, set key, set size, cell counts) per document; of kind 1: a task's counters by block."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(COUNTERS, np.uint32)
        for batch in batches:
            ids = batch.column("id")
            for chunk in chunks(batch.column("text")):
                owners, hashes = shingle_sets(chunk, size)
                owners, values, bounds = _distinct(owners, hashes, chunk.size)
                counters += np.bincount(_counter(values), minlength=COUNTERS).astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.zeros(chunk.size, np.int32)),
                        ids.slice(chunk.first, chunk.size),
                        pa.array(_set_keys(values, bounds)),
                        pa.array(np.diff(bounds)),
                        _packed_counts(values, bounds),
                    ],
                    names=["kind", "id", "set_key", "n", "counts"],
                )
        blocks = [
            {"kind": 1, "id": place, "counts": part.astype("<u4").tobytes()}
            for place, part in enumerate(counters.reshape(-1, COUNTER_BLOCK))
            if part.any()
        ]
        if blocks:
            yield pa.RecordBatch.from_pylist(
                blocks,
                schema=pa.schema(
                    [("kind", pa.int32()), ("id", pa.int64()), ("set_key", pa.int64()), ("n", pa.int64()), ("counts", pa.binary())]
                ),
            )

    return docs.mapInArrow(describe, "kind int, id long, set_key long, n long, counts binary")


def _counter(values: np.ndarray) -> np.ndarray:
    return (values & _U64(COUNTERS - 1)).astype(np.int64)


def _frequency_levels(described: DataFrame) -> np.ndarray:
    """Twice the binary logarithm of every counter's sum over all documents, one byte each (1 MB)."""

    def total(group: pa.Table) -> pa.Table:
        sums = np.zeros(COUNTER_BLOCK, np.uint64)
        for part in group.column("counts").to_pylist():
            sums += np.frombuffer(part, "<u4")
        level = np.minimum(2 * np.log2(sums + 1.0), 63).astype(np.uint8)
        return pa.table({"id": group.column("id").slice(0, 1), "levels": pa.array([level.tobytes()], pa.binary())})

    blocks = described.filter("kind = 1").select("id", "counts").groupBy("id").applyInArrow(total, "id long, levels binary")
    levels = np.zeros(COUNTERS, np.uint8)
    for row in blocks.toArrow().to_pylist():  # COUNTERS bytes in all
        start = row["id"] * COUNTER_BLOCK
        levels[start : start + COUNTER_BLOCK] = np.frombuffer(row["levels"], np.uint8)
    return levels


def _prefixes(docs: DataFrame, levels: np.ndarray, size: int, percent: int) -> DataFrame:
    """(shingle, set_key, n, pos): the rarest shingles of every set; a task gives copies of a set once."""
    sent = docs.sparkSession.sparkContext.broadcast(levels)

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        seen: set[int] = set()
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                owners, hashes = shingle_sets(chunk, size)
                _, values, bounds = _distinct(owners, hashes, chunk.size)
                keys = _set_keys(values, bounds)
                ranked = known[_counter(hashes)].astype(np.uint64) << _LEVEL_SHIFT | hashes >> _U64(6)
                owners, ranked, bounds = _distinct(owners, ranked, chunk.size)
                sizes = np.diff(bounds)
                fresh = np.zeros(chunk.size, dtype=bool)
                for row, key in enumerate(keys.tolist()):
                    if key not in seen:
                        fresh[row] = True
                        seen.add(key)
                if len(seen) > 1_000_000:
                    seen.clear()
                place = np.arange(len(ranked)) - bounds[owners]
                keep = (place < prefix_length(sizes, percent)[owners]) & fresh[owners]
                owners = owners[keep]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ranked[keep].view(np.int64)),
                        pa.array(keys[owners]),
                        pa.array(sizes[owners].astype(np.int32)),
                        pa.array(place[keep].astype(np.int32)),
                    ],
                    names=["shingle", "set_key", "n", "pos"],
                )

    return docs.mapInArrow(prefixes, "shingle long, set_key long, n int, pos int")


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of rows sorted by ``shingle``, none of which ends inside a shingle."""
    carried: pa.Table | None = None
    for batch in batches:
        now = pa.Table.from_batches([batch])
        if carried is not None:
            now = pa.concat_tables([carried, now])
        shingle = now.column("shingle").to_numpy()
        ends = np.flatnonzero(shingle[1:] != shingle[:-1])
        cut = int(ends[-1]) + 1 if len(ends) else 0
        carried = now.slice(cut)
        if cut:
            yield now.slice(0, cut)
    if carried is not None and len(carried):
        yield carried


def _candidate_pairs(rows: DataFrame, cells: DataFrame, percent: int) -> DataFrame:
    """Edges (u, v) between sets whose components hold every pair that prefix shingles and the filters leave.

    Rows meet by shingle, sorted by size, and are paired if their sizes allow a link (length filter) and what
    follows the shingle does (positional filter). Pairs then meet the cell counts (suffix filter). Where a
    shingle has more than ``PAIRED`` sets or ``PAIRS_A_SET`` pairs a set, no pairs are written: its rows meet
    the cell counts and then each other, and a task passes on no more edges than it has sets.
    """

    paired, pairs_a_set = PAIRED, PAIRS_A_SET

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _whole_groups(batches):
            columns = [group.column(name).to_numpy() for name in ("shingle", "set_key", "n", "pos")]
            yield from _pair_groups(columns, percent, paired, pairs_a_set)

    met = rows.repartition("shingle").sortWithinPartitions("shingle", "n", "set_key").mapInArrow(pair, _MET)
    met = spool(met, "join-pairs")
    plain = met.filter("v IS NOT NULL").groupBy("u", "v").agg(F.first("n_u").alias("n_u"), F.first("n_v").alias("n_v"))
    for side in ("u", "v"):
        counts = cells.select(F.col("set_key").alias(side), F.col("counts").alias(f"cells_{side}"))
        plain = plain.join(counts, side)
    plain = plain.select("u", "v", "n_u", "n_v", "cells_u", "cells_v").mapInArrow(_near(percent), "u long, v long")
    crowds = met.filter("v IS NULL").select("shingle", F.col("u").alias("set_key"), F.col("n_u").alias("n"), "pos")
    crowds = crowds.join(cells, "set_key").select("shingle", "set_key", "n", "pos", "counts")
    crowds = crowds.repartition("shingle").sortWithinPartitions("shingle", "n", "set_key")
    return plain.unionByName(crowds.mapInArrow(_tie_crowds(percent), "u long, v long"))


_MET = "u long, v long, n_u int, n_v int, shingle long, pos int"


def _near(percent: int):
    """Suffix filter: pairs whose cell counts differ by no more than a link allows."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n = batch.column("n_u").to_numpy().astype(np.int64), batch.column("n_v").to_numpy().astype(np.int64)
            allowed = n[0] + n[1] - 2 * least_overlap(*n, percent)
            sides = batch.column("cells_u"), batch.column("cells_v")
            common = np.minimum(*map(_cell_widths, sides))
            kept = np.zeros(batch.num_rows, dtype=bool)
            for cells in np.unique(common).tolist():
                rows = np.flatnonzero(common == cells)
                one, two = (_folded(side.take(pa.array(rows)), cells) for side in sides)
                kept[rows] = least_difference(one, two) <= allowed[rows]
            yield batch.select(["u", "v"]).filter(pa.array(kept))

    return near


def _may_begin(n_u, pos_u, n_v, pos_v, percent: int) -> np.ndarray:
    """Positional filter: whether sets of these sizes may be linked if this shingle is the first they share."""
    return np.minimum(n_u - pos_u, n_v - pos_v) >= least_overlap(n_u, n_v, percent)


def _pair_groups(columns: list[np.ndarray], percent: int, paired: int, pairs_a_set: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``_MET``: pairs of sets, or the single rows of crowded shingles."""
    shingle, key, n, pos = columns
    keep = np.ones(len(key), dtype=bool)
    keep[1:] = (shingle[1:] != shingle[:-1]) | (key[1:] != key[:-1])
    shingle, key, n, pos = shingle[keep], key[keep], n[keep].astype(np.int64), pos[keep].astype(np.int64)
    starts = np.flatnonzero(np.concatenate(([True], shingle[1:] != shingle[:-1])))
    sizes = np.diff(np.append(starts, len(key)))
    group = np.repeat(np.arange(len(starts)), sizes)
    small = (sizes <= paired)[group]
    found = [np.zeros((2, 0), np.int64)]
    for step in range(1, min(paired, int(sizes.max()))):
        left = np.flatnonzero(small[:-step] & (group[:-step] == group[step:]))
        right = left + step
        near = (100 * n[left] >= percent * n[right]) & _may_begin(n[left], pos[left], n[right], pos[right], percent)
        found.append(np.stack((left[near], right[near])))
    left, right = np.concatenate(found, axis=1)
    crowded = (sizes > paired) | (np.bincount(group[left], minlength=len(starts)) > pairs_a_set * sizes)
    plain = ~crowded[group[left]]
    left, right = left[plain], right[plain]
    swap = key[left] > key[right]
    u, v = np.where(swap, right, left), np.where(swap, left, right)
    if len(u):
        none = pa.nulls(len(u), pa.int64()), pa.nulls(len(u), pa.int32())
        yield _met_rows(key[u], pa.array(key[v]), n[u], pa.array(n[v].astype(np.int32)), *none)
    rows = np.flatnonzero(crowded[group])
    if len(rows):
        none = pa.nulls(len(rows), pa.int64()), pa.nulls(len(rows), pa.int32())
        yield _met_rows(key[rows], none[0], n[rows], none[1], pa.array(shingle[rows]), pa.array(pos[rows].astype(np.int32)))


def _met_rows(u, v, n_u, n_v, shingle, pos) -> pa.RecordBatch:
    columns = [pa.array(u), v, pa.array(n_u.astype(np.int32)), n_v, shingle, pos]
    return pa.RecordBatch.from_arrays(columns, names=["u", "v", "n_u", "n_v", "shingle", "pos"])


def _tie_crowds(percent: int):
    """Edges that connect what the filters leave among the sets of each shingle; rows are sorted by shingle and size."""

    def tie(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups in _whole_groups(batches):
            shingle = groups.column("shingle").to_numpy()
            starts = np.flatnonzero(np.concatenate(([True], shingle[1:] != shingle[:-1])))
            key, n, pos = (groups.column(name).to_numpy() for name in ("set_key", "n", "pos"))
            counts = groups.column("counts").combine_chunks()
            if isinstance(counts, pa.ChunkedArray):
                counts = pa.concat_arrays(counts.chunks)
            for a, b in zip(starts, np.append(starts[1:], len(key))):
                u, v = tie_group(n[a:b].astype(np.int64), pos[a:b].astype(np.int64), counts.slice(a, b - a), percent)
                yield pa.RecordBatch.from_arrays([pa.array(key[a + u]), pa.array(key[a + v])], names=["u", "v"])

    return tie


def tie_group(n: np.ndarray, pos: np.ndarray, counts: pa.Array, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (u, v) of edges, fewer than sets, that connect all pairs that pass the three filters.

    Sets go by size, so a window bounds the partners; those already connected are not looked at again.
    """
    widths = _cell_widths(counts)
    ends = np.searchsorted(n, 100 * n // percent, side="right")
    labels = np.arange(len(n))
    edges = [np.zeros((2, 0), np.int64)]
    for width in np.unique(widths).tolist():  # grows with the size
        own = np.flatnonzero(widths == width)
        first = int(own[0])
        table = _folded(counts.slice(first, int(ends[own[-1]]) - first), width)
        for i in own.tolist():
            others = np.arange(i + 1, ends[i])
            others = others[labels[others] != labels[i]]
            others = others[_may_begin(n[i], pos[i], n[others], pos[others], percent)]
            if not len(others):
                continue
            allowed = n[i] + n[others] - 2 * least_overlap(n[i], n[others], percent)
            others = others[least_difference(table[others - first], table[i - first]) <= allowed]
            if len(others):
                joined, at = np.unique(labels[others], return_index=True)
                edges.append(np.stack((np.full(len(at), i), others[at])))
                labels[np.isin(labels, joined)] = labels[i]
    return tuple(np.concatenate(edges, axis=1))


def _hot_shingles(rows: DataFrame) -> DataFrame:
    """(shingle, first_key) of shingles with too many rows for one task; at most ``HOT_SHARE`` of them."""
    limit = max(HOT_ROWS, rows.count() // HOT_SHARE)
    # A shingle's counter, whose level is in the top bits, is at least its number of rows.
    least = int(min(2 * np.log2(limit + 1.0), 63))
    rows = rows.filter(F.shiftrightunsigned("shingle", int(_LEVEL_SHIFT)) >= least)
    counts = rows.groupBy("shingle").agg(F.count("*").alias("rows"), F.min("set_key").alias("first_key"))
    return spool(counts.filter(F.col("rows") > limit).select("shingle", "first_key"), "hot-shingles")


def compare_tile(sets: list[np.ndarray], labels: np.ndarray, minor: np.ndarray | None, percent: int) -> np.ndarray:
    """New labels of the sets: equal for sets that links of this tile connect.

    Sets go by size, so a window bounds the partners (length filter); the suffix filter leaves out pairs whose
    cell counts differ by more than a link allows; pairs already connected are not compared again.
    With ``minor`` given, only pairs with a minor member are looked at.
    """
    order = np.argsort([len(members) for members in sets], kind="stable")
    sizes = np.array([len(sets[i]) for i in order], dtype=np.int64)
    owners = np.repeat(np.arange(len(order)), sizes)
    cells = cell_counts(owners, np.concatenate([sets[i] for i in order]), len(order), TILE_CELLS).astype(np.int32)
    _, labels_now = np.unique(labels[order], return_inverse=True)
    small = None if minor is None else minor[order]
    for i in range(len(order)):
        end = int(np.searchsorted(sizes, 100 * sizes[i] // percent, side="right"))
        others = np.arange(i + 1, end)
        others = others[labels_now[others] != labels_now[i]]
        if small is not None and not small[i]:
            others = others[small[others]]
        if not len(others):
            continue
        needed = least_overlap(sizes[i], sizes[others], percent)
        near = np.abs(cells[others] - cells[i]).sum(1) <= sizes[i] + sizes[others] - 2 * needed
        own = sets[order[i]]
        for j, least in zip(others[near].tolist(), needed[near].tolist()):
            if labels_now[j] == labels_now[i]:
                continue
            other = sets[order[j]]
            at = np.searchsorted(own, other)
            at[at == len(own)] = 0
            if int((own[at] == other).sum()) >= least:
                labels_now[labels_now == labels_now[j]] = labels_now[i]
    result = np.empty(len(order), dtype=np.int64)
    result[order] = labels_now
    return result


def _compare(rows: DataFrame, percent: int) -> DataFrame:
    """Rows (component, tile, set_key, label, minor, members) to edges (u, v) that connect what the tiles link."""

    def compare(group: pa.Table) -> pa.Table:
        keys = group.column("set_key").to_numpy()
        keys, first = np.unique(keys, return_index=True)
        group = group.take(pa.array(first))
        sets = [np.frombuffer(b, "<u8") for b in group.column("members").to_pylist()]
        before = group.column("label").to_numpy()
        minor = group.column("minor").to_numpy(zero_copy_only=False)
        after = compare_tile(sets, before, minor if minor.any() else None, percent)
        _, first, place = np.unique(after, return_index=True, return_inverse=True)
        leader = keys[first][place]
        return pa.table({"u": keys[keys != leader], "v": leader[keys != leader]})

    return rows.groupBy("component", "tile").applyInArrow(compare, "u long, v long")


def _with_sets(docs: DataFrame, members: DataFrame, size: int) -> DataFrame:
    """Add ``members`` (sorted 64-bit shingle hashes) to rows (id, set_key, ...) from the texts of the ids."""
    names = [name for name in members.columns if name != "id"]
    members = spool(members, "join-wanted")
    joined = maybe_among(docs, "id", members.select("id")).join(members, "id").select("text", *names)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column("text")):
                owners, hashes = shingle_sets(chunk, size)
                _, values, bounds = _distinct(owners, hashes, chunk.size)
                part = batch.slice(chunk.first, chunk.size).select(names)
                packed = [values[a:b].astype("<u8").tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
                same = part.column("set_key").to_numpy() == _set_keys(values, bounds)
                full = pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(packed, pa.binary())], names=[*names, "members"]
                )
                yield full.filter(pa.array(same))

    kept = ", ".join(f"{name} {kind}" for name, kind in members.select(*names).dtypes)
    return joined.mapInArrow(build, f"{kept}, members binary")


def _links(docs: DataFrame, described: DataFrame, candidates: DataFrame, size: int, percent: int) -> DataFrame:
    """Edges between set keys whose components are those of all links."""
    groups = connected_components(candidates)
    texts = described.groupBy("set_key").agg(F.min("id").alias("id"), F.first("n").alias("n"))
    members = spool(
        groups.select(F.col("node").alias("set_key"), "component").join(texts, "set_key"), "join-members"
    )
    totals = members.groupBy("component").agg(F.count("*").alias("sets"), F.sum("n").alias("shingles"))
    parts = F.greatest(F.ceil(F.col("sets") / TILE_SETS), F.ceil(F.col("shingles") / TILE_SHINGLES))
    wide = spool(totals.select("component", parts.alias("parts")).filter("parts > 1"), "join-wide")
    members = members.join(wide, "component", "left").select(
        "id",
        "set_key",
        "component",
        F.coalesce(F.pmod(F.xxhash64("set_key"), F.col("parts")), F.lit(0)).alias("tile"),
        F.col("set_key").alias("label"),
        F.lit(False).alias("minor"),
    )
    edges = spool(_compare(_with_sets(docs, members, size), percent), "join-links")
    if wide.isEmpty():
        return edges
    return _links_across(docs, members, wide, edges, size, percent)


def _links_across(
    docs: DataFrame, members: DataFrame, wide: DataFrame, edges: DataFrame, size: int, percent: int
) -> DataFrame:
    """Links between the tiles of groups that are too large for one.

    First the leaders of what the tiles connected are compared; then whoever is not in the largest part of the
    group (usually few) meets everybody else, tile by tile.
    """
    split = spool(members.join(wide, "component"), "join-split")

    def labelled(edges: DataFrame) -> DataFrame:
        found = spool(connected_components(edges).withColumnRenamed("component", "found"), "join-labels")
        named = split.join(found, F.col("set_key") == F.col("node"), "left")
        return named.select(
            "id", "set_key", "component", "tile", "parts", F.coalesce("found", "label").alias("label"), "minor"
        )

    named = labelled(edges)
    leaders = named.groupBy("component", "tile", "label").agg(F.min_by(F.struct("id", "set_key"), "set_key").alias("l"))
    count = leaders.groupBy("component").agg(F.ceil(F.count("*") / TILE_SETS).alias("parts"))
    leaders = leaders.join(count, "component").select(
        "l.id",
        "l.set_key",
        "component",
        F.pmod(F.xxhash64("label"), F.col("parts")).alias("tile"),
        "label",
        F.lit(False).alias("minor"),
    )
    edges = spool(edges.unionByName(_compare(_with_sets(docs, leaders, size), percent)), "join-links")
    named = spool(labelled(edges), "join-split")
    largest = named.groupBy("component", "label").agg(F.count("*").alias("rows"))
    largest = largest.groupBy("component").agg(F.max_by("label", F.struct("rows", "label")).alias("main"))
    marked = spool(
        named.join(spool(largest, "join-main"), "component").withColumn("minor", F.col("label") != F.col("main")),
        "join-split",
    )
    few = marked.filter("minor").groupBy("component").agg(F.ceil(F.count("*") / TILE_SETS).alias("minor_parts"))
    few = spool(few, "join-minor")
    if few.isEmpty():
        return edges
    small = F.pmod(F.xxhash64("set_key", F.lit(1)), F.col("minor_parts"))
    rows = marked.join(few, "component")
    everywhere = rows.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("minor_parts") - 1)))
    everywhere = everywhere.withColumn("tile", F.col("tile") * F.col("minor_parts") + F.col("at"))
    visiting = rows.filter("minor").withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    visiting = visiting.withColumn("tile", F.col("at") * F.col("minor_parts") + small)
    names = ["id", "set_key", "component", "tile", "label", "minor"]
    meeting = everywhere.withColumn("minor", F.lit(False)).select(*names).unionByName(visiting.select(*names))
    meeting = meeting.groupBy("id", "set_key", "component", "tile", "label").agg(F.max("minor").alias("minor"))
    return edges.unionByName(spool(_compare(_with_sets(docs, meeting, size), percent), "join-links"))


def ngram_join(
    docs: DataFrame,
    identity: str = "doc_id",
    text: str = "text",
    size: int = WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    Texts are linked when 100 times their common distinct ``size``-word shingles are at least ``percent`` times
    those of either; ``component_id`` is the smallest id that links lead to. Equal sets are one candidate, so
    copies cost one row per task each and no pairs. Shingles are ordered by frequency, counted over all texts
    in hash counters, and a set enters the join with its rarest ones only. Sets that may be linked are brought
    together once per group of candidates and compared there; a group above ``TILE_SETS`` sets is cut into
    tiles. Only texts of candidates are shuffled. No candidate is left out at any group size.

    Null and empty texts and texts of white space have no shingles and link with nothing. Rows without an id
    get their ``n_shingles`` and a null component. Rows may repeat; every row is answered, rows of one id by
    their own texts. An empty table gives an empty result; other columns are not looked at.
    """
    docs = docs.select(F.col(identity).cast("long").alias("id"), F.col(text).alias("text"))
    found = spool(_describe(docs, size), "join-sets")
    levels = _frequency_levels(found)
    described = found.filter("kind = 0").select("id", "set_key", "n", "counts")
    linkable = described.filter("id IS NOT NULL AND n > 0")
    with spool_scope(docs.sparkSession):  # what serves to find candidates goes again
        rows = spool(_prefixes(docs.filter("id IS NOT NULL"), levels, size, percent), "join-prefixes")
        hot = _hot_shingles(rows)
        # At most HOT_SHARE rows of two numbers.
        ordinary = rows.join(F.broadcast(hot.select("shingle")), "shingle", "left_anti")
        stars = rows.join(F.broadcast(hot), "shingle").select(F.col("set_key").alias("u"), F.col("first_key").alias("v"))
        cells = linkable.groupBy("set_key").agg(F.first("counts").alias("counts"))
        candidates = _candidate_pairs(ordinary, cells, percent).unionByName(stars)
        candidates = spool(candidates, "join-candidates", outlasts=True)
    edges = _links(docs, linkable, candidates, size, percent)
    groups = connected_components(edges)
    placed = spool(
        linkable.join(groups.withColumnRenamed("node", "set_key"), "set_key", "left").select(
            F.col("set_key"), "id", F.coalesce("component", "set_key").alias("group")
        ),
        "join-groups",
    )
    smallest = placed.groupBy("group").agg(F.min("id").alias("component_id"))
    named = placed.select("set_key", "group").distinct().join(smallest, "group").select("set_key", "component_id")
    named = spool(named, "join-components").withColumnRenamed("set_key", "named_key")
    linked = F.col("id").isNotNull() & (F.col("n") > 0)
    return described.join(named, F.when(linked, F.col("set_key")) == F.col("named_key"), "left").select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "id").alias("component_id"),
    )
