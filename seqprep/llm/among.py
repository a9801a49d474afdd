"""Rows whose key may be among the keys of another table, found without a shuffle of the rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from seqprep.llm.text import mix

BLOCKS = 64  # a task sets the bits of a block
BITS_A_KEY = 16
MOST_BITS = 1 << 26  # 8 MB; with more keys than fit, more other rows are found too, and no row of a key less
PART_BYTES = 1 << 20  # of rows that a task looks at and gives back at a time

_U64 = np.uint64


def _places(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Block and two bit positions within it of every key."""
    spread = mix(keys.astype(np.int64).view(np.uint64) ^ _U64(0x6A09E667F3BCC909))
    inside = _U64(bits // BLOCKS - 1)
    return (spread >> _U64(58)).astype(np.int64), spread & inside, (spread >> _U64(29)) & inside


def _filter_bits(keys: DataFrame) -> np.ndarray:
    """A Bloom filter of the one column ``keys`` (long), one row of bytes per block."""
    bits = 1 << 20
    wanted = min(BITS_A_KEY * keys.count(), MOST_BITS)
    while bits < wanted:
        bits *= 2

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column(0).drop_null()
            block, _, _ = _places(held.to_numpy(), bits)
            yield pa.RecordBatch.from_arrays([pa.array(block.astype(np.int32)), held], names=["block", "key"])

    def fill(group: pa.Table) -> pa.Table:
        _, one, two = _places(group.column("key").to_numpy(), bits)
        marks = np.zeros(bits // BLOCKS, dtype=bool)
        marks[one] = marks[two] = True
        return pa.table({"block": group.column("block").slice(0, 1), "bits": pa.array([np.packbits(marks).tobytes()], pa.binary())})

    found = keys.mapInArrow(deal, "block int, key long").groupBy("block").applyInArrow(fill, "block int, bits binary")
    filled = np.zeros((BLOCKS, bits // BLOCKS // 8), dtype=np.uint8)
    for row in found.toArrow().to_pylist():  # MOST_BITS in all
        filled[row["block"]] = np.frombuffer(row["bits"], np.uint8)
    return filled


def maybe_among(rows: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """``rows`` whose ``column`` (long) may be one of ``keys`` (one column, long).

    Every row of a key is found, and a few others: an exact join has to follow. Tasks ask a Bloom filter of at
    most ``MOST_BITS`` bits. A null is no key. ``keys`` is read twice and should be stored.
    """
    sent, part_bytes = rows.sparkSession.sparkContext.broadcast(_filter_bits(keys)), PART_BYTES

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        bits = known.size * 8
        for batch in batches:
            values = batch.column(column)
            block, one, two = _places(values.fill_null(0).to_numpy(), bits)
            found = np.asarray(values.is_valid())
            for place in (one, two):
                byte = known[block, (place >> _U64(3)).astype(np.int64)]
                found = found & ((byte >> (_U64(7) - (place & _U64(7))).astype(np.uint8)) & 1).astype(bool)
            step = max(1, batch.num_rows * part_bytes // max(batch.nbytes, 1))
            for start in range(0, batch.num_rows, step):
                yield batch.slice(start, step).filter(pa.array(found[start : start + step]))

    return rows.mapInArrow(look, ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes))
