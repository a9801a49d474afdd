"""Fingerprints of tables as states that add up, so that they are taken while rows are written.

A state holds the number of rows and order-free digests of their hashes. The states of two loads merge into
that of both, whatever the order or layout of rows. Columns enter by name; names, types and NULLs count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, functions as F, types as T

_MARKS = 60  # NULL marks that one long holds
_SUM_BITS = 24  # of a hash that one sum adds up: 64 bits hold the sum over 2**39 rows


def _seed(fields: Sequence[T.StructField]) -> int:
    """Names and types of all columns, once per table instead of once per row."""
    text = "\n".join(f"{field.name}\t{field.dataType.simpleString()}" for field in fields)
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "big", signed=True)


def row_hash(df: DataFrame) -> Column:
    """A 64-bit hash of a row: schema, which columns are NULL, and the values in order of their names."""
    fields = sorted(df.schema.fields, key=lambda field: field.name)
    columns = [F.col(f"`{field.name}`") for field in fields]
    marks = []
    for start in range(0, len(columns), _MARKS):
        mark = F.lit(0).cast("bigint")
        for place, column in enumerate(columns[start : start + _MARKS]):
            mark = mark + F.when(column.isNull(), F.lit(1 << place).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
        marks.append(mark)
    values = [F.to_json(c) if isinstance(f.dataType, T.MapType) else c for f, c in zip(fields, columns)]
    return F.xxhash64(F.lit(_seed(fields)).cast("bigint"), *marks, *values)


def digests(row: Column) -> dict[str, Column]:
    """The aggregates of a state over a row hash."""
    part = F.lit((1 << _SUM_BITS) - 1).cast("bigint")
    none = F.lit(0).cast("bigint")
    return {
        "rows": F.count(F.lit(1)),
        "hash_xor": F.coalesce(F.bit_xor(row), none),
        "low_sum": F.coalesce(F.sum(row.bitwiseAND(part)), none),
        "high_sum": F.coalesce(F.sum(F.shiftrightunsigned(row, 64 - _SUM_BITS)), none),
    }


def merged_digests() -> dict[str, Column]:
    """The aggregates that merge a table of states into one."""
    return {
        "rows": F.sum("rows"),
        "hash_xor": F.bit_xor("hash_xor"),
        "low_sum": F.sum("low_sum"),
        "high_sum": F.sum("high_sum"),
    }


STATE = ("rows", "hash_xor", "low_sum", "high_sum")


@dataclass(frozen=True)
class TableState:
    rows: int = 0
    hash_xor: int = 0
    low_sum: int = 0
    high_sum: int = 0

    def __add__(self, other: TableState) -> TableState:
        return TableState(
            self.rows + other.rows,
            self.hash_xor ^ other.hash_xor,
            self.low_sum + other.low_sum,
            self.high_sum + other.high_sum,
        )

    @property
    def text(self) -> str:
        return "-".join(str(part) for part in (self.rows, self.hash_xor % (1 << 64), self.low_sum, self.high_sum))


def state_of(found: Observation | Row) -> TableState:
    values = found.get if isinstance(found, Observation) else found.asDict()
    return TableState(*(values[name] or 0 for name in STATE)) if values else TableState()


def observed(df: DataFrame, **more: Column) -> tuple[DataFrame, Observation]:
    """The same rows, whose state (and more) is taken when they are next written or collected.

    Write the frame as it is: only a job's last stage counts every task once when tasks are repeated.
    """
    seen = Observation()
    metrics = digests(row_hash(df)) | more
    return df.observe(seen, *(column.alias(name) for name, column in metrics.items())), seen


def scan(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """States of a table that nobody observed, by the given columns; reads it once."""
    hashed = df.select(*by, row_hash(df).alias("hash"))
    return hashed.groupBy(*by).agg(*(column.alias(name) for name, column in digests(F.col("hash")).items()))


def scanned_state(df: DataFrame) -> TableState:
    return state_of(scan(df).first())


def file_state(spark: SparkSession, path: str) -> str:
    """Number of a table's files and a digest of their names and lengths; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    each = F.xxhash64(F.substring_index("path", "/", -1), "length")
    row = files.agg(F.count("*").alias("files"), F.bit_xor(each).alias("digest")).first()
    return f"{row['files']}-{(row['digest'] or 0) % (1 << 64)}"


def portable(df: DataFrame) -> DataFrame:
    """``rows``, ``hash_xor`` and ``hash_sum`` from MD5 over text, for comparison with other engines.

    Slow: use it where the other side has to compute the same number. A row enters by the names, types and
    lengths and texts of its values, with a mark for NULL.
    """
    parts = []
    for field in sorted(df.schema.fields, key=lambda field: field.name):
        text = F.col(f"`{field.name}`").cast("string")
        value = F.concat_ws(":", F.char_length(text).cast("string"), text)
        head = f"{field.name}:{field.dataType.simpleString()}:"
        parts.append(F.concat(F.lit(head), F.when(text.isNull(), F.lit("-")).otherwise(value), F.lit(";")))
    digest = F.md5(F.concat(*parts))
    return df.select(
        F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint").alias("head"),
        F.conv(F.substring(digest, 18, 15), 16, 10).cast("decimal(20,0)").alias("tail"),
    ).agg(
        F.count("*").alias("rows"),
        F.coalesce(F.bit_xor("head"), F.lit(0).cast("bigint")).alias("hash_xor"),
        F.coalesce(F.sum("tail"), F.lit(0)).cast("string").alias("hash_sum"),
    )
