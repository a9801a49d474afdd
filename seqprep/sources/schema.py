"""What a table lacks of the columns that a step reads."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


class MissingColumns(ValueError):
    """A table does not have all columns that a step reads."""


def lacking(df: DataFrame, wanted: Iterable[str]) -> list[str]:
    """Names in ``wanted``, in that order, that the schema does not have."""
    present = {field.name for field in df.schema.fields}
    return [name for name in wanted if name not in present]


def expect_columns(df: DataFrame, wanted: Iterable[str], table: str) -> None:
    """Raise unless the schema has all wanted columns; no data is read."""
    absent = lacking(df, wanted)
    if absent:
        raise MissingColumns(f"{table}: no column {', '.join(absent)}; found {', '.join(df.columns)}")
