"""Dense ids 1..n in key order, without a one-task window over the keys."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from seqprep.sources.spool import spool

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def _place(
    keys: DataFrame, order: Sequence[str | Column], name: str, within: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Stored keys with the range partition and row they sort to, and where partitions start.

    The second table has one row per partition and ``within`` group in it, however many keys there
    are: ``shift`` turns a row number into one that runs through the whole group.
    """
    ranged = keys.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = spool(ranged.withColumn("place", F.monotonically_increasing_id()), name)
    placed = placed.withColumn("part", F.shiftright("place", _ROW_BITS)).withColumn(
        "row", F.col("place").bitwiseAND((1 << _ROW_BITS) - 1)
    )
    parts = placed.groupBy(*within, "part").agg(
        F.count("*").alias("keys"), F.min("row").alias("first")
    )
    earlier = Window.partitionBy(*within).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("keys").over(earlier), F.lit(0)) - F.col("first") + 1
    shifts = parts.select(*within, "part", "keys", shift.alias("shift"))
    return placed, spool(shifts, f"{name}-parts")


def _number(
    placed: DataFrame, parts: DataFrame, id_column: str, within: Sequence[str]
) -> DataFrame:
    shifts = F.broadcast(parts.drop("keys"))
    return placed.join(shifts, [*within, "part"]).withColumn(
        id_column, F.col("row") + F.col("shift")
    )


def dense_ids(
    keys: DataFrame,
    order: Sequence[str | Column],
    id_column: str,
    within: Sequence[str] = (),
) -> DataFrame:
    """Add ``id_column`` to a table of distinct keys: 1..n in the given total order.

    The keys are range partitioned and sorted in place, so the row number inside a partition plus
    the rows of all earlier partitions is the id. With ``within`` (leading columns of the order,
    without NULLs) the ids restart at 1 in every such group; these groups must be few, such as the
    regions that a caller lists.
    """
    placed, parts = _place(keys, order, id_column, within)
    return _number(placed, parts, id_column, within).select(*keys.columns, id_column)


@dataclass(frozen=True)
class DenseMaps:
    """Ids of the distinct values of several columns, made in one pass."""

    ids: DataFrame
    parts: DataFrame
    within: tuple[str, ...]
    columns: tuple[T.StructField, ...]

    def mapping(self, column: str, id_column: str) -> DataFrame:
        """``column`` to ``id_column``: 1..n in value order, per ``within`` group."""
        names = [field.name for field in self.columns]
        field = self.columns[names.index(column)]
        value = F.col(_slot(field)).cast(field.dataType).alias(column)
        own = self.ids.filter(F.col("kind") == names.index(column))
        return own.select(*self.within, value, F.col("id").alias(id_column))

    def sizes(self) -> dict[str, int]:
        """Entries per column; the driver gets one number for each."""
        rows = self.parts.groupBy("kind").agg(F.sum("keys").alias("entries")).collect()
        found = {row["kind"]: row["entries"] for row in rows}
        return {field.name: found.get(place, 0) for place, field in enumerate(self.columns)}


def _slot(field: T.StructField) -> str:
    return "number" if isinstance(field.dataType, T.IntegralType) else "text"


def dense_maps(df: DataFrame, columns: Sequence[str], within: Sequence[str] = ()) -> DenseMaps:
    """Number the distinct values of each column from 1, in numeric or text order.

    ``df`` is read once for all columns, and values are made distinct ahead of the shuffle.
    """
    fields = tuple(df.schema[name] for name in columns)
    entries = [
        F.struct(
            F.lit(kind).alias("kind"),
            (F.col(field.name) if _slot(field) == "number" else F.lit(None))
            .cast("bigint")
            .alias("number"),
            (F.col(field.name) if _slot(field) == "text" else F.lit(None))
            .cast("string")
            .alias("text"),
        )
        for kind, field in enumerate(fields)
    ]
    keys = df.select(*within, F.explode(F.array(*entries)).alias("entry"))
    keys = keys.select(*within, "entry.*").distinct()
    group = ["kind", *within]
    placed, parts = _place(keys, [*group, "number", "text"], "ids", group)
    return DenseMaps(_number(placed, parts, "id", group), parts, tuple(within), fields)
