"""Joins and per-group ordering that hold when one key owns a large share of the rows.

Groups above a row limit are told apart by a count that is aggregated before it is shuffled. The
others take the plain one-exchange plan. Oversized groups are cut into ordered blocks of bounded
size, worked on block by block, and stitched together from one summary row per block.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F, types as T

from seqprep.sources.spool import spool, spool_counted
from seqprep.sources.tables import counted

# A group may be handled inside one task up to this many rows.
GROUP_ROWS = 1_000_000
# Oversized groups are cut into blocks of the group limit; where that makes more than so many blocks, no
# block gets fewer rows than this, so that a small limit does not make a task of every few rows.
FEW_BLOCKS = 64
BLOCK_ROWS = 250_000
# A join side is broadcast only after its row count was found to be within this.
BROADCAST_ROWS = 100_000
# ... and, for a table of unknown row width, its size as text within this.
BROADCAST_BYTES = 64 * 1024 * 1024
FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
# Copies of one row that one task writes out in a go.
COPY_STEP = 65_536


def _parallelism(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` is within the row limit and, counted as text, within the byte limit."""
    if df.count() > rows:
        return False
    return _text_bytes(df) <= BROADCAST_BYTES


def _text_bytes(df: DataFrame) -> int:
    width = F.octet_length(F.to_json(F.struct(*df.columns)))
    return df.agg(F.sum(width).alias("width")).first()["width"] or 0


def _fits(side: DataFrame, side_rows: int | None, broadcast_rows: int) -> bool:
    """Whether a join side may be broadcast; rows that the caller counted are not counted again."""
    if side_rows is None:
        return is_small(side, broadcast_rows)
    if side_rows > broadcast_rows:
        return False
    fixed = all(isinstance(field.dataType, FIXED_WIDTH) for field in side.schema.fields)
    return fixed or _text_bytes(side) <= BROADCAST_BYTES


def _heavy(counts: DataFrame, name: str, group_rows: int) -> tuple[DataFrame, int, int]:
    """Rows of ``counts`` (keys and ``rows``) above a limit, their number, and the sum of all ``rows``.

    The limit is ``group_rows``, or the share of all rows that at most ``BROADCAST_ROWS`` keys can have: so
    the result may be broadcast however many keys there are, and no key below it holds more than that share.
    """
    counts, seen = counted(counts, all_rows=F.sum("rows"))
    heavy, found = spool_counted(counts.filter(F.col("rows") > group_rows), name)
    all_rows = seen.get.get("all_rows") or 0
    if found > BROADCAST_ROWS:
        heavy = heavy.filter(F.col("rows") > all_rows // BROADCAST_ROWS)
    return heavy, found, all_rows


def _block_count(df: DataFrame, rows: int, group_rows: int) -> int:
    """Blocks for ``rows`` rows of oversized groups: each is a task and a file, and a share of the range sample."""
    enough = max(FEW_BLOCKS, -(-rows // BLOCK_ROWS))
    return max(_parallelism(df), min(-(-rows // group_rows), enough))


@dataclass(frozen=True)
class HotGroups:
    """All rows of the groups above a row limit, and how many blocks they should be cut into."""

    rows: DataFrame
    blocks: int


@dataclass(frozen=True)
class Split:
    """Rows of ordinary groups, those of oversized groups if any, and about how many in all."""

    cold: DataFrame
    hot: HotGroups | None
    rows: int


def split_hot_groups(
    df: DataFrame, group: Sequence[str], group_rows: int = GROUP_ROWS, keyed_like: DataFrame | None = None
) -> Split:
    """Tell groups with more than ``group_rows`` rows from the others.

    ``keyed_like`` may be a cheaper table with the same group columns, row for row; ``df`` is then computed
    once, and stored if it has to be read for both parts.
    """
    group = list(group)
    counts = (df if keyed_like is None else keyed_like).groupBy(*group).agg(F.count("*").alias("rows"))
    hot, found, all_rows = _heavy(counts, "hot-groups", group_rows)
    if found == 0:
        return Split(df, None, all_rows)
    total = hot.agg(F.sum("rows").alias("rows")).first()["rows"]
    if total is None:  # more groups are above the limit than may be broadcast, and none holds much
        return Split(df, None, all_rows)
    if keyed_like is not None:
        df = spool(df, "hot-input")
    blocks = _block_count(df, total, group_rows)
    keys = F.broadcast(hot.select(*group))
    cold = df.join(keys, group, "left_anti")
    return Split(cold, HotGroups(df.join(keys, group, "left_semi"), blocks), all_rows)


def ordered_blocks(
    df: DataFrame, group: Sequence[str], order: Sequence[str], blocks: int, name: str
) -> DataFrame:
    """Number contiguous blocks (``block``) of the (group, order) sequence and store the rows.

    (group, order) should identify a row, so that range boundaries can fall anywhere.
    """
    ranged = df.repartitionByRange(blocks, *group, *order)
    return spool(ranged.withColumn("block", F.spark_partition_id()), name)


def _block_offsets(blocks: DataFrame, group: Sequence[str]) -> DataFrame:
    """Rows before each block of a group, and rows of the whole group; one row per block."""
    sizes = blocks.groupBy(*group, "block").agg(F.sum("copies").alias("block_rows"))
    before = Window.partitionBy(*group).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(
        *group,
        "block",
        F.coalesce(F.sum("block_rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("block_rows").over(Window.partitionBy(*group)).alias("group_size"),
    )


def number_within_groups(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    group_rows: int = GROUP_ROWS,
    keyed_like: DataFrame | None = None,
) -> DataFrame:
    """Add ``position`` (1..n in ``order``, then by all other columns) and ``group_size``."""
    group = list(group)
    order = [*order, *(name for name in df.columns if name not in {*group, *order})]
    split = split_hot_groups(df, group, group_rows, keyed_like)
    ordered = Window.partitionBy(*group).orderBy(*order)
    numbered = split.cold.withColumn("position", F.row_number().over(ordered).cast("bigint")).withColumn(
        "group_size", F.count("*").over(Window.partitionBy(*group))
    )
    if split.hot is None:
        return numbered
    return numbered.unionByName(_number_hot(split.hot, group, order).select(numbered.columns))


def _number_hot(hot: HotGroups, group: list[str], order: list[str]) -> DataFrame:
    """Positions in oversized groups: equal rows are counted, placed by block, and repeated."""
    counted = hot.rows.groupBy(*group, *order).agg(F.count("*").alias("copies"))
    blocks = ordered_blocks(counted, group, order, hot.blocks, "position-blocks")
    earlier = Window.partitionBy(*group, "block").orderBy(*order)
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        blocks.withColumn("before", F.coalesce(F.sum("copies").over(earlier), F.lit(0)))
        .join(_block_offsets(blocks, group), [*group, "block"])
        .withColumn("before", F.col("rows_before") + F.col("before"))
    )
    # Repeat in two steps with a shuffle between, so that one row's copies spread over tasks.
    last = F.col("copies") - 1
    steps = placed.withColumn("step", F.explode(F.sequence(F.lit(0), last, F.lit(COPY_STEP))))
    spread = steps.repartition(hot.blocks, *group, *order, "step")
    step_end = F.least(last, F.col("step") + (COPY_STEP - 1))
    return spread.withColumn("copy", F.explode(F.sequence("step", step_end))).withColumn(
        "position", F.col("before") + F.col("copy") + 1
    )


def join_sized(
    big: DataFrame,
    side: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    broadcast_rows: int = BROADCAST_ROWS,
    side_rows: int | None = None,
) -> DataFrame:
    """Join whose keys are known to repeat little; ``side`` is broadcast if counted as small."""
    small = _fits(side, side_rows, broadcast_rows)
    return big.join(F.broadcast(side) if small else side, list(keys), how)


def join_skewed(
    big: DataFrame,
    side: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    broadcast_rows: int = BROADCAST_ROWS,
    group_rows: int = GROUP_ROWS,
    side_rows: int | None = None,
    keyed_like: DataFrame | None = None,
) -> DataFrame:
    """Join where one key of ``big`` may hold much of it; ``side`` has one row per key.

    A side counted as small (``side_rows``, if the caller knows) is broadcast. Otherwise the heavy keys of
    ``big`` are spread over enough salts for ``group_rows`` rows each, and their rows in ``side`` are repeated
    per salt. Rows with a NULL key, which a left join keeps, are spread over all tasks. ``keyed_like`` may name
    a stored table with about the same keys, to count them there when ``big`` is costly to compute twice.
    """
    keys = list(keys)
    if _fits(side, side_rows, broadcast_rows):
        return big.join(F.broadcast(side), keys, how)
    counts = (
        (big if keyed_like is None else keyed_like)
        .dropna(subset=keys)
        .groupBy(*keys)
        .agg(F.count("*").alias("rows"))
    )
    heavy, found, _ = _heavy(counts, "heavy-keys", group_rows)
    keeps_nulls = how.lower().replace("_", "").startswith("left") and how != "left_semi"
    if found == 0 and not keeps_nulls:
        return big.join(side, keys, how)
    hot = F.broadcast(heavy.select(*keys, F.ceil(F.col("rows") / group_rows).cast("int").alias("salts")))
    # Content plus partition number: stable when a task is run again, and copies of one row that
    # lie in different partitions still get different salts.
    spread = F.xxhash64(*big.columns, F.spark_partition_id())
    no_key = reduce(lambda one, two: one | two, [F.col(name).isNull() for name in keys])
    salt = F.when(no_key, F.pmod(spread, F.lit(_parallelism(big)))).otherwise(F.pmod(spread, F.col("salts")))
    salted = (
        big.join(hot, keys, "left").withColumn("salt", F.coalesce(salt.cast("int"), F.lit(0))).drop("salts")
    )
    repeated = (
        side.join(hot, keys, "left")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)))
        .drop("salts")
    )
    return salted.join(repeated, [*keys, "salt"], how).drop("salt")
