"""Events to sessions: run collapse, length limits, item support, dense ids.

A session is named by one or more key columns. ``kind`` is the event type.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from seqprep import contract
from seqprep.operators.dense_ids import dense_maps
from seqprep.operators.skew import (
    BROADCAST_ROWS,
    GROUP_ROWS,
    HotGroups,
    Split,
    join_sized,
    join_skewed,
    number_within_groups,
    ordered_blocks,
    split_hot_groups,
)
from seqprep.sources.spool import spool, spool_counted

RUN_COLUMNS = ("item_id", "event_type", "timestamp", "intensity", "run_seq")


def session_events(enriched: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Rows with session, item and time: the input of the run collapse."""
    return enriched.select(
        *within,
        F.col("anonymized_session_id").alias("user_id"),
        F.col("canonical_listing_id").alias("item_id"),
        "event_type",
        F.unix_timestamp("event_ts").alias("timestamp"),
        "event_ms",
    ).dropna(subset=["user_id", "item_id", "timestamp"])


def _new_run(ordered) -> Column:
    """First row of a session (or block), or item or type differs from the row before; no type is no change."""
    before = F.lag("item_id").over(ordered)
    kind_changed = F.col("event_type") != F.lag("event_type").over(ordered)
    return (
        before.isNull()
        | (F.col("item_id") != before)
        | F.coalesce(kind_changed, F.lit(False))
    )


def _first_type(order: Column) -> Column:
    """The first type that is given, in order."""
    return F.min_by("event_type", F.when(F.col("event_type").isNotNull(), order)).alias("event_type")


def _collapse(events: DataFrame, session: list[str], order: list[str]) -> DataFrame:
    """Runs of sessions that fit one task: one shuffle for everything."""
    ordered = Window.partitionBy(*session).orderBy(*order)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        events.withColumn("new_run", _new_run(ordered).cast("bigint"))
        .withColumn("run_seq", F.sum("new_run").over(so_far))
        .withColumn("row", F.row_number().over(ordered))
        .groupBy(*session, "run_seq")
        .agg(
            F.min("item_id").alias("item_id"),
            _first_type(F.col("row")),
            F.min("timestamp").alias("timestamp"),
            F.count("*").alias("intensity"),
        )
        .select(*session, *RUN_COLUMNS)
    )


def _collapse_hot(hot: HotGroups, session: list[str], order: list[str]) -> DataFrame:
    """Runs of oversized sessions, block by block, stitched at the block edges."""
    # Rows that agree in everything that is kept are neighbours of one run: count them first.
    row = list(dict.fromkeys([*session, *order, "item_id", "event_type", "timestamp"]))
    weighted = hot.rows.groupBy(*row).agg(F.count("*").alias("weight"))
    blocks = ordered_blocks(weighted, session, order, hot.blocks, "session-blocks")

    ordered = Window.partitionBy(*session, "block").orderBy(*order)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = (
        blocks.withColumn("new_run", _new_run(ordered).cast("bigint"))
        .withColumn("local_run", F.sum("new_run").over(so_far))
        .withColumn("row", F.row_number().over(ordered))
    )
    pieces = numbered.groupBy(*session, "block", "local_run").agg(
        F.min("item_id").alias("item_id"),
        _first_type(F.col("row")),
        F.min("timestamp").alias("timestamp"),
        F.sum("weight").alias("weight"),
    )

    # One summary row per block: its first and last row, and how many runs it holds.
    edge = F.struct("item_id", "event_type")
    summary = numbered.groupBy(*session, "block").agg(
        F.min_by(edge, "row").alias("head"),
        F.max_by(edge, "row").alias("tail"),
        F.max("local_run").alias("runs"),
    )
    by_block = Window.partitionBy(*session).orderBy("block")
    before = F.lag("tail").over(by_block)
    changed = F.coalesce(F.col("head.event_type") != before["event_type"], F.lit(False))
    joined_runs = F.coalesce(F.col("head.item_id") == before["item_id"], F.lit(False)) & ~changed
    carried = summary.withColumn("continues", joined_runs.cast("int")).select(
        *session,
        "block",
        "continues",
        F.coalesce(
            F.sum(F.col("runs") - F.col("continues")).over(
                by_block.rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ).alias("runs_before"),
    )
    return (
        pieces.join(carried, [*session, "block"])
        .withColumn(
            "run_seq",
            (F.col("runs_before") + F.col("local_run") - F.col("continues")).cast("bigint"),
        )
        .groupBy(*session, "run_seq")
        .agg(
            F.min("item_id").alias("item_id"),
            _first_type(F.struct("block", "local_run")),
            F.min("timestamp").alias("timestamp"),
            F.sum("weight").alias("intensity"),
        )
        .select(*session, *RUN_COLUMNS)
    )


def _run_order(order: Sequence[str]) -> list[str]:
    """A total order up to rows that are alike, whatever the caller's order leaves open."""
    return list(dict.fromkeys([*order, "item_id", "event_type"]))


def collapse_runs(
    events: DataFrame,
    session: Sequence[str] = ("user_id",),
    order: Sequence[str] = ("event_ms",),
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Collapse consecutive events with the same item and type into one row.

    Input: the session columns, ``item_id``, ``event_type``, ``timestamp`` and the order columns.
    The run keeps its least timestamp and the first type given; ``intensity`` counts its events and
    ``run_seq`` numbers the runs of a session from 1. A missing type does not end a run. Equal order values
    are settled by item and type.
    """
    session, order = list(session), _run_order(order)
    split = split_hot_groups(events, session, group_rows)
    runs = _collapse(split.cold, session, order)
    if split.hot is None:
        return runs
    return runs.unionByName(_collapse_hot(split.hot, session, order))


def _keep_lengths(runs: DataFrame, session: list[str], low: int, high: int) -> DataFrame:
    """Length limits for sessions that fit one task and whose ``run_seq`` is 1..n."""
    return (
        runs.withColumn("length", F.count("*").over(Window.partitionBy(*session)))
        .filter((F.col("length") >= low) & (F.col("run_seq") > F.col("length") - high))
        .drop("length")
    )


def filter_sessions_by_length(
    runs: DataFrame,
    min_length: int = contract.MIN_SESSION_LENGTH,
    max_length: int = contract.MAX_SESSION_LENGTH,
    session: Sequence[str] = ("user_id",),
    order: Sequence[str] = ("timestamp", "run_seq"),
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Drop sessions under ``min_length``; keep the last ``max_length`` rows of the others."""
    check_lengths(min_length, max_length)
    session = list(session)
    # Rows that the order leaves open are settled by all other columns, on both ways below.
    order = [*order, *(name for name in runs.columns if name not in {*session, *order})]
    group_limit = int(runs.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if max_length < group_limit:
        # Each task drops all but its last rows per session ahead of the shuffle, so no session
        # reaches a task whole. Counting after the cut is enough because max >= min.
        recent = Window.partitionBy(*session).orderBy(*(F.desc(name) for name in order))
        return (
            runs.withColumn("recent", F.row_number().over(recent))
            .filter(F.col("recent") <= max_length)
            .withColumn("length", F.count("*").over(Window.partitionBy(*session)))
            .filter(F.col("length") >= min_length)
            .drop("recent", "length")
        )
    # Sessions are counted, then cut and numbered: the runs are computed once for all of that.
    numbered = number_within_groups(spool(runs, "runs-by-length"), session, order, group_rows)
    return numbered.filter(
        (F.col("group_size") >= min_length)
        & (F.col("position") > F.col("group_size") - max_length)
    ).select(runs.columns)


def item_support(runs: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Collapsed interactions per item."""
    return runs.groupBy(*within, "item_id").agg(F.count("*").alias("support"))


def filter_rare_items(
    runs: DataFrame,
    min_support: int = contract.MIN_ITEM_FREQ,
    within: Sequence[str] = (),
    broadcast_rows: int = BROADCAST_ROWS,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Drop items with fewer than ``min_support`` rows; ``runs`` is read twice."""
    keys = [*within, "item_id"]
    support = item_support(runs, within).filter(F.col("support") >= min_support)
    frequent, rows = spool_counted(support.select(*keys), "frequent-items")
    return join_skewed(runs, frequent, keys, "left_semi", broadcast_rows, group_rows, rows)


def add_session_ids(
    runs: DataFrame,
    session: Sequence[str] = ("user_id",),
    within: Sequence[str] = (),
    broadcast_rows: int = BROADCAST_ROWS,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Add ``session_id_numeric`` and ``item_id_numeric``, dense in key order.

    The session columns are ``within`` (such as the region) plus one; ids restart in every
    ``within`` group. ``runs`` should be a stored table whose sessions are within a length limit.
    """
    *outer, key = session
    if outer != list(within):
        raise ValueError("session must be the within columns and one key column")
    maps = dense_maps(runs, [key, "item_id"], within)
    sizes = maps.sizes()
    session_ids = maps.mapping(key, "session_id_numeric")
    item_ids = maps.mapping("item_id", "item_id_numeric")
    # Sessions are short after the length limits; an item may hold much of the table.
    with_sessions = join_sized(
        runs, session_ids, session, "inner", broadcast_rows, sizes[key]
    )
    return join_skewed(
        with_sessions,
        item_ids,
        [*within, "item_id"],
        "inner",
        broadcast_rows,
        group_rows,
        sizes["item_id"],
        keyed_like=runs,
    )


def check_lengths(min_length: int, max_length: int) -> None:
    if min_length < 2:
        raise ValueError("min session length must be at least 2")
    if max_length < min_length:
        raise ValueError("max session length must be at least the min session length")


def session_runs(
    events: DataFrame,
    min_length: int = contract.MIN_SESSION_LENGTH,
    max_length: int = contract.MAX_SESSION_LENGTH,
    session: Sequence[str] = ("user_id",),
    order: Sequence[str] = ("event_ms",),
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Run collapse and the first length limit, fused: ordinary sessions shuffle once."""
    check_lengths(min_length, max_length)
    split = split_hot_groups(events, session, group_rows)
    return _limited_runs(split, min_length, max_length, list(session), order, group_rows)


def _limited_runs(
    split: Split,
    min_length: int,
    max_length: int,
    session: list[str],
    order: Sequence[str],
    group_rows: int,
) -> DataFrame:
    order = _run_order(order)
    runs = _keep_lengths(_collapse(split.cold, session, order), session, min_length, max_length)
    if split.hot is None:
        return runs
    hot_runs = filter_sessions_by_length(
        _collapse_hot(split.hot, session, order),
        min_length,
        max_length,
        session,
        ("run_seq",),
        group_rows,
    )
    return runs.unionByName(hot_runs)


def build_sessions(
    events: DataFrame,
    min_length: int = contract.MIN_SESSION_LENGTH,
    max_length: int = contract.MAX_SESSION_LENGTH,
    min_item_freq: int = contract.MIN_ITEM_FREQ,
    session: Sequence[str] = ("user_id",),
    within: Sequence[str] = (),
    order: Sequence[str] = ("event_ms",),
    broadcast_rows: int = BROADCAST_ROWS,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Collapse, length, item support, length once more, ids.

    Runs that become neighbours through the support filter stay apart, and support is not checked
    again after the last step. Both filtered tables are stored once, because each is read several
    times.
    """
    if min_item_freq <= 0:
        raise ValueError("min item frequency must be positive")
    check_lengths(min_length, max_length)
    session = list(session)
    split = split_hot_groups(events, session, group_rows)
    limited = _limited_runs(split, min_length, max_length, session, order, group_rows)
    runs = spool(limited, "session-runs")
    frequent = filter_rare_items(runs, min_item_freq, within, broadcast_rows, group_rows)
    # Sessions are within max_length by now, so only the minimum can still drop rows.
    lengths = F.count("*").over(Window.partitionBy(*session))
    kept = frequent.withColumn("length", lengths).filter(F.col("length") >= min_length)
    kept = spool(kept.drop("length"), "sessions")
    return add_session_ids(kept, session, within, broadcast_rows, group_rows)


def model_events(sessions: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """The session event table: ids, item, type, time, intensity and the position to order by."""
    return sessions.select(
        *within,
        F.col("session_id_numeric").alias("uid"),
        F.col("item_id_numeric").alias("sid"),
        F.col("item_id").alias("canonical_listing_id"),
        "event_type",
        "timestamp",
        "intensity",
        F.col("run_seq").alias("pos"),
    )
