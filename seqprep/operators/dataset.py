"""Session events to model sequences: catalogue attributes, dense maps, target holdout."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from seqprep import contract
from seqprep.functions.cleaning import coordinate_or_zero, market_segment
from seqprep.functions.encoding import code_of
from seqprep.operators.dense_ids import DenseMaps, dense_maps
from seqprep.operators.skew import (
    BROADCAST_ROWS,
    GROUP_ROWS,
    join_skewed,
    number_within_groups,
)
from seqprep.sources.schema import expect_columns
from seqprep.sources.spool import spool

# Sequences longer than this are stored in several rows, numbered by ``chunk``.
CHUNK_ROWS = 4096

# Row column -> array column of the sequence table.
SEQUENCE_ARRAYS = {
    "sid": "items",
    "behavior": "behaviors",
    "intensity": "intensity",
    "market_segment": "segments",
    "latitude": "latitudes",
    "longitude": "longitudes",
}


# Mapped row column -> id column of its map table.
MAPPED_COLUMNS = {"uid": "user", "sid": "dense_id", "market_segment": "segment_id"}


@dataclass(frozen=True)
class Dataset:
    """The tables of one model dataset."""

    rows: DataFrame
    sequences: DataFrame
    umap: DataFrame
    smap: DataFrame
    bmap: DataFrame
    segmap: DataFrame


def item_attributes(items: DataFrame) -> DataFrame:
    """Segment and coordinates per canonical id; ids must be unique (see ``checks``)."""
    expect_columns(items, contract.MODEL_ITEM_COLUMNS, "items")
    return items.select(
        "canonical_listing_id",
        coordinate_or_zero(F.col("lat_region")).alias("latitude"),
        coordinate_or_zero(F.col("lon_region")).alias("longitude"),
        market_segment(F.col("business_type"), F.col("usage_type")).alias("market_segment"),
    )


def model_frame(
    events: DataFrame,
    items: DataFrame,
    broadcast_rows: int = BROADCAST_ROWS,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Events with the attributes of their item; an uncatalogued item gets 0.0, 0.0, OTHER."""
    expect_columns(events, contract.SESSION_EVENT_COLUMNS, "events")
    joined = join_skewed(
        events.withColumnRenamed("event_type", "behavior"),
        item_attributes(items),
        ["canonical_listing_id"],
        "left",
        broadcast_rows,
        group_rows,
        side_rows=items.count(),
    )
    position = ["pos"] if "pos" in events.columns else []
    return joined.select(
        "uid",
        "sid",
        "behavior",
        "timestamp",
        *position,
        "intensity",
        F.coalesce("market_segment", F.lit("OTHER")).alias("market_segment"),
        F.coalesce("latitude", F.lit(0.0)).alias("latitude"),
        F.coalesce("longitude", F.lit(0.0)).alias("longitude"),
    )


def _session_order(frame: DataFrame) -> list[str]:
    """Time, then the stored position, then content, so that no order depends on file layout."""
    rest = ["sid", "behavior", "intensity"]
    return ["timestamp", *(["pos"] if "pos" in frame.columns else []), *rest]


def keep_active_users(
    frame: DataFrame,
    min_user_events: int = contract.MIN_USER_EVENTS,
    group_rows: int = GROUP_ROWS,
    keyed_like: DataFrame | None = None,
) -> DataFrame:
    """Users with enough rows; adds ``position`` (1..n) and ``group_size``.

    ``keyed_like`` may be the table that ``frame`` was joined from, to count users there.
    """
    if min_user_events < 2:
        raise ValueError("min user events must be at least 2")
    numbered = number_within_groups(frame, ["uid"], _session_order(frame), group_rows, keyed_like)
    return numbered.filter(F.col("group_size") >= min_user_events)


def id_maps(kept: DataFrame) -> DenseMaps:
    """Sorted distinct users, items and segments to 1..n."""
    return dense_maps(kept, list(MAPPED_COLUMNS))


def behavior_map(
    kept: DataFrame, codes: Mapping[str, int] = contract.BEHAVIOR_IDS
) -> DataFrame:
    """Fixed ids of the behaviours that occur; an unknown one has a NULL id."""
    return kept.select("behavior").distinct().withColumn("id", code_of(F.col("behavior"), codes))


def densify(
    kept: DataFrame,
    maps: DenseMaps,
    codes: Mapping[str, int] = contract.BEHAVIOR_IDS,
    broadcast_rows: int = BROADCAST_ROWS,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Replace uid, sid, behaviour and segment of the stored rows by their dense ids."""
    sizes = maps.sizes()
    frame = kept.withColumn("behavior", code_of(F.col("behavior"), codes))
    for column, id_column in MAPPED_COLUMNS.items():
        joined = join_skewed(
            frame,
            _int_map(maps, column),
            [column],
            broadcast_rows=broadcast_rows,
            group_rows=group_rows,
            side_rows=sizes[column],
            keyed_like=kept,
        )
        frame = joined.drop(column).withColumnRenamed(id_column, column)
    return frame.select(kept.columns)


def _int_map(maps: DenseMaps, column: str) -> DataFrame:
    id_column = MAPPED_COLUMNS[column]
    return maps.mapping(column, id_column).withColumn(id_column, F.col(id_column).cast("int"))


def split_holdout(dense: DataFrame, target_id: int) -> DataFrame:
    """``split`` is val for a user's last row if that is the target, otherwise train."""
    is_holdout = (F.col("position") == F.col("group_size")) & (F.col("behavior") == target_id)
    return dense.withColumn("split", F.when(is_holdout, "val").otherwise("train"))


def sequences(rows: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """One row per user, split and chunk with parallel arrays in session order.

    Chunks of a split count from 0. A sequence of up to ``chunk_rows`` events is one row; a longer one continues
    in the next chunks, so no array outgrows a task. A val row is one event and always chunk 0.
    """
    chunk = F.when(F.col("split") == "val", 0).otherwise(F.floor((F.col("position") - 1) / chunk_rows)).cast("int")
    ordered = F.array_sort(F.collect_list(F.struct("position", *SEQUENCE_ARRAYS)))
    grouped = rows.groupBy(F.col("uid").alias("user"), "split", chunk.alias("chunk")).agg(
        ordered.alias("events")
    )
    return grouped.select(
        "user",
        "split",
        "chunk",
        *(
            F.col("events").getField(source).alias(target)
            for source, target in SEQUENCE_ARRAYS.items()
        ),
    )


def split_stats(rows: DataFrame) -> DataFrame:
    """Sessions, items, rows, holdouts (``val_num``) and the behaviour ids that occur.

    Users and items of ``rows`` are dense from 1 and all occur, so their highest ids are their numbers: one
    pre-aggregated pass without distinct counts.
    """
    return rows.agg(
        F.coalesce(F.max("uid"), F.lit(0)).cast("bigint").alias("sessions"),
        F.coalesce(F.max("sid"), F.lit(0)).cast("bigint").alias("items"),
        F.count("*").alias("rows"),
        F.count_if(F.col("split") == "val").alias("val_num"),
        F.array_sort(F.collect_set("behavior")).alias("behaviors"),
    )


def sequence_stats() -> dict[str, Column]:
    """Aggregates over the sequence table: its events and holdouts; a user has at most one val row, of one event."""
    return {
        "events": F.sum(F.size("items")),
        "val_num": F.count_if(F.col("split") == "val"),
    }


def build_dataset(
    events: DataFrame,
    items: DataFrame,
    min_user_events: int = contract.MIN_USER_EVENTS,
    target_behavior: str = contract.TARGET_BEHAVIOR,
    codes: Mapping[str, int] = contract.BEHAVIOR_IDS,
    broadcast_rows: int = BROADCAST_ROWS,
    group_rows: int = GROUP_ROWS,
    chunk_rows: int = CHUNK_ROWS,
) -> Dataset:
    """The whole dataset; data-quality checks live in ``checks`` and run in the job.

    The filtered frame and the ids are stored, because they feed several tables.
    """
    if target_behavior not in codes:
        raise ValueError(f"target behavior is unknown: {target_behavior}")
    frame = model_frame(events, items, broadcast_rows, group_rows)
    kept = spool(keep_active_users(frame, min_user_events, group_rows, events.select("uid")), "active-users")
    maps = id_maps(kept)
    dense = densify(kept, maps, codes, broadcast_rows, group_rows)
    rows = split_holdout(dense, codes[target_behavior])
    return Dataset(
        rows=rows,
        sequences=sequences(rows, chunk_rows),
        umap=_int_map(maps, "uid"),
        smap=_int_map(maps, "sid"),
        bmap=behavior_map(kept, codes),
        segmap=_int_map(maps, "market_segment"),
    )
