"""Listing versions to the catalogue, and events joined to it."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from seqprep import contract
from seqprep.functions import cleaning
from seqprep.functions.geo import tile_cell
from seqprep.operators.dense_ids import dense_ids
from seqprep.operators.skew import BROADCAST_ROWS, GROUP_ROWS, join_skewed


def clean_listings(raw: DataFrame) -> DataFrame:
    """Type the listing columns that are present; all others pass through."""
    casts = (
        {name: cleaning.stripped_double for name in contract.STRIPPED_DOUBLES}
        | {name: cleaning.whole_number for name in contract.INTEGERS}
        | {name: cleaning.lenient_date for name in contract.DATES}
        | {name: cleaning.lenient_timestamp for name in contract.TIMESTAMPS}
    )
    return raw.withColumns(
        {name: cast(F.col(name)) for name, cast in casts.items() if name in raw.columns}
    )


def latest_versions(
    listings: DataFrame,
    key: Sequence[str] = ("anonymized_listing_id",),
    version: str = "updated_at",
    ties: Sequence[str | Column] | None = None,
) -> DataFrame:
    """The newest row per key; a missing version counts as oldest.

    Equal versions are decided by ``ties``, by default every other column, so the winner does not
    depend on file layout. Spark keeps one row per key and task ahead of the shuffle.
    """
    if ties is None:
        ties = [name for name in listings.columns if name not in {*key, version}]
    newest = Window.partitionBy(*key).orderBy(F.desc_nulls_last(version), *ties)
    return (
        listings.withColumn("newest", F.row_number().over(newest))
        .filter(F.col("newest") == 1)
        .drop("newest")
    )


def active_catalog(listings: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Newest ACTIVE version per listing, with its canonical id and a dense numeric id.

    ``within`` names the columns (such as the region) that keep their own listings and ids.
    """
    key = "anonymized_listing_id"
    active = listings.filter((F.col("status") == "ACTIVE") & F.col(key).isNotNull())
    latest = latest_versions(active, [*within, key]).withColumn("canonical_listing_id", F.col(key))
    return dense_ids(latest, [*within, key], "listing_id_numeric", within)


def grown_catalog(
    catalog: DataFrame, listings: DataFrame, within: Sequence[str] = (), added: Sequence[str] = ()
) -> DataFrame:
    """The active catalogue of what ``catalog`` was made from and further cleaned ``listings`` together.

    Only newest ACTIVE versions are looked at again, which is enough: an older version never wins. Columns
    that the catalogue got (ids, and those ``added`` since) are made anew.
    """
    made = {"canonical_listing_id", "listing_id_numeric", *added}
    before = catalog.select(*(name for name in catalog.columns if name not in made))
    return active_catalog(before.unionByName(listings, allowMissingColumns=True), within)


def listing_map(catalog: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    return catalog.select(
        *within, "anonymized_listing_id", "canonical_listing_id", "listing_id_numeric"
    )


def add_cells(
    df: DataFrame,
    resolutions: Iterable[int] = contract.RESOLUTIONS,
    latitude: str = "lat_region",
    longitude: str = "lon_region",
) -> DataFrame:
    """One cell id column per resolution."""
    lat, lon = F.col(latitude), F.col(longitude)
    return df.withColumns(
        {
            f"{contract.CELL_PREFIX}{resolution}": tile_cell(
                lat, lon, contract.CELL_ZOOM.get(resolution, resolution + 7)
            )
            for resolution in resolutions
        }
    )


def item_columns(catalog: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """The item columns that exist, in contract order, then the cells."""
    kept = [name for name in contract.ITEM_COLUMNS if name in catalog.columns]
    cells = [name for name in catalog.columns if name.startswith(contract.CELL_PREFIX)]
    return catalog.select(*within, *kept, *cells)


def unique_items(items: DataFrame, order: Sequence[str] = ("region_order",)) -> DataFrame:
    """One row per canonical id: the first by ``order``, then by all other columns."""
    key = "canonical_listing_id"
    rest = [name for name in items.columns if name != key and name not in order]
    first = Window.partitionBy(key).orderBy(*order, *rest)
    return items.withColumn("first", F.row_number().over(first)).filter("first = 1").drop("first")


def clean_events(events: DataFrame) -> DataFrame:
    """Trim ids, and add ``event_ms`` and ``event_ts`` from the collector's milliseconds."""
    trimmed = events.withColumns(
        {
            name: cleaning.blank_to_null(F.col(name))
            for name in contract.EVENT_IDS
            if name in events.columns
        }
    )
    return trimmed.withColumn(
        "event_ms", cleaning.epoch_millis(F.col("collector_timestamp"))
    ).withColumn("event_ts", F.timestamp_millis("event_ms"))


def enrich_events(
    raw: DataFrame,
    mapping: DataFrame,
    within: Sequence[str] = (),
    accepted: Iterable[str] = tuple(contract.BEHAVIOR_IDS),
    broadcast_rows: int = BROADCAST_ROWS,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Accepted events on catalogued listings, cleaned.

    Ids are trimmed after the join, so a padded listing id matches nothing.
    """
    kept = raw.filter(F.col("event_type").isin(*accepted))
    keys = [*within, "anonymized_listing_id"]
    return clean_events(
        join_skewed(
            kept, mapping, keys, broadcast_rows=broadcast_rows, group_rows=group_rows
        )
    )
