"""Raw regional CSV to the session event and item tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from seqprep import contract
from seqprep.functions.encoding import code_of
from seqprep.operators import catalog, checks, regions as regional, sessions
from seqprep.operators.skew import BROADCAST_ROWS, GROUP_ROWS, is_small
from seqprep.sources import manifest, raw, tables
from seqprep.sources.spool import spool, spool_scope

LISTINGS = "listings_processed"
MAPPING = "listing_id_mapping"
ITEMS = "items_processed"
EVENTS = "events_processed"
SESSIONS = "sessions_processed"
LOADS = "loads"
FILES = "loaded_files"
METRICS = "load_metrics"
FINAL_EVENTS = "events.parquet"
FINAL_ITEMS = "items.parquet"

_REGION = ("region",)
STAGES = ("listings", "events", "sessions")


def _stored(spark: SparkSession, path: str, loads: Mapping[str, str]) -> DataFrame:
    """Of each region the partition that its load wrote."""
    try:
        return tables.read_loads(spark, path, loads)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise checks.CheckFailed(f"{path} holds no rows of {sorted(loads)}") from error
        raise


def load_listings(
    spark: SparkSession,
    data_root: str,
    out_dir: str,
    load: str,
    regions: Sequence[str],
    resolutions: Sequence[int] = contract.RESOLUTIONS,
    files: Mapping[str, Sequence[str]] | None = None,
    grown_from: Mapping[str, str] | None = None,
) -> dict[str, int]:
    """Catalogue, id map and item columns of the given regions; returns rows read and kept.

    With ``files`` only these are read, and the catalogues of the loads in ``grown_from`` grow by them.
    """
    scan = raw.checked_scan(
        spark, data_root, raw.LISTING_FOLDERS, regions, contract.LISTING_COLUMNS, "listings input", files=files
    )
    cleaned = catalog.clean_listings(scan.rows)
    if grown_from is None:
        listings = catalog.active_catalog(cleaned, _REGION)
    else:
        cells = [f"{contract.CELL_PREFIX}{resolution}" for resolution in resolutions]
        earlier = _stored(spark, f"{out_dir}/{LISTINGS}", grown_from)
        listings = catalog.grown_catalog(earlier, cleaned, _REGION, cells)
    each = tables.in_regions(regions, "listings")
    written, seen = tables.counted(catalog.add_cells(listings, resolutions), LISTINGS, **each)
    tables.write_load(written, f"{out_dir}/{LISTINGS}", load)
    stored = _stored(spark, f"{out_dir}/{LISTINGS}", dict.fromkeys(regions, load))
    tables.write_load(catalog.listing_map(stored, _REGION), f"{out_dir}/{MAPPING}", load)
    tables.write_load(catalog.item_columns(stored, _REGION), f"{out_dir}/{ITEMS}", load)
    rejected = raw.write_rejects(scan, f"{out_dir}/{LISTINGS}_rejects", load)
    counts = scan.region_counts() | tables.by_region(seen.get)
    manifest.record_metrics(spark, f"{out_dir}/{METRICS}", load, "listings", counts)
    return {"raw_listings": scan.counts()["lines"], "rejected_listings": rejected, "listings": seen.get["rows"]}


def load_events(
    spark: SparkSession,
    data_root: str,
    out_dir: str,
    load: str,
    mapping_loads: Mapping[str, str],
    broadcast_rows: int = BROADCAST_ROWS,
    group_rows: int = GROUP_ROWS,
    files: Mapping[str, Sequence[str]] | None = None,
) -> dict[str, int]:
    """Accepted events on catalogued listings of the regions in ``mapping_loads``; returns rows kept.

    With ``files`` only these are read; the caller keeps the loads that hold the others.
    """
    scan = raw.checked_scan(
        spark, data_root, raw.EVENT_FOLDERS, list(mapping_loads), contract.EVENT_COLUMNS, "events input", files=files
    )
    scanned = scan.rows
    mapping = _stored(spark, f"{out_dir}/{MAPPING}", mapping_loads)
    if not is_small(mapping, broadcast_rows):
        # The skew-aware join reads its input twice; parse the gzip text only once.
        scanned = spool(scanned.filter(F.col("event_type").isin(*contract.BEHAVIOR_IDS)), "events")
    enriched = catalog.enrich_events(
        scanned, mapping, _REGION, broadcast_rows=broadcast_rows, group_rows=group_rows
    )
    written, seen = tables.counted(enriched, EVENTS, **tables.in_regions(list(mapping_loads), "events"))
    tables.write_load(written, f"{out_dir}/{EVENTS}", load)
    rejected = raw.write_rejects(scan, f"{out_dir}/{EVENTS}_rejects", load)
    counts = scan.region_counts() | tables.by_region(seen.get)
    manifest.record_metrics(spark, f"{out_dir}/{METRICS}", load, "events", counts)
    return {"raw_events": scan.counts()["lines"], "rejected_events": rejected, "events": seen.get["rows"]}


def load_sessions(
    spark: SparkSession,
    out_dir: str,
    load: str,
    event_loads: Mapping[str, str],
    min_session_length: int = contract.MIN_SESSION_LENGTH,
    max_session_length: int = contract.MAX_SESSION_LENGTH,
    min_item_freq: int = contract.MIN_ITEM_FREQ,
    broadcast_rows: int = BROADCAST_ROWS,
    group_rows: int = GROUP_ROWS,
) -> dict[str, int]:
    """Session events with regional ids of the regions in ``event_loads``; returns the rows written."""
    enriched = _stored(spark, f"{out_dir}/{EVENTS}", event_loads)
    built = sessions.build_sessions(
        sessions.session_events(enriched, _REGION),
        min_session_length,
        max_session_length,
        min_item_freq,
        session=[*_REGION, "user_id"],
        within=_REGION,
        broadcast_rows=broadcast_rows,
        group_rows=group_rows,
    )
    each = tables.in_regions(list(event_loads), "session_events")
    written, seen = tables.counted(sessions.model_events(built, _REGION), SESSIONS, **each)
    tables.write_load(written, f"{out_dir}/{SESSIONS}", load)
    counts = tables.by_region(seen.get)
    manifest.record_metrics(spark, f"{out_dir}/{METRICS}", load, "sessions", counts)
    return {"session_events": seen.get["rows"]}


def _ordered(spark: SparkSession, path: str, loads: Mapping[str, str]) -> DataFrame:
    """Stored rows of the regions with their place in the caller's list."""
    places = {region: place for place, region in enumerate(loads)}
    return _stored(spark, path, loads).withColumn("region_order", code_of(F.col("region"), places))


def merge(
    spark: SparkSession,
    out_dir: str,
    regions: Sequence[str],
    output_partitions: int | None = None,
) -> dict:
    """All regions into the final event and item tables, each from its last finished load."""
    recorded = manifest.stage_loads(spark, f"{out_dir}/{LOADS}")
    finished = {key: entry.load for key, entry in recorded.items() if entry.made_from}
    unfinished = sorted({r for r in regions for stage in STAGES if (r, stage) not in finished})
    if unfinished:
        raise RuntimeError(f"not loaded, or not to the end: {unfinished}")
    session_loads = {region: finished[region, "sessions"] for region in regions}
    events = _ordered(spark, f"{out_dir}/{SESSIONS}", session_loads)
    expected = spark.createDataFrame([(region,) for region in regions], "region string")
    checks.enforce([checks.empty_regions(expected, events)])
    merged = regional.merge_regions(events).drop("region", "region_order")
    event_state = tables.write_sorted(
        merged, f"{out_dir}/{FINAL_EVENTS}", "uid", ["timestamp", "pos"], output_partitions
    )
    listing_loads = {region: finished[region, "listings"] for region in regions}
    items = catalog.unique_items(_ordered(spark, f"{out_dir}/{ITEMS}", listing_loads))
    item_state = tables.write_hashed(items.drop("region", "region_order"), f"{out_dir}/{FINAL_ITEMS}", force=True)
    manifest.record_states(spark, out_dir, {FINAL_EVENTS: event_state, FINAL_ITEMS: item_state})
    stats = regional.merge_stats(tables.read_table(spark, f"{out_dir}/{FINAL_EVENTS}")).first()
    return stats.asDict() | {"catalog_items": item_state.rows}


def _sources(files: DataFrame) -> dict[str, str]:
    """Number and fingerprint of each region's files."""
    rows = raw.input_fingerprints(files).collect()
    return {row["region"]: f"{row['files']}-{row['fingerprint']}" for row in rows}


def _growth(
    current: DataFrame, loaded: DataFrame, entries: Mapping[str, manifest.StageLoad | None], wanted: Mapping[str, str]
) -> dict[str, list[str]]:
    """Regions whose stage differs from what is wanted by new files alone, with these files."""
    added = raw.added_files(current, loaded)

    def but_files(text: str) -> dict:
        return {name: value for name, value in json.loads(text).items() if name != "files"}

    return {
        region: added[region]
        for region, entry in entries.items()
        if entry and entry.made_from and added.get(region) and but_files(entry.made_from) == but_files(wanted[region])
    }


def convert(
    spark: SparkSession,
    data_root: str,
    out_dir: str,
    regions: Sequence[str] = contract.REGIONS,
    min_session_length: int = contract.MIN_SESSION_LENGTH,
    max_session_length: int = contract.MAX_SESSION_LENGTH,
    min_item_freq: int = contract.MIN_ITEM_FREQ,
    resolutions: Sequence[int] = contract.RESOLUTIONS,
    output_partitions: int | None = None,
    final_only: bool = False,
    broadcast_rows: int = BROADCAST_ROWS,
    group_rows: int = GROUP_ROWS,
) -> dict:
    """Bring every region's stages up to date, then merge.

    A stage of a region is made again when its files, its parameters or an earlier stage changed. Where the
    only change is further files, only these are read: catalogues grow by them, and their events are stored next
    to those loaded before (new listings make a region's events be joined again). A stage's entry is
    withdrawn before and recorded after, and each load has files of its own. So a load that breaks off leaves
    nothing that a merge would take, and a changed session limit reads no text. Earlier loads stay on disk
    until removed. Returns the counts of the final tables, the regions that were loaded, and the rows that
    each stage wrote for them; ``load_metrics`` keeps them by load, stage and region.
    """
    regions = raw.check_regions(regions)
    sessions.check_lengths(min_session_length, max_session_length)
    if min_item_freq <= 0 or (output_partitions is not None and output_partitions <= 0):
        raise ValueError("min item frequency and output partitions must be positive")
    loaded: set[str] = set()
    stages: dict[str, int] = {}
    if not final_only:
        lengths = {"min_session_length": min_session_length, "max_session_length": max_session_length}
        limits = {"broadcast_rows": broadcast_rows, "group_rows": group_rows}
        files = {
            "listings": raw.listed_files(spark, data_root, raw.LISTING_FOLDERS, regions),
            "events": raw.listed_files(spark, data_root, raw.EVENT_FOLDERS, regions),
        }
        listing_files, event_files = _sources(files["listings"]), _sources(files["events"])
        made_from: dict[str, dict[str, str]] = {"listings": {}, "events": {}, "sessions": {}}
        for region in regions:
            before = manifest.parameter_text(files=listing_files[region], resolutions=list(resolutions))
            made_from["listings"][region] = before
            before = manifest.parameter_text(files=event_files[region], listings=before)
            made_from["events"][region] = before
            made_from["sessions"][region] = manifest.parameter_text(
                events=before, min_item_freq=min_item_freq, **lengths
            )
        for place, stage in enumerate(STAGES):
            recorded = manifest.stage_loads(spark, f"{out_dir}/{LOADS}")
            current = {region: recorded.get((region, stage)) for region in regions}
            pending = [
                region
                for region, entry in current.items()
                if entry is None or entry.made_from != made_from[stage][region]
            ]
            if not pending:
                continue
            grown: dict[str, list[str]] = {}
            if stage in files:
                entries = {region: current[region] for region in pending}
                seen = manifest.loaded_files(spark, f"{out_dir}/{FILES}", stage)
                grown = _growth(files[stage], seen, entries, made_from[stage])
            withdrawn = [
                manifest.StageLoad(region, later, "", "") for region in pending for later in STAGES[place:]
            ]
            manifest.record_stages(spark, f"{out_dir}/{LOADS}", withdrawn)
            for part in (list(grown), [region for region in pending if region not in grown]):
                if not part:
                    continue
                load = f"load-{uuid.uuid4().hex}"
                new = {region: grown[region] for region in part} if part[0] in grown else None
                earlier = {r: recorded[r, STAGES[place - 1]].load for r in part} if place else {}
                kept = {r: recorded[r, stage].load for r in part} if new else None
                with spool_scope(spark):
                    if stage == "listings":
                        rows = load_listings(spark, data_root, out_dir, load, part, resolutions, new, kept)
                    elif stage == "events":
                        rows = load_events(spark, data_root, out_dir, load, earlier, files=new, **limits)
                    else:
                        rows = load_sessions(
                            spark, out_dir, load, earlier, min_item_freq=min_item_freq, **lengths, **limits
                        )
                if stage in files:
                    own = files[stage].filter(F.col("region").isin(*part))
                    manifest.record_files(spark, f"{out_dir}/{FILES}", stage, own)
                # New events stand beside the loads that hold the others.
                loads = {r: f"{kept[r]},{load}" if new and stage == "events" else load for r in part}
                done = [manifest.StageLoad(region, stage, made_from[stage][region], loads[region]) for region in part]
                manifest.record_stages(spark, f"{out_dir}/{LOADS}", done)
                loaded |= set(part)
                stages |= {name: stages.get(name, 0) + count for name, count in rows.items()}
    counts = merge(spark, out_dir, regions, output_partitions)
    return counts | {"loaded": [region for region in regions if region in loaded], "stages": stages}
