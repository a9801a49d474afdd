"""Final event and item tables to the sequence dataset."""

from __future__ import annotations

from pyspark.sql import SparkSession, functions as F

from seqprep import contract
from seqprep.operators import checks
from seqprep.operators.dataset import CHUNK_ROWS, build_dataset, sequence_stats
from seqprep.operators.skew import BROADCAST_ROWS, GROUP_ROWS
from seqprep.plans.convert import FINAL_EVENTS, FINAL_ITEMS
from seqprep.sources import fingerprints, manifest, tables
from seqprep.sources.schema import expect_columns
from seqprep.sources.spool import spool, spool_scope

SCHEMA = "seqprep-dataset-2"
MAPS = ("umap", "smap", "bmap", "segmap")


def preprocess(
    spark: SparkSession,
    source_dir: str,
    out_dir: str,
    min_user_events: int = contract.MIN_USER_EVENTS,
    target_behavior: str = contract.TARGET_BEHAVIOR,
    force: bool = False,
    broadcast_rows: int = BROADCAST_ROWS,
    group_rows: int = GROUP_ROWS,
    chunk_rows: int = CHUNK_ROWS,
) -> dict:
    """Write ``sequences`` and the four maps under ``out_dir``; returns the manifest."""
    if min_user_events < 2:
        raise ValueError("min user events must be at least 2")
    if not force and tables.table_exists(spark, f"{out_dir}/manifest"):
        raise FileExistsError(f"output already exists; use force to replace it: {out_dir}")
    with spool_scope(spark):
        events = tables.read_table(spark, f"{source_dir}/{FINAL_EVENTS}")
        items = tables.read_table(spark, f"{source_dir}/{FINAL_ITEMS}")
        expect_columns(events, contract.SESSION_EVENT_COLUMNS, "events")
        expect_columns(items, contract.MODEL_ITEM_COLUMNS, "items")
        checks.enforce([checks.duplicate_canonicals(items), checks.bad_intensity(events)])

        dataset = build_dataset(
            events,
            items,
            min_user_events,
            target_behavior,
            broadcast_rows=broadcast_rows,
            group_rows=group_rows,
            chunk_rows=chunk_rows,
        )
        bmap = spool(dataset.bmap, "bmap")
        checks.enforce(
            [
                checks.no_rows(dataset.umap),
                checks.unknown_behaviors(bmap, "behavior"),
                checks.target_absent(bmap, target_behavior),
            ]
        )
        seen = sequence_stats()
        sequences, counts = fingerprints.observed(dataset.sequences, **seen)
        tables.write_table(sequences, f"{out_dir}/sequences", force)
        states = {
            name: tables.write_hashed(bmap if name == "bmap" else getattr(dataset, name), f"{out_dir}/{name}", force)
            for name in MAPS
        }
        content = {
            "schema": SCHEMA,
            "rows": counts.get["events"] or 0,
            "val_num": counts.get["val_num"],
            "sessions": states["umap"].rows,
            "items": states["smap"].rows,
            "behaviors": sorted(row["id"] for row in bmap.collect()),
            "target_behavior": target_behavior,
            "min_user_events": min_user_events,
            "sequences": fingerprints.state_of(counts).text,
            "sequence_files": fingerprints.file_state(spark, f"{out_dir}/sequences"),
        } | {name: state.text for name, state in states.items()}
        manifest.write_manifest(spark, f"{out_dir}/manifest", content, force)
        return content


def load_smap(spark: SparkSession, dataset_dir: str, deep: bool = False):
    """The item map, after checking that it belongs to the sequences next to it; call it inside a spool scope.

    The map's state is taken while it is copied for the steps that follow. The sequences are not read: their
    files must be those that the job listed, by name and length. With ``deep`` their rows are hashed too.
    """
    if not tables.table_exists(spark, f"{dataset_dir}/manifest"):
        raise FileNotFoundError(f"no dataset manifest in {dataset_dir}; run preprocess first")
    content = manifest.read_manifest(spark, f"{dataset_dir}/manifest")
    if content.get("schema") != SCHEMA:
        raise ValueError("the dataset has another format")
    sequences = f"{dataset_dir}/sequences"
    if content["sequence_files"] != fingerprints.file_state(spark, sequences):
        raise ValueError("the sequences are not those of the manifest")
    if deep and content["sequences"] != fingerprints.scanned_state(tables.read_table(spark, sequences)).text:
        raise ValueError("the sequences are not those of the manifest")
    smap = tables.read_table(spark, f"{dataset_dir}/smap")
    if set(smap.columns) != {"sid", "dense_id"}:
        raise ValueError("the item map has columns other than sid and dense_id")
    rows, seen = fingerprints.observed(smap)
    stored = spool(rows, "item-map")
    if content["smap"] != fingerprints.state_of(seen).text:
        raise ValueError("the item map is not that of the manifest")
    return stored.select(F.col("sid"), F.col("dense_id"))
