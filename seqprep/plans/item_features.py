"""Feature vectors for every item of a dataset."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import SparkSession

from seqprep import contract
from seqprep.operators import checks, features
from seqprep.operators.skew import BROADCAST_ROWS, GROUP_ROWS
from seqprep.plans.convert import FINAL_EVENTS, FINAL_ITEMS
from seqprep.plans.preprocess import load_smap
from seqprep.sources import manifest, tables
from seqprep.sources.schema import expect_columns
from seqprep.sources.spool import spool, spool_scope

SCHEMA = "seqprep-item-features-1"


def export_item_features(
    spark: SparkSession,
    dataset_dir: str,
    source_dir: str,
    out_dir: str,
    amenities_top: int = contract.AMENITIES_TOP,
    force: bool = False,
    layout: str = "dense",
    broadcast_rows: int = BROADCAST_ROWS,
    group_rows: int = GROUP_ROWS,
) -> dict:
    """Write ``item_features`` and ``feature_columns`` under ``out_dir``; returns the manifest.

    A ``dense`` layout stores every position in ``features``; ``sparse`` stores ``indices`` and ``values`` of those
    that are not zero, whose size does not grow with the vocabularies.
    """
    if layout not in ("dense", "sparse"):
        raise ValueError(f"layout is dense or sparse, not {layout}")
    if amenities_top < 0:
        raise ValueError("amenities top cannot be negative")
    if not force and tables.table_exists(spark, f"{out_dir}/manifest"):
        raise FileExistsError(f"output already exists; use force to replace it: {out_dir}")
    with spool_scope(spark):
        events = tables.read_table(spark, f"{source_dir}/{FINAL_EVENTS}")
        items = tables.read_table(spark, f"{source_dir}/{FINAL_ITEMS}")
        expect_columns(items, contract.CATALOG_COLUMNS, "items")
        smap = load_smap(spark, dataset_dir)
        pairs = spool(features.sid_to_canonical(events), "sid-canonical")
        checks.enforce(
            [
                checks.smap_not_contiguous(smap),
                checks.null_event_keys(pairs),
                checks.no_rows(pairs),
                checks.sid_conflicts(pairs),
                checks.duplicate_canonicals(items),
                checks.sids_not_in_events(smap, pairs),
                checks.items_not_in_catalog(pairs, items, smap),
            ]
        )
        aligned = spool(
            features.align_items(smap, pairs, items, broadcast_rows), "aligned-items"
        )
        build = features.sparse_features if layout == "sparse" else features.feature_matrix
        result = build(aligned, amenities_top, broadcast_rows, group_rows)
        vectors = tables.write_hashed(result.features, f"{out_dir}/item_features", force)
        tables.write_table(result.columns, f"{out_dir}/feature_columns", force)

        stored = replace(result, features=tables.read_table(spark, f"{out_dir}/item_features"))
        measured = features.sparse_stats(stored) if layout == "sparse" else features.matrix_stats(stored)
        stats = spool(measured, "matrix-stats")
        checks.enforce([checks.matrix_invariants(stats)])
        shape = stats.first()
        content = {
            "format": SCHEMA,
            "vectors": shape["rows"],
            "items": shape["num_items"],
            "width": result.dimensions,
            "layout": layout,
            "alignment": "the vector of dense_id n belongs to row n of the item map; dense_id 0 is all zeros",
            "column_table": "feature_columns",
            "options": {"amenities_top": amenities_top},
            "fingerprints": {
                "item_map": manifest.read_manifest(spark, f"{dataset_dir}/manifest")["smap"],
                "session_events": manifest.recorded_state(spark, source_dir, FINAL_EVENTS),
                "catalogue": manifest.recorded_state(spark, source_dir, FINAL_ITEMS),
                "vectors": vectors.text,
            },
        }
        manifest.write_manifest(spark, f"{out_dir}/manifest", content, force)
        return content
