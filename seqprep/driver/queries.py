"""One query per operator, over the driver's whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from seqprep import contract
from seqprep.driver import fixtures as fx
from seqprep.functions import cleaning
from seqprep.functions.encoding import code_of
from seqprep.operators import catalog, checks, dataset, features, regions, sessions, skew
from seqprep.operators.dense_ids import dense_ids
from seqprep.sources import fingerprints, manifest, raw, tables
from seqprep.sources.schema import MissingColumns
from seqprep.sources.spool import shared_folder, spool

Query = Callable[[SparkSession, str], DataFrame]

ORDER = ("event_us", "event_id")
# Limits small enough for the oversized-group paths to run on the test tables.
TIGHT = {"group_rows": 60}
SALTED = {"broadcast_rows": 0, "group_rows": 60}


# -- cleaning ---------------------------------------------------------------------------------


def clean_numeric(spark, sf_dir):
    items = fx.table(spark, sf_dir, "lineitem")
    amount = fx.text(F.col("l_extendedprice").cast("decimal(12,2)"))
    raw = F.when(F.col("l_linenumber") == 1, F.concat(F.lit("R$ "), amount)).when(
        F.col("l_linenumber") == 2, F.concat(F.lit("-"), amount)
    ).when(F.col("l_linenumber") == 3, F.concat(amount, F.lit(".1"))).when(
        F.col("l_linenumber") == 4, F.lit("n/a")
    ).otherwise(amount)
    return items.select(
        "l_orderkey", "l_linenumber", "l_partkey", cleaning.stripped_double(raw).alias("price")
    )


def clean_int(spark, sf_dir):
    line, key = F.col("l_linenumber"), fx.text("l_partkey")
    raw = (
        F.when(line == 1, F.concat(F.lit(" "), key, F.lit(".9")))
        .when(line == 2, F.concat(F.lit("-"), key))
        .when(line == 3, F.concat(key, F.lit("e2")))
        .when(line == 4, F.concat(F.lit("."), key))
        .when(line == 5, F.concat(key, F.lit("99999999999")))
        .when(line == 6, F.concat(F.lit("+"), key, F.lit(".")))
        .otherwise(key)
    )
    return fx.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", cleaning.whole_number(raw).alias("bedrooms")
    )


def clean_dates(spark, sf_dir):
    line = F.col("l_linenumber")
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    raw = F.when(line == 1, F.lit("soon")).when(line == 2, F.lit("2024-02-30")).otherwise(day)
    moment = F.when(line == 3, F.concat(day, F.lit(" 12:34:56"))).otherwise(raw)
    return fx.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.date_format(cleaning.lenient_date(raw), "yyyy-MM-dd").alias("dt"),
        F.unix_timestamp(cleaning.lenient_timestamp(moment)).alias("updated_s"),
    )


def blank_ids(spark, sf_dir):
    cleaned = catalog.clean_events(fx.raw_events(spark, sf_dir))
    return cleaned.select("event_id", "anonymized_listing_id", "anonymized_session_id")


def epoch_ms(spark, sf_dir):
    cleaned = catalog.clean_events(fx.raw_events(spark, sf_dir)).withColumn(
        "canonical_listing_id", F.col("anonymized_listing_id")
    )
    return sessions.session_events(cleaned, ["event_id"]).select(
        "event_id", "user_id", "timestamp", "event_ms"
    )


def geo_cells(spark, sf_dir):
    return fx.catalog_items(spark, sf_dir).select("canonical_listing_id", "h3_res6", "h3_res7")


def market_segment(spark, sf_dir):
    return features.catalog_with_segment(fx.catalog_items(spark, sf_dir)).select(
        "canonical_listing_id", "market_segment"
    )


# -- catalogue --------------------------------------------------------------------------------


def latest_listing(spark, sf_dir):
    versions = fx.listing_versions(spark, sf_dir).filter("status = 'ACTIVE'")
    latest = catalog.latest_versions(versions, ties=["l_orderkey", "l_linenumber"])
    return latest.select(
        "anonymized_listing_id",
        "l_orderkey",
        "l_linenumber",
        F.unix_timestamp("updated_at").alias("updated_s"),
    )


def listing_id_map(spark, sf_dir):
    return catalog.listing_map(catalog.active_catalog(fx.listing_versions(spark, sf_dir)))


def regional_listing_ids(spark, sf_dir):
    listings = catalog.active_catalog(fx.listing_versions(spark, sf_dir), ["region"])
    return catalog.listing_map(listings, ["region"])


def unique_items(spark, sf_dir):
    regional = catalog.active_catalog(fx.listing_versions(spark, sf_dir), ["region"])
    ordered = regional.select(
        F.substring("region", 2, 1).cast("int").alias("region_order"),
        "canonical_listing_id",
        "l_orderkey",
        "l_linenumber",
    )
    return catalog.unique_items(ordered)


def item_columns(spark, sf_dir):
    return catalog.item_columns(fx.catalog_items(spark, sf_dir))


def regional_loads(spark, sf_dir):
    """Two loads of one table; each region is read from its own."""
    versions = fx.listing_versions(spark, sf_dir)
    path = f"{shared_folder(spark)}/regional-loads-{uuid.uuid4().hex}"
    tables.write_load(versions, path, "first")
    tables.write_load(versions.filter("status = 'ACTIVE'"), path, "second")
    stored = tables.read_loads(spark, path, {"r0": "first", "r1": "second", "r2": "first"})
    return stored.groupBy("region", "status").agg(F.count("*").alias("rows"))


def united_loads(spark, sf_dir):
    """Loads that wrote other columns, united by the names recorded for each."""
    versions = fx.listing_versions(spark, sf_dir)
    path = f"{shared_folder(spark)}/united-loads-{uuid.uuid4().hex}"
    tables.write_load(versions.select("region", "anonymized_listing_id", "l_quantity"), path, "first")
    tables.write_load(versions.select("l_orderkey", "region", "anonymized_listing_id"), path, "second")
    stored = tables.read_loads(spark, path, {"r0": "first", "r1": "second", "r2": "first,second"})
    return stored.groupBy("region").agg(
        F.count("anonymized_listing_id").alias("rows"),
        F.count("l_quantity").alias("quantities"),
        F.sum("l_orderkey").alias("orders"),
    )


def _write_listings(lines, root, folder="listings"):
    """Raw files of three regions, next to those that are there, from (region, a line under its header)."""
    for region in ("r0", "r1", "r2"):
        own = lines.filter(F.col("region") == region).drop("region")
        writer = own.write.mode("append").option("header", True).option("sep", "\u0001").option("compression", "gzip")
        writer.csv(f"{root}/{folder}/{region}")


def incremental_load(spark, sf_dir):
    """Catalogues of three regions made from a first batch of files and grown by the files of a second."""
    names = ["anonymized_listing_id", "status", "updated_at", "l_orderkey", "l_linenumber"]
    versions = fx.listing_versions(spark, sf_dir)
    moment = F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss")
    text = F.concat_ws(",", names[0], "status", moment, fx.text("l_orderkey"), fx.text("l_linenumber"))
    root = f"{shared_folder(spark)}/incremental-load-{uuid.uuid4().hex}"
    regions = ["r0", "r1", "r2"]

    def listed():
        return spool(raw.listed_files(spark, root, raw.LISTING_FOLDERS, regions), "listed-files")

    def cleaned(files=None):
        scan = raw.checked_scan(spark, root, raw.LISTING_FOLDERS, regions, names, "listings", files=files)
        whole = {name: F.col(name).cast("bigint") for name in names[3:]}
        return catalog.clean_listings(scan.rows).withColumns(whole)

    second = F.col("l_orderkey") % 4 == 1
    _write_listings(versions.filter(~second).select("region", text.alias(",".join(names))), root)
    first_files = listed()
    first = spool(catalog.active_catalog(cleaned(), ["region"]), "first-catalog")
    _write_listings(versions.filter(second).select("region", text.alias(",".join(names))), root)
    added = raw.added_files(listed(), first_files)
    grown = catalog.grown_catalog(first, cleaned(added), ["region"])
    return grown.select(
        "region", names[0], F.unix_timestamp("updated_at").alias("updated_s"), "l_orderkey", "l_linenumber", "listing_id_numeric"
    )


_SCANNED = ["anonymized_listing_id", "status", "updated_at", "price", "note"]


def _faulty_files(spark, sf_dir):
    """Scan of line items as raw files of three regions, some lines with a field too few or too many."""
    names = _SCANNED
    lines = fx.listing_versions(spark, sf_dir).select(
        "region",
        F.col("l_orderkey").alias("order"),
        F.col("l_linenumber").alias("line"),
        F.col("anonymized_listing_id").alias("part"),
        "status",
    )
    head = F.concat_ws(",", "part", "status", fx.text("order"), fx.text("line"))
    text = F.when(F.col("order") % 50 == 3, F.concat_ws(",", "part", "status")).when(
        F.col("order") % 50 == 7, F.concat(head, F.lit(",x,y"))
    ).otherwise(F.concat(head, F.lit(",")))
    root = f"{shared_folder(spark)}/regional-scan-{uuid.uuid4().hex}"
    _write_listings(lines.select("region", text.alias(",".join(names))), root)
    return raw.checked_scan(spark, root, raw.LISTING_FOLDERS, ["r0", "r1", "r2"], names, "listings", keep_rejects=False)


def load_metrics(spark, sf_dir):
    """What a load observes on its way, by region: lines, rejected lines, rows it writes."""
    scan = _faulty_files(spark, sf_dir)
    path = f"{shared_folder(spark)}/load-metrics-{uuid.uuid4().hex}"
    active = scan.rows.filter("status = 'ACTIVE'")
    written, seen = tables.counted(active, "listings", **tables.in_regions(["r0", "r1", "r2"], "listings"))
    tables.write_load(written, f"{path}/listings", "load-1")
    counts = scan.region_counts() | tables.by_region(seen.get)
    manifest.record_metrics(spark, f"{path}/metrics", "load-1", "listings", counts)
    return manifest.metrics(spark, f"{path}/metrics").select("load", "stage", "region", "metric", "rows")


def regional_scan(spark, sf_dir):
    """Line items written as raw files of three regions, and scanned: rows, and lines that do not parse."""
    names, scan = _SCANNED, _faulty_files(spark, sf_dir)
    kept = scan.rows.select("region", *names[:4], F.lit(None).cast("string").alias("rejected"))
    empty = [F.lit(None).cast("string").alias(name) for name in names[1:4]]
    return kept.unionByName(
        scan.rejects.select("region", F.col("key").alias(names[0]), *empty, F.col("line").alias("rejected"))
    )


def _answer(spark, request, found=None, refused=None):
    """What a request found, or one row that says why it was refused."""
    if found is None:
        found = spark.range(1).select(F.lit(None).cast("string").alias("part"), F.lit(None).cast("bigint").alias("rows"))
    return found.select(F.lit(request).alias("request"), "part", "rows", F.lit(refused).cast("string").alias("refused"))


def source_layout(spark, sf_dir):
    """Lines by region of raw files under the other folder name; unknown regions and columns are refused."""
    names = _SCANNED[:3]
    versions = fx.listing_versions(spark, sf_dir)
    text = F.concat_ws(",", *names[:2], F.date_format("updated_at", "yyyy-MM-dd"))
    root = f"{shared_folder(spark)}/source-layout-{uuid.uuid4().hex}"
    _write_listings(versions.select("region", text.alias(",".join(names))), root, "listing")

    def ask(request, regions, wanted):
        try:
            scan = raw.checked_scan(spark, root, raw.LISTING_FOLDERS, regions, wanted, "listings")
        except (FileNotFoundError, MissingColumns) as error:
            return _answer(spark, request, refused=type(error).__name__)
        lines = scan.rows.groupBy(F.col("region").alias("part")).agg(F.count("*").alias("rows"))
        return _answer(spark, request, lines)

    return (
        ask("all regions", ["r0", "r1", "r2"], names)
        .unionByName(ask("one region", ["r1"], names))
        .unionByName(ask("unknown region", ["r0", "r9"], names))
        .unionByName(ask("unknown column", ["r0"], [*names, "price"]))
    )


def overwrite_guard(spark, sf_dir):
    """What a table holds after a write, a second one that is refused, and one that replaces it."""
    versions = fx.listing_versions(spark, sf_dir)
    active = F.col("status") == "ACTIVE"
    path = f"{shared_folder(spark)}/overwrite-guard-{uuid.uuid4().hex}"

    def write(request, rows, force=False):
        refused = None
        try:
            tables.write_table(rows, path, force)
        except AnalysisException as error:
            refused = error.getCondition()
        held = tables.read_table(spark, path).groupBy(F.col("status").alias("part")).agg(F.count("*").alias("rows"))
        return spool(_answer(spark, request, held, refused), "held")

    first = write("first", versions.filter(active))
    again = write("again", versions.filter(~active))
    forced = write("forced", versions.filter(~active), force=True)
    return first.unionByName(again).unionByName(forced)


def parameter_bounds(spark, sf_dir):
    """Runs by event type that session limits leave, and the limits that are refused."""

    def ask(least, most):
        request = f"{least} to {most}"
        try:
            runs = sessions.session_runs(fx.click_events(spark, sf_dir), least, most, order=ORDER)
        except ValueError as error:
            return _answer(spark, request, refused=str(error))
        return _answer(spark, request, runs.groupBy(F.col("event_type").alias("part")).agg(F.count("*").alias("rows")))

    return ask(3, 5).unionByName(ask(1, 5)).unionByName(ask(6, 5))


def sorted_sink(spark, sf_dir):
    """Per session the files that hold it, and the rows that stand before an earlier one in a file."""
    path = f"{shared_folder(spark)}/sorted-sink-{uuid.uuid4().hex}"
    events = fx.click_events(spark, sf_dir).select("user_id", "event_us", "event_id")
    tables.write_sorted(events, path, "user_id", ["event_us", "event_id"], 7)
    stored = tables.read_table(spark, path).select(
        "*", F.input_file_name().alias("file"), F.col("_metadata.row_index").alias("place")
    )
    in_file = Window.partitionBy("file").orderBy("place")
    late = F.struct("user_id", "event_us", "event_id") < F.lag(F.struct("user_id", "event_us", "event_id")).over(in_file)
    return (
        stored.withColumn("late", F.coalesce(late, F.lit(False)))
        .groupBy("user_id")
        .agg(F.count("*").alias("rows"), F.count_distinct("file").alias("files"), F.count_if("late").alias("late"))
    )


def _part_mapping(spark, sf_dir):
    parts = fx.table(spark, sf_dir, "part")
    return parts.select(
        fx.text("p_partkey").alias("anonymized_listing_id"),
        fx.text("p_partkey").alias("canonical_listing_id"),
        F.col("p_partkey").alias("listing_id_numeric"),
    )


def _enriched(spark, sf_dir, **limits):
    events = catalog.enrich_events(
        fx.raw_events(spark, sf_dir),
        _part_mapping(spark, sf_dir),
        accepted=("click", "purchase", "view"),
        **limits,
    )
    return events.select(
        "event_id", "anonymized_session_id", "canonical_listing_id", "event_type", "event_ms"
    )


def events_join_catalog(spark, sf_dir):
    return _enriched(spark, sf_dir)


def events_join_catalog_salted(spark, sf_dir):
    return _enriched(spark, sf_dir, **SALTED)


# -- sessions ---------------------------------------------------------------------------------


def run_collapse(spark, sf_dir):
    return sessions.collapse_runs(fx.click_events(spark, sf_dir), order=ORDER)


def run_collapse_hot(spark, sf_dir):
    return sessions.collapse_runs(fx.user_events(spark, sf_dir), order=ORDER, **TIGHT)


def _untimed_events(spark, sf_dir):
    """Long sessions whose times fall along the order, with some types missing."""
    return (
        fx.user_events(spark, sf_dir)
        .withColumn("timestamp", -F.col("timestamp"))
        .withColumn("event_type", F.when(F.col("event_id") % 3 != 0, F.col("event_type")))
    )


def run_collapse_untimed(spark, sf_dir):
    return sessions.collapse_runs(_untimed_events(spark, sf_dir), order=ORDER)


def run_collapse_untimed_hot(spark, sf_dir):
    return sessions.collapse_runs(_untimed_events(spark, sf_dir), order=ORDER, **TIGHT)


def session_length(spark, sf_dir):
    runs = sessions.collapse_runs(fx.click_events(spark, sf_dir), order=ORDER)
    return sessions.filter_sessions_by_length(runs, 3, 5)


def session_length_long(spark, sf_dir):
    """A limit too long for Spark's per-task cut, on oversized sessions."""
    runs = sessions.collapse_runs(fx.user_events(spark, sf_dir), order=ORDER, **TIGHT)
    return sessions.filter_sessions_by_length(runs, 62, 1000, **TIGHT)


def rare_items(spark, sf_dir):
    runs = spool(sessions.collapse_runs(fx.click_events(spark, sf_dir), order=ORDER), "runs")
    return sessions.filter_rare_items(runs, 80)


def rare_items_salted(spark, sf_dir):
    runs = spool(sessions.collapse_runs(fx.click_events(spark, sf_dir), order=ORDER), "runs")
    return sessions.filter_rare_items(runs, 80, **SALTED)


def item_support(spark, sf_dir):
    runs = sessions.collapse_runs(fx.click_events(spark, sf_dir), order=ORDER)
    return sessions.item_support(runs)


def _session_columns(built, *within):
    return built.select(
        *within,
        "user_id",
        "item_id",
        "event_type",
        "timestamp",
        "intensity",
        "run_seq",
        "session_id_numeric",
        "item_id_numeric",
    )


def session_chain(spark, sf_dir):
    events = fx.click_events(spark, sf_dir)
    return _session_columns(sessions.build_sessions(events, 3, 5, 60, order=ORDER))


def session_chain_hot(spark, sf_dir):
    built = sessions.build_sessions(
        fx.user_events(spark, sf_dir), 3, 40, 30, order=ORDER, **SALTED
    )
    return _session_columns(built)


def dense_session_ids(spark, sf_dir):
    keys = fx.click_events(spark, sf_dir).select("user_id").distinct()
    return dense_ids(keys, ["user_id"], "session_id_numeric")


def _regional_events(spark, sf_dir):
    built = sessions.build_sessions(
        fx.click_events(spark, sf_dir),
        3,
        50,
        20,
        session=["region", "user_id"],
        within=["region"],
        order=ORDER,
    )
    return sessions.model_events(built, ["region"])


def region_merge(spark, sf_dir):
    events = _regional_events(spark, sf_dir)
    ordered = spool(
        events.withColumn("region_order", code_of(F.col("region"), {"r0": 0, "r1": 1})), "regional"
    )
    return regions.merge_regions(ordered).drop("region_order")


def merge_stats(spark, sf_dir):
    return regions.merge_stats(region_merge(spark, sf_dir))


# -- sequence dataset -------------------------------------------------------------------------


def _model_events(spark, sf_dir):
    events = fx.click_events(spark, sf_dir).withColumn("item_id", F.col("canonical_listing_id"))
    built = sessions.build_sessions(events, 2, 50, 5, order=ORDER)
    return spool(sessions.model_events(built), "model-events")


def _dataset(spark, sf_dir, **limits):
    return dataset.build_dataset(
        _model_events(spark, sf_dir),
        fx.catalog_items(spark, sf_dir),
        3,
        fx.TARGET,
        fx.EVENT_CODES,
        **limits,
    )


def enriched_events(spark, sf_dir):
    return dataset.model_frame(_model_events(spark, sf_dir), fx.catalog_items(spark, sf_dir))


def min_events(spark, sf_dir):
    frame = dataset.model_frame(_model_events(spark, sf_dir), fx.catalog_items(spark, sf_dir))
    kept = dataset.keep_active_users(frame, 3)
    return kept.select("uid", "sid", "behavior", "timestamp", "pos", "position", "group_size")


def positions_hot(spark, sf_dir):
    events = fx.user_events(spark, sf_dir).select("user_id", *ORDER)
    return skew.number_within_groups(events, ["user_id"], ORDER, **TIGHT)


def densify(spark, sf_dir):
    rows = _dataset(spark, sf_dir).rows
    return rows.select("uid", "sid", "behavior", "market_segment", "position")


def densify_salted(spark, sf_dir):
    rows = _dataset(spark, sf_dir, **SALTED).rows
    return rows.select("uid", "sid", "behavior", "market_segment", "position")


def dataset_maps(spark, sf_dir):
    built = _dataset(spark, sf_dir)

    def entries(name, mapping, key, value):
        return mapping.select(
            F.lit(name).alias("map"), fx.text(key).alias("key"), F.col(value).alias("id")
        )

    return (
        entries("umap", built.umap, "uid", "user")
        .unionByName(entries("smap", built.smap, "sid", "dense_id"))
        .unionByName(entries("bmap", built.bmap, "behavior", "id"))
        .unionByName(entries("segmap", built.segmap, "market_segment", "segment_id"))
    )


def holdout_split(spark, sf_dir):
    return _dataset(spark, sf_dir).rows.select("uid", "position", "behavior", "split")


def split_stats(spark, sf_dir):
    stats = dataset.split_stats(_dataset(spark, sf_dir).rows)
    return stats.withColumn("behaviors", F.array_join("behaviors", ","))


def _thousandths(value):
    return F.round(value * 1000).cast("bigint").cast("string")


def _joined(sequences):
    """Arrays as text, so that both engines compare the same values."""
    return sequences.select(
        "user",
        "split",
        "chunk",
        *(
            F.array_join(F.transform(name, lambda value: value.cast("string")), ",").alias(name)
            for name in ("items", "behaviors", "intensity", "segments")
        ),
        *(
            F.array_join(F.transform(name, _thousandths), ",").alias(name)
            for name in ("latitudes", "longitudes")
        ),
    )


def sequences(spark, sf_dir):
    return _joined(_dataset(spark, sf_dir).sequences)


def sequences_chunked(spark, sf_dir):
    return _joined(_dataset(spark, sf_dir, chunk_rows=2).sequences)


# -- item features ----------------------------------------------------------------------------


def list_parse(spark, sf_dir):
    parsed = features.with_amenity_list(fx.catalog_items(spark, sf_dir))
    return parsed.select(
        "canonical_listing_id", F.array_join("amenity_list", "|").alias("amenities")
    )


def vocabulary(spark, sf_dir):
    items = fx.catalog_items(spark, sf_dir)
    return features.vocabularies(items, ["neighborhood", "unit_type", "business_type"])


def topk_amenities(spark, sf_dir):
    return features.top_amenities(features.with_amenity_list(fx.catalog_items(spark, sf_dir)), 7)


def hash_buckets(spark, sf_dir):
    items = features.hash_buckets(fx.catalog_items(spark, sf_dir))
    buckets = [f"{name}_bucket" for name in contract.HASHED_FEATURES]
    return items.select("canonical_listing_id", *buckets)


def _aligned(spark, sf_dir, **limits):
    smap, pairs = fx.part_map(spark, sf_dir)
    items = fx.catalog_items(spark, sf_dir)
    return spool(features.align_items(smap, pairs, items, **limits), "aligned")


def item_alignment(spark, sf_dir):
    aligned = _aligned(spark, sf_dir, broadcast_rows=0)
    return aligned.select("dense_id", "canonical_listing_id", "market_segment")


def _matrix(spark, sf_dir, top=7, **limits):
    return features.feature_matrix(_aligned(spark, sf_dir), top, **limits)


def _cells(result, wanted, set_only=False):
    """Cells of the wanted columns, without the padding row."""
    cells = features.long_features(result, wanted).filter("dense_id > 0")
    if set_only:
        cells = cells.filter("value <> 0")
    return cells.select("dense_id", "name", F.round(F.col("value").cast("double"), 3).alias("value"))


def _block(*names):
    return F.col("name").isin(*names, *(f"missing_{name}" for name in names))


def feat_log(spark, sf_dir):
    logs = [f"log1p_{name}" for name in contract.LOG_FEATURES]
    missing = [f"missing_{name}" for name in contract.LOG_FEATURES]
    return _cells(_matrix(spark, sf_dir), F.col("name").isin(*logs, *missing))


def feat_count(spark, sf_dir):
    return _cells(_matrix(spark, sf_dir), _block(*contract.COUNT_FEATURES))


def feat_coord(spark, sf_dir):
    return _cells(_matrix(spark, sf_dir), _block(*contract.COORDINATE_FEATURES))


_ONE_HOT = " OR ".join(f"startswith(name, '{name}=')" for name in contract.ONE_HOT_FEATURES)


def feat_onehot(spark, sf_dir):
    return _cells(_matrix(spark, sf_dir), F.expr(_ONE_HOT), set_only=True)


def feat_onehot_salted(spark, sf_dir):
    return _cells(_matrix(spark, sf_dir, **SALTED), F.expr(_ONE_HOT), set_only=True)


def feat_amenity(spark, sf_dir):
    return _cells(_matrix(spark, sf_dir), F.col("name").startswith("amenity="))


def feat_hash(spark, sf_dir):
    hashed = F.col("name").contains("_hash_") | F.col("name").isin(
        *(f"missing_{name}" for name in contract.HASHED_FEATURES)
    )
    return _cells(_matrix(spark, sf_dir), hashed, set_only=True)


def feature_columns(spark, sf_dir):
    return _matrix(spark, sf_dir).columns


def _positions(result):
    return result.features.select(
        "dense_id",
        F.size("features").alias("width"),
        F.expr("size(filter(features, value -> value <> 0))").cast("bigint").alias("non_zero"),
        F.expr(
            "aggregate(transform(features, (value, place) -> IF(value <> 0, place, 0)), 0L,"
            " (total, place) -> total + place)"
        ).alias("position_sum"),
    )


def feature_matrix(spark, sf_dir):
    """Every item vector, padding row included, summed up by its non-zero positions."""
    return _positions(_matrix(spark, sf_dir))


def feature_sparse(spark, sf_dir):
    """Every set cell of all item vectors."""
    cells = features.sparse_cells(features.sparse_features(_aligned(spark, sf_dir), 7))
    return cells.withColumn("value", F.round(F.col("value").cast("double"), 3))


def feature_dense_view(spark, sf_dir):
    """The sparse vectors, stored and brought back to full width."""
    sparse = features.sparse_features(_aligned(spark, sf_dir), 7)
    return _positions(features.dense_view(replace(sparse, features=spool(sparse.features, "sparse-features"))))


def feature_sparse_stats(spark, sf_dir):
    return features.sparse_stats(features.sparse_features(_aligned(spark, sf_dir, broadcast_rows=0), 7, **SALTED))


def feature_stats(spark, sf_dir):
    return features.matrix_stats(_matrix(spark, sf_dir))


# -- checks and fingerprints ------------------------------------------------------------------


def quality_checks(spark, sf_dir):
    """Every check, on tables that break some of them."""
    events = fx.click_events(spark, sf_dir)
    items = fx.catalog_items(spark, sf_dir)
    smap, pairs = fx.part_map(spark, sf_dir)
    faulty = events.select(
        F.col("event_id").alias("sid"),
        F.when(F.col("event_type") != "error", F.col("canonical_listing_id")).alias(
            "canonical_listing_id"
        ),
        (F.length("item_id") - 2).alias("intensity"),
    )
    conflicting = events.select(
        F.length("canonical_listing_id").alias("sid"), "canonical_listing_id"
    ).distinct()
    suppliers = fx.table(spark, sf_dir, "lineitem").select(
        fx.text("l_suppkey").alias("canonical_listing_id"), "l_suppkey"
    )
    no_prefix = events.select(
        F.col("event_id").alias("sid"), F.concat(F.lit("x"), "item_id").alias("canonical_listing_id")
    )
    expected = fx.table(spark, sf_dir, "nation").select(
        F.concat(F.lit("r"), fx.text("n_nationkey")).alias("region")
    )
    matrix = features.matrix_stats(_matrix(spark, sf_dir))
    known = {name: code for name, code in fx.EVENT_CODES.items() if name != "error"}
    return checks.all_checks(
        [
            checks.unknown_behaviors(events, codes=known),
            checks.bad_intensity(faulty),
            checks.smap_not_contiguous(smap.withColumn("dense_id", F.col("dense_id") + 1)),
            checks.sids_not_in_events(smap, conflicting),
            checks.items_not_in_catalog(no_prefix, items),
            checks.duplicate_canonicals(suppliers),
            checks.null_event_keys(faulty),
            checks.sid_conflicts(conflicting),
            checks.empty_regions(expected, events),
            checks.no_rows(events),
            checks.target_absent(events, "refund", "event_type"),
            checks.matrix_invariants(matrix),
        ]
    ).select("check_name", "violations", F.array_join("examples", "|").alias("examples"))


def fingerprint(spark, sf_dir):
    """States of line items by load, whether they add up to that of the table, and what a change does to them."""
    lines = fx.table(spark, sf_dir, "lineitem")
    touched = (F.col("l_orderkey") % 97 == 5) & (F.col("l_linenumber") == 1)
    each = fingerprints.row_hash(lines)
    hashed = lines.withColumn("hash", each)
    hashed = hashed.withColumn("l_tax", F.when(~touched, F.col("l_tax"))).withColumn("changed_hash", each)
    states = [
        column.alias(f"{prefix}{name}")
        for prefix in ("", "changed_")
        for name, column in fingerprints.digests(F.col(f"{prefix}hash")).items()
    ]
    loads = hashed.groupBy("l_returnflag").agg(*states)
    whole = fingerprints.scanned_state(lines)
    found = F.lit(False)
    for name in fingerprints.STATE:
        found = found | (F.col(name) != F.col(f"changed_{name}"))
    together = Window.partitionBy()  # a row per load
    adds_up = F.lit(True)
    for name, column in fingerprints.merged_digests().items():
        adds_up = adds_up & (column.over(together) == getattr(whole, name))
    return loads.select(F.col("l_returnflag").alias("load"), "rows", adds_up.alias("adds_up"), found.alias("change_found"))


def fingerprint_portable(spark, sf_dir):
    return fingerprints.portable(fx.table(spark, sf_dir, "lineitem"))


def pruned_pairs(spark, sf_dir):
    """Column-pruned scan of session events: two columns, merged per task."""
    events = fx.table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("sid"), fx.text("l_suppkey").alias("canonical_listing_id")
    )
    return features.sid_to_canonical(events)


REGISTRY: dict[str, Query] = {
    "q_clean_numeric": clean_numeric,
    "q_clean_int": clean_int,
    "q_clean_dates": clean_dates,
    "q_blank_ids": blank_ids,
    "q_epoch_ms": epoch_ms,
    "q_geo_cells": geo_cells,
    "q_market_segment": market_segment,
    "q_latest_listing": latest_listing,
    "q_listing_id_map": listing_id_map,
    "q_regional_listing_ids": regional_listing_ids,
    "q_unique_items": unique_items,
    "q_events_join_catalog": events_join_catalog,
    "q_events_join_catalog_salted": events_join_catalog_salted,
    "q_run_collapse": run_collapse,
    "q_run_collapse_hot": run_collapse_hot,
    "q_session_length": session_length,
    "q_session_length_long": session_length_long,
    "q_rare_items": rare_items,
    "q_rare_items_salted": rare_items_salted,
    "q_item_support": item_support,
    "q_session_chain": session_chain,
    "q_session_chain_hot": session_chain_hot,
    "q_dense_session_ids": dense_session_ids,
    "q_region_merge": region_merge,
    "q_merge_stats": merge_stats,
    "q_enriched_events": enriched_events,
    "q_min_events": min_events,
    "q_positions_hot": positions_hot,
    "q_densify": densify,
    "q_densify_salted": densify_salted,
    "q_dataset_maps": dataset_maps,
    "q_holdout_split": holdout_split,
    "q_split_stats": split_stats,
    "q_sequences": sequences,
    "q_sequences_chunked": sequences_chunked,
    "q_list_parse": list_parse,
    "q_vocabulary": vocabulary,
    "q_topk_amenities": topk_amenities,
    "q_hash_bucket": hash_buckets,
    "q_item_alignment": item_alignment,
    "q_feat_log": feat_log,
    "q_feat_count": feat_count,
    "q_feat_coord": feat_coord,
    "q_feat_onehot": feat_onehot,
    "q_feat_onehot_salted": feat_onehot_salted,
    "q_feat_amenity": feat_amenity,
    "q_feat_hash": feat_hash,
    "q_feature_columns": feature_columns,
    "q_feature_matrix": feature_matrix,
    "q_feature_stats": feature_stats,
    "q_feature_sparse": feature_sparse,
    "q_feature_dense_view": feature_dense_view,
    "q_feature_sparse_stats": feature_sparse_stats,
    "q_checks": quality_checks,
    "q_fingerprint": fingerprint,
    "q_fingerprint_portable": fingerprint_portable,
    "q_item_columns": item_columns,
    "q_regional_loads": regional_loads,
    "q_united_loads": united_loads,
    "q_source_layout": source_layout,
    "q_overwrite_guard": overwrite_guard,
    "q_parameter_bounds": parameter_bounds,
    "q_regional_scan": regional_scan,
    "q_load_metrics": load_metrics,
    "q_incremental_load": incremental_load,
    "q_sorted_sink": sorted_sink,
    "q_run_collapse_untimed": run_collapse_untimed,
    "q_run_collapse_untimed_hot": run_collapse_untimed_hot,
    "q_pruned_pairs": pruned_pairs,
}
