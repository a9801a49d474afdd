"""Item features: vectors of three known items and the job's checks."""

import ast
import hashlib
import math

import pytest
from pyspark.sql import functions as F

from seqprep import contract
from seqprep.operators import checks, features
from seqprep.plans.item_features import export_item_features
from seqprep.plans.preprocess import SCHEMA, load_smap
from seqprep.sources import fingerprints, manifest, tables
from seqprep.sources.spool import spool

EVENT_SCHEMA = "uid long, sid long, canonical_listing_id string, event_type string, timestamp long, intensity long"
EVENTS = [
    (7, 41, "attic-2", "ListingRendered", 50, 2),
    (7, 12, "house-8", "LeadClicked", 55, 1),
    (9, 30, "field-5", "ListingRendered", 61, 4),
    (9, 41, "attic-2", "ListingRendered", 64, 1),
    (9, 12, "house-8", "ListingRendered", 70, 1),
]
SMAP = [(12, 1), (30, 2), (41, 3)]
ITEM_SCHEMA = (
    "canonical_listing_id string, listing_id_numeric long, lat_region string, lon_region string, zip_code string,"
    " neighborhood string, usable_areas double, total_areas double, bedrooms int, bathrooms int, suites int,"
    " parking_spaces int, price double, unit_type string, amenities string, business_type string,"
    " usage_type string, h3_res6 long, h3_res7 long"
)
# One field is NULL or out of range wherever a missing indicator is to be seen.
ITEMS = [
    ("house-8", 8001, "-27.59", "-48.54", " 88010-400", "Trindade", 210.5, 360.0, 4, 3, 2, 2, 985500.0,
     "HOME", "['GARDEN', 'GARAGE', 'BARBECUE']", "SALE", "RESIDENTIAL", 71, 72),
    ("attic-2", 2002, "-25.42", "-49.27", "80420090", "Batel", 46.0, None, 1, 1, 0, None, 2750.0,
     "PENTHOUSE", "['GARAGE']", "RENTAL", "RESIDENTIAL", 81, None),
    ("field-5", 5005, None, "nan", None, " ", None, 5000.0, None, 0, 0, 0, None,
     "RESIDENTIAL_ALLOTMENT_LAND", None, "SALE", "COMMERCIAL", 91, 92),
]


def _write_dataset(spark, path, smap):
    smap = spark.createDataFrame(smap, "sid long, dense_id int")
    sequences = spark.createDataFrame([(1, "train", [1, 2])], "user int, split string, items array<int>")
    tables.write_table(smap, f"{path}/smap")
    tables.write_table(sequences, f"{path}/sequences")
    content = {
        "schema": SCHEMA,
        "smap": fingerprints.scanned_state(smap).text,
        "sequences": fingerprints.scanned_state(sequences).text,
        "sequence_files": fingerprints.file_state(spark, f"{path}/sequences"),
    }
    manifest.write_manifest(spark, f"{path}/manifest", content)


@pytest.fixture
def source(spark, tmp_path):
    def write(events=EVENTS, items=ITEMS, smap=SMAP):
        tables.write_table(spark.createDataFrame(events, EVENT_SCHEMA), f"{tmp_path}/work/events.parquet", force=True)
        tables.write_table(spark.createDataFrame(items, ITEM_SCHEMA), f"{tmp_path}/work/items.parquet", force=True)
        _write_dataset(spark, f"{tmp_path}/dataset", list(smap))
        return lambda **options: export_item_features(
            spark, f"{tmp_path}/dataset", f"{tmp_path}/work", f"{tmp_path}/out", **options
        )

    return write


def _matrix(spark, tmp_path):
    names = {r["name"]: r["position"] for r in spark.read.parquet(f"{tmp_path}/out/feature_columns").collect()}
    rows = {r["dense_id"]: r["features"] for r in spark.read.parquet(f"{tmp_path}/out/item_features").collect()}
    return names, rows


def test_aligned_matrix(spark, source, tmp_path):
    content = source()()
    names, rows = _matrix(spark, tmp_path)
    assert sorted(rows) == [0, 1, 2, 3] and content["items"] == 3 and content["vectors"] == 4
    assert sorted(names.values()) == list(range(content["width"]))
    assert {len(row) for row in rows.values()} == {content["width"]}
    assert all(math.isfinite(value) for row in rows.values() for value in row)
    assert not any(rows[0])

    listed = {number: next(row for row in ITEMS if row[0] == name) for number, name in ((1, "house-8"), (2, "field-5"), (3, "attic-2"))}
    field = {part.split()[0]: place for place, part in enumerate(ITEM_SCHEMA.split(", "))}
    for number, row in listed.items():
        for name in contract.LOG_FEATURES:
            value = row[field[name]]
            assert rows[number][names[f"log1p_{name}"]] == pytest.approx(math.log1p(value or 0.0), rel=1e-6)
            assert rows[number][names[f"missing_{name}"]] == float(value is None)
        for name in contract.COUNT_FEATURES:
            assert rows[number][names[f"missing_{name}"]] == float(row[field[name]] is None)
        for name, width in contract.HASHED_FEATURES.items():
            text = str(row[field[name]]).strip() if row[field[name]] is not None else ""
            slots = [rows[number][names[f"{name}_hash_{slot}"]] for slot in range(width)]
            expected = int.from_bytes(hashlib.sha256(text.encode()).digest()[:8], "big") % width
            assert slots == [float(bool(text) and slot == expected) for slot in range(width)]
            assert rows[number][names[f"missing_{name}"]] == float(not text)
        known = set(ast.literal_eval(row[field["amenities"]] or "[]"))
        assert {name[8:] for name in names if name.startswith("amenity=") and rows[number][names[name]]} == known
        segment = f"{row[field['business_type']]}_{row[field['usage_type']]}"
        assert rows[number][names[f"market_segment={segment}"]] == 1.0
    assert [rows[number][names["missing_latitude"]] for number in (1, 2, 3)] == [0.0, 1.0, 0.0]
    assert rows[3][names["longitude"]] == pytest.approx(-49.27)


def test_sparse_layout_holds_the_cells_of_the_dense_one(spark, source, tmp_path):
    export = source()
    dense = export()
    names, rows = _matrix(spark, tmp_path)
    sparse = export(force=True, layout="sparse")
    assert (sparse["width"], sparse["vectors"], sparse["items"]) == (dense["width"], dense["vectors"], dense["items"])
    stored = spark.read.parquet(f"{tmp_path}/out/item_features")
    columns = spark.read.parquet(f"{tmp_path}/out/feature_columns")
    assert {r["name"]: r["position"] for r in columns.collect()} == names
    found = {r["dense_id"]: (r["indices"], r["values"]) for r in stored.collect()}
    for number, row in rows.items():
        places = [place for place, value in enumerate(row) if value]
        assert found[number] == (places, [row[place] for place in places])
    result = features.SparseFeatures(stored, columns, sparse["width"])
    assert {r["dense_id"]: r["features"] for r in features.dense_view(result).features.collect()} == rows
    with pytest.raises(ValueError, match="dense or sparse"):
        export(force=True, layout="wide")


def test_sparse_stats_tell_positions_out_of_order_or_range(spark):
    rows = [(0, [], []), (1, [0, 4], [1.0, 2.0]), (2, [4, 0], [1.0, 1.0]), (3, [5], [1.0]), (4, [1], [float("nan")]), (5, [1], [0.0])]
    table = spark.createDataFrame(rows, "dense_id int, indices array<int>, values array<float>")

    def stats(wanted):
        result = features.SparseFeatures(table.filter(wanted), None, 5)
        found = features.sparse_stats(result).first()
        return found["min_width"], found["max_width"], found["not_finite"], found["padding_not_zero"]

    assert stats("dense_id < 2") == (5, 5, 0, 0)
    assert stats("dense_id = 2") == stats("dense_id = 3") == (-1, -1, 0, 0)
    assert stats("dense_id in (1, 2)")[:2] == (-1, 5)
    assert stats("dense_id > 3") == (5, 5, 2, 0)


def test_sparse_rows_do_not_grow_with_a_vocabulary(spark):
    items = spark.range(1, 2001).selectExpr(
        "cast(id as int) AS dense_id", "concat('type ', id) AS unit_type", "'SALE' AS business_type",
        "'RESIDENTIAL' AS usage_type", "array('GARAGE', NULL, 'GARAGE') AS amenity_list",
    )
    result = features.sparse_features(features.catalog_with_segment(items.withColumn("canonical_listing_id", F.lit("x"))))
    sizes = result.features.filter("dense_id > 0").select(F.size("indices").alias("n")).distinct().collect()
    assert result.dimensions > 2000 and len(sizes) == 1 and sizes[0]["n"] < 30
    assert features.sparse_cells(result).filter("name = 'amenity=GARAGE' AND value = 1").count() == 2000


def test_block_order_and_vocabulary_order(spark, source, tmp_path):
    source()()
    names, _ = _matrix(spark, tmp_path)
    ordered = sorted(names, key=names.get)
    assert ordered[:6] == ["log1p_price", "missing_price", "log1p_usable_areas", "missing_usable_areas", "log1p_total_areas", "missing_total_areas"]
    assert ordered[14:20] == ["latitude", "longitude", "missing_latitude", "missing_longitude", "business_type=SALE", "business_type=RENTAL"]
    assert ordered.index("amenity=GARAGE") < ordered.index("amenity=BARBECUE") < ordered.index("amenity=GARDEN") < ordered.index("missing_zip_code")
    assert ordered[-1] == "h3_res7_hash_63"
    assert len(ordered) == 214 + 2 + 2 + 3 + 3 + 3


def test_absent_columns_are_missing_everywhere(spark, source):
    events = spark.createDataFrame(EVENTS, EVENT_SCHEMA)
    items = spark.createDataFrame(ITEMS, ITEM_SCHEMA).select("canonical_listing_id", "business_type", "usage_type")
    smap = spark.createDataFrame(SMAP, "sid long, dense_id int")
    aligned = features.align_items(smap, features.sid_to_canonical(events), items)
    result = features.feature_matrix(aligned)
    cells = features.long_features(result, F.col("name").startswith("missing_"))
    assert {r["value"] for r in cells.filter("dense_id > 0").collect()} == {1.0}
    assert result.dimensions == 214 + 2 + 2 + 3
    assert features.matrix_stats(result).first()["padding_not_zero"] == 0


def test_without_amenities(spark, source, tmp_path):
    source()(amenities_top=0)
    assert not any(name.startswith("amenity=") for name in _matrix(spark, tmp_path)[0])


def test_top_amenities_cut_by_count_then_text(spark):
    df = spark.createDataFrame([(["B", "A", "A"],), (["C", "B"],), ([],)], "amenity_list array<string>")
    assert [tuple(r) for r in features.top_amenities(df, 2).orderBy("rank").collect()] == [("A", 2, 1), ("B", 2, 2)]


def test_repeated_item_counts_once_per_dense_id(spark):
    """One listing known under two sids fills two rows and counts twice in the vocabulary."""
    items = spark.createDataFrame(ITEMS, ITEM_SCHEMA)
    smap = spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "sid long, dense_id int")
    pairs = spark.createDataFrame([(1, "attic-2"), (2, "attic-2"), (3, "house-8")], "sid long, canonical_listing_id string")
    aligned = features.align_items(smap, pairs, items)
    ranks = {(r["column"], r["value"]): (r["count"], r["rank"]) for r in features.vocabularies(aligned, ["unit_type"]).collect()}
    assert ranks == {("unit_type", "PENTHOUSE"): (2, 1), ("unit_type", "HOME"): (1, 2)}


def test_no_overwrite_without_force(spark, source):
    export = source()
    first = export()
    with pytest.raises(FileExistsError):
        export()
    assert export(force=True)["fingerprints"] == first["fingerprints"]


def test_item_missing_from_catalogue(source):
    export = source(items=ITEMS[:2])
    with pytest.raises(ValueError, match="catalogue lacks.*field-5"):
        export()


def test_duplicate_catalogue_id(source):
    export = source(items=[*ITEMS, ITEMS[0]])
    with pytest.raises(ValueError, match="several rows.*house-8"):
        export()


def test_sid_with_two_canonical_ids(source):
    export = source(events=[(1, 30, "house-8", "x", 0, 1), (2, 30, "attic-2", "x", 1, 1)], smap=[(30, 1)])
    with pytest.raises(ValueError, match="several listings"):
        export()


def test_smap_sid_missing_from_events(source):
    export = source(smap=[(12, 1), (30, 2), (500, 3)])
    with pytest.raises(ValueError, match="no event has.*500"):
        export()


def test_null_keys_in_events(source):
    export = source(events=[*EVENTS, (1, None, "house-8", "x", 0, 1)])
    with pytest.raises(ValueError, match="without item keys"):
        export()


@pytest.mark.parametrize(
    "smap,bad",
    [
        (SMAP, 0),
        ([(4, 2), (6, 1)], 0),
        ([(4, 1), (6, 4)], 1),
        ([(4, 1), (4, 2)], 1),
        ([(4, 1), (6, 1)], 1),
        ([(4, 0), (6, 1)], 1),
        ([], 1),
    ],
)
def test_smap_must_be_contiguous(spark, smap, bad):
    df = spark.createDataFrame(smap, "sid long, dense_id int")
    assert checks.smap_not_contiguous(df).first()["violations"] == bad
    if bad:
        with pytest.raises(ValueError, match="1 to n"):
            checks.enforce([checks.smap_not_contiguous(df)])


def test_manifest_names_its_inputs(spark, source, tmp_path):
    export = source()
    plain = export()["fingerprints"]
    assert plain["session_events"].startswith("files-") and plain["catalogue"].startswith("files-")
    events, items = (tables.read_table(spark, f"{tmp_path}/work/{name}.parquet") for name in ("events", "items"))
    states = {f"{name}.parquet": fingerprints.scanned_state(df) for name, df in (("events", events), ("items", items))}
    manifest.record_states(spark, f"{tmp_path}/work", states)
    content = export(force=True)
    assert content["fingerprints"]["session_events"] == states["events.parquet"].text
    vectors = tables.read_table(spark, f"{tmp_path}/out/item_features")
    assert content["fingerprints"]["vectors"] == fingerprints.scanned_state(vectors).text
    assert manifest.read_manifest(spark, f"{tmp_path}/out/manifest")["fingerprints"] == content["fingerprints"]
    tables.write_table(items.limit(2), f"{tmp_path}/work/items.parquet.new")
    changed = tables.read_table(spark, f"{tmp_path}/work/items.parquet.new").unionByName(spool(items, "items").limit(1))
    tables.write_table(changed, f"{tmp_path}/work/items.parquet", force=True)
    assert manifest.recorded_state(spark, f"{tmp_path}/work", "items.parquet").startswith("files-")


def test_map_of_another_dataset(spark, source, tmp_path):
    export = source()
    changed = spark.createDataFrame([(1, "train", [1, 2, 3])], "user int, split string, items array<int>")
    tables.write_table(changed, f"{tmp_path}/dataset/sequences", force=True)
    with pytest.raises(ValueError, match="not those of the manifest"):
        export()


def test_changed_or_missing_map(spark, source, tmp_path):
    source()
    smap = spark.createDataFrame([(12, 2), (30, 1), (41, 3)], "sid long, dense_id int")
    tables.write_table(smap, f"{tmp_path}/dataset/smap", force=True)
    with pytest.raises(ValueError, match="not that of the manifest"):
        load_smap(spark, f"{tmp_path}/dataset")
    with pytest.raises(FileNotFoundError, match="run preprocess"):
        load_smap(spark, f"{tmp_path}/nothing")


def test_rows_changed_behind_the_file_list(spark, source, tmp_path):
    """With the same file list only ``deep`` sees that the manifest speaks of other rows."""
    source()
    path = f"{tmp_path}/dataset/manifest"
    content = manifest.read_manifest(spark, path)
    manifest.write_manifest(spark, path, content | {"sequences": "1-2-3-4"}, force=True)
    assert load_smap(spark, f"{tmp_path}/dataset").count() == 3
    with pytest.raises(ValueError, match="not those of the manifest"):
        load_smap(spark, f"{tmp_path}/dataset", deep=True)


def _state(df):
    return fingerprints.scanned_state(df).text


def test_states_ignore_layout_but_not_rows(spark):
    df = spark.createDataFrame([(n, str(n)) for n in range(500)], "a long, b string")
    same = df.repartition(7).select("b", "a")
    assert _state(df) == _state(same)
    assert _state(df) != _state(df.union(df.limit(1))) != _state(df.union(df.limit(1)).union(df.limit(1)))
    assert _state(df.limit(0)) == fingerprints.TableState().text == "0-0-0-0"


def test_states_of_loads_add_up(spark, tmp_path):
    df = spark.createDataFrame([(n, str(n % 7) if n % 5 else None) for n in range(300)], "a long, b string")
    parts = [df.filter(f"a % 3 = {n}") for n in range(3)]
    written = [tables.write_hashed(part, f"{tmp_path}/{n}") for n, part in enumerate(parts)]
    assert [state.rows for state in written] == [100] * 3
    assert sum(written, fingerprints.TableState()) == fingerprints.scanned_state(df)
    merged = fingerprints.scan(df.withColumn("c", df.a % 3), ["c"]).agg(*(c.alias(n) for n, c in fingerprints.merged_digests().items()))
    assert fingerprints.state_of(merged.first()).rows == 300
    sorted_state = tables.write_sorted(df, f"{tmp_path}/s", "a", ["b"], 5)
    assert sorted_state == fingerprints.scanned_state(tables.read_table(spark, f"{tmp_path}/s"))
    assert tables.write_hashed(df.limit(0), f"{tmp_path}/none") == fingerprints.TableState()


def test_states_tell_nulls_names_and_types_apart(spark):
    def text(sql):
        return _state(spark.sql(f"SELECT {sql}"))

    assert text("1 AS a, CAST(NULL AS INT) AS b") != text("CAST(NULL AS INT) AS a, 1 AS b")
    assert text("1 AS x, 2 AS y") != text("1 AS p, 2 AS q")
    assert text("1 AS x") != text("1L AS x") != text("'1' AS x")
    assert text("'a' AS x, 'bc' AS y") != text("'ab' AS x, 'c' AS y")
    assert text("CAST(NULL AS STRING) AS x") != text("'-' AS x")
    many = ", ".join(f"CAST(NULL AS INT) AS c{n}" for n in range(70))
    assert text(many) != text(many.replace("CAST(NULL AS INT) AS c65", "0 AS c65"))
    assert text("map('a', 1) AS m") != text("map('a', 2) AS m") and text("array(1, NULL) AS v") == text("array(1, NULL) AS v")


def test_file_states(spark, tmp_path):
    tables.write_table(spark.range(10), f"{tmp_path}/t")
    first = fingerprints.file_state(spark, f"{tmp_path}/t")
    assert first == fingerprints.file_state(spark, f"{tmp_path}/t")
    tables.write_table(spark.range(10), f"{tmp_path}/t", force=True)
    assert fingerprints.file_state(spark, f"{tmp_path}/t") != first
