"""Sequence dataset operators on literal rows."""

import pytest
from pyspark.sql import functions as F

from seqprep.operators import checks, dataset

ITEM_SCHEMA = "canonical_listing_id string, business_type string, usage_type string, lat_region string, lon_region string"


def _events(spark, rows):
    """Rows of (uid, sid, item, type, timestamp, pos)."""
    df = spark.createDataFrame(rows, "uid long, sid long, canonical_listing_id string, event_type string, timestamp long, pos long")
    return df.withColumn("intensity", F.col("pos") + 10)


@pytest.fixture
def items(spark):
    return spark.createDataFrame(
        [("A", "SELL", "RESIDENTIAL", "-20.5", "-43.5"), ("B", None, "COMMERCIAL", "abc", None)], ITEM_SCHEMA
    )


ROWS = [
    (5, 30, "A", "ListingRendered", 1, 1), (5, 20, "B", "ShareClicked", 2, 2), (5, 10, "C", "LeadClicked", 3, 3),
    (9, 30, "A", "LeadClicked", 1, 1), (9, 30, "A", "ListingRendered", 1, 2), (9, 20, "B", "ListingRendered", 1, 3),
    (7, 40, "A", "LeadClicked", 1, 1), (7, 40, "A", "GalleryClicked", 2, 2),
]


def test_uncatalogued_items_get_defaults(spark, items):
    frame = dataset.model_frame(_events(spark, ROWS), items)
    found = {(r["sid"], r["market_segment"], r["latitude"], r["longitude"]) for r in frame.collect()}
    assert found == {(30, "SALE_RESIDENTIAL", -20.5, -43.5), (20, "NONE_COMMERCIAL", 0.0, 0.0), (10, "OTHER", 0.0, 0.0), (40, "SALE_RESIDENTIAL", -20.5, -43.5)}


@pytest.mark.parametrize("limits", [{}, {"broadcast_rows": 0, "group_rows": 2}], ids=["plain", "skewed"])
def test_dataset(spark, items, limits):
    built = dataset.build_dataset(_events(spark, ROWS).repartition(4), items, 3, **limits)
    sequences = {
        (r["user"], r["split"]): (r["items"], r["behaviors"], r["intensity"], r["segments"], r["latitudes"])
        for r in built.sequences.collect()
    }
    # User 7 is too short, so item 40 is not in the map; only a last target event is held out.
    assert sequences == {
        (1, "train"): ([3, 2], [2, 5], [11, 12], [3, 1], [-20.5, 0.0]),
        (1, "val"): ([1], [8], [13], [2], [0.0]),
        (2, "train"): ([3, 3, 2], [8, 2, 2], [11, 12, 13], [3, 3, 1], [-20.5, -20.5, 0.0]),
    }
    assert {tuple(r) for r in built.umap.collect()} == {(5, 1), (9, 2)}
    assert {tuple(r) for r in built.smap.collect()} == {(10, 1), (20, 2), (30, 3)}
    assert {tuple(r) for r in built.bmap.collect()} == {("ListingRendered", 2), ("ShareClicked", 5), ("LeadClicked", 8)}
    assert {tuple(r) for r in built.segmap.collect()} == {("NONE_COMMERCIAL", 1), ("OTHER", 2), ("SALE_RESIDENTIAL", 3)}
    stats = dataset.split_stats(built.rows).first()
    assert (stats["sessions"], stats["items"], stats["rows"], stats["val_num"], stats["behaviors"]) == (2, 3, 6, 1, [2, 5, 8])


def test_long_sequences_continue_in_chunks(spark, items):
    rows = [(1, n % 5, "A", "ListingRendered", n, n) for n in range(1, 1001)]
    built = dataset.build_dataset(_events(spark, rows).repartition(6), items, 3, chunk_rows=64, group_rows=100)
    chunks = built.sequences.orderBy("chunk").collect()
    assert [r["chunk"] for r in chunks] == list(range(16))
    assert max(len(r["items"]) for r in chunks) == 64
    assert [value - 10 for r in chunks for value in r["intensity"]] == list(range(1, 1001))


def test_position_decides_the_last_event_within_a_second(spark, items):
    rows = [(1, 1, "A", "LeadClicked", 5, 2), (1, 2, "A", "ListingRendered", 5, 1), (1, 3, "B", "ListingRendered", 4, 0)]
    built = dataset.build_dataset(_events(spark, rows), items, 2)
    val = built.sequences.filter("split = 'val'").first()
    assert val["behaviors"] == [8]


def test_parameter_bounds(spark, items):
    events = _events(spark, ROWS)
    with pytest.raises(ValueError, match="at least 2"):
        dataset.build_dataset(events, items, 1)
    with pytest.raises(ValueError, match="target behavior is unknown"):
        dataset.build_dataset(events, items, 3, "Bought")
    with pytest.raises(ValueError, match="events: no column sid, intensity"):
        dataset.model_frame(events.drop("sid", "intensity"), items)


def test_unknown_behavior_and_missing_target(spark):
    events = _events(spark, [(1, 1, "A", "Bought", 1, 1), (1, 1, "A", None, 2, 1)])
    with pytest.raises(checks.CheckFailed, match="outside the code table: 2 violation.*Bought"):
        checks.enforce([checks.unknown_behaviors(events)])
    with pytest.raises(checks.CheckFailed, match="target behaviour"):
        checks.enforce([checks.target_absent(events, "LeadClicked", "event_type")])


@pytest.mark.parametrize("value,bad", [("1", 0), ("0", 0), ("-1", 1), ("nan", 1), ("inf", 1), (None, 1)])
def test_intensity_check(spark, value, bad):
    df = spark.createDataFrame([(value,)], "intensity string").select(F.col("intensity").try_cast("double"))
    assert checks.bad_intensity(df).first()["violations"] == bad


def test_val_is_chunk_zero_at_any_chunk_size(spark, items):
    rows = [(1, n % 3, "A", "LeadClicked" if n == 9 else "ListingRendered", n, n) for n in range(1, 10)]
    built = dataset.build_dataset(_events(spark, rows), items, 3, chunk_rows=4)
    found = {(r["split"], r["chunk"]): len(r["items"]) for r in built.sequences.collect()}
    assert found == {("train", 0): 4, ("train", 1): 4, ("val", 0): 1}
