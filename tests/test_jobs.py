"""The jobs from CSV files to feature vectors."""

import csv
import gzip
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from seqprep.plans.convert import convert
from seqprep.plans.item_features import export_item_features
from seqprep.plans.preprocess import preprocess
from seqprep.sources import manifest, raw, tables
from seqprep.sources.spool import shared_folder, spool, spool_scope

LISTING_HEADER = ["anonymized_listing_id", "status", "updated_at", "lat_region", "lon_region", "business_type", "usage_type", "price"]
EVENT_HEADER = ["anonymized_listing_id", "anonymized_session_id", "collector_timestamp", "event_type"]


def _write(path: Path, header, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt", newline="") as stream:
        writer = csv.writer(stream)
        writer.writerow(header)
        writer.writerows(rows)


def _listing(name, status="ACTIVE", updated="2024-01-01 00:00:00", price="R$ 1000"):
    return [name, status, updated, "-20.5", "-43.5", "SALE", "RESIDENTIAL", price]


def _session(session, *events, start=1_700_000_000_000):
    return [[item, session, str(start + 1500 * place), kind] for place, (item, kind) in enumerate(events)]


@pytest.fixture
def data(tmp_path):
    root = tmp_path / "raw"
    _write(root / "listings/mg/a.csv.gz", LISTING_HEADER, [
        _listing("L1"), _listing("L1", updated="2024-02-01 00:00:00", price="R$ 2000"),
        _listing("L2"), _listing("L3", status="INACTIVE"), _listing("L4"),
    ])
    _write(root / "listings/es_bh/a.csv.gz", [*LISTING_HEADER, "unit_type"], [[*_listing("L1", price="9"), "HOME"], [*_listing("L9"), "FLAT"]])
    render, lead = "ListingRendered", "LeadClicked"
    _write(root / "events/mg/a.csv.gz", EVENT_HEADER, [
        *_session("s1", ("L1", render), ("L1", render), ("L2", render), ("L1", lead)),
        *_session("s2", ("L2", render), ("L3", render), ("L1", render), ("L2", lead), ("L1", "Unknown")),
        *_session("s3", ("L4", render), ("L1", render)),
    ])
    _write(root / "events/mg/b.csv.gz", EVENT_HEADER, _session("s4", ("L1", lead), ("L2", render), ("L1", render), ("L2", render)))
    _write(root / "events/es_bh/a.csv.gz", EVENT_HEADER, [
        *_session("s1", ("L9", render), ("L1", render), ("L9", lead)),
        *_session("s8", ("L1", render), ("L9", render), ("L1", render)),
    ])
    return root


def _run(spark, data, tmp_path, **options):
    limits = {"min_item_freq": 2, "output_partitions": 3} | options
    return convert(spark, str(data), str(tmp_path / "work"), **limits)


@pytest.mark.parametrize("limits", [{}, {"broadcast_rows": 0, "group_rows": 3}], ids=["plain", "skewed"])
def test_all_jobs(spark, data, tmp_path, limits):
    counts = _run(spark, data, tmp_path, **limits)
    assert counts == {
        "rows": 16, "sessions": 5, "items": 4, "catalog_items": 4, "loaded": ["mg", "es_bh"],
        "stages": {
            "raw_listings": 7, "rejected_listings": 0, "listings": 5,
            "raw_events": 21, "rejected_events": 0, "events": 19, "session_events": 16,
        },
    }

    events = spark.read.parquet(f"{tmp_path}/work/events.parquet")
    rows = {
        (r["uid"], r["pos"]): (r["sid"], r["canonical_listing_id"], r["intensity"])
        for r in events.collect()
    }
    # mg first: sessions s1, s2, s4 and items L1, L2; then es_bh: s1, s8 and L1, L9.
    assert rows[(1, 1)] == (1, "L1", 2) and rows[(2, 1)] == (2, "L2", 1)
    assert rows[(4, 1)] == (4, "L9", 1) and rows[(5, 1)] == (3, "L1", 1)
    items = {r["canonical_listing_id"]: r for r in spark.read.parquet(f"{tmp_path}/work/items.parquet").collect()}
    assert sorted(items) == ["L1", "L2", "L4", "L9"]
    assert items["L1"]["price"] == 2000.0 and items["L1"]["unit_type"] is None
    assert items["L9"]["unit_type"] == "FLAT" and items["L9"]["h3_res6"] > 0

    made = preprocess(spark, f"{tmp_path}/work", f"{tmp_path}/dataset", 3, **limits)
    assert (made["sessions"], made["items"], made["rows"], made["val_num"]) == (5, 4, 16, 3)
    sequences = {(r["user"], r["split"]): r["items"] for r in spark.read.parquet(f"{tmp_path}/dataset/sequences").collect()}
    assert sequences[(1, "train")] == [1, 2] and sequences[(1, "val")] == [1]
    assert (3, "val") not in sequences and len(sequences[(3, "train")]) == 4
    with pytest.raises(FileExistsError):
        preprocess(spark, f"{tmp_path}/work", f"{tmp_path}/dataset", 3)

    exported = export_item_features(spark, f"{tmp_path}/dataset", f"{tmp_path}/work", f"{tmp_path}/features", **limits)
    assert exported["items"] == 4 and exported["vectors"] == 5


def test_resume_reloads_only_what_changed(spark, data, tmp_path):
    first = _run(spark, data, tmp_path)
    assert _run(spark, data, tmp_path) == first | {"loaded": [], "stages": {}}
    extra = _session("s5", ("L1", "ListingRendered"), ("L9", "ListingRendered"), ("L1", "LeadClicked"))
    _write(data / "events/es_bh/b.csv.gz", EVENT_HEADER, extra)
    second = _run(spark, data, tmp_path)
    assert second["loaded"] == ["es_bh"] and second["sessions"] == first["sessions"] + 1
    third = _run(spark, data, tmp_path, regions=["mg"], min_session_length=4)
    assert third["loaded"] == ["mg"] and third["sessions"] == 1


def test_only_the_stages_that_changed_run_again(spark, data, tmp_path):
    _run(spark, data, tmp_path)
    fewer = _run(spark, data, tmp_path, min_item_freq=3)
    assert fewer["loaded"] == ["mg", "es_bh"] and set(fewer["stages"]) == {"session_events"}
    _write(data / "events/mg/c.csv.gz", EVENT_HEADER, _session("s9", *[("L1", "LeadClicked"), ("L2", "ListingRendered")] * 3))
    more = _run(spark, data, tmp_path, min_item_freq=3)
    assert more["loaded"] == ["mg"] and set(more["stages"]) == {"raw_events", "rejected_events", "events", "session_events"}


def test_a_region_that_becomes_empty_is_an_error(spark, data, tmp_path):
    _run(spark, data, tmp_path)
    with pytest.raises(ValueError, match="no rows of|without any session"):
        _run(spark, data, tmp_path, min_item_freq=1000)
    short = [_session("t", ("L9", "LeadClicked"))[0]]
    _write(data / "events/es_bh/a.csv.gz", EVENT_HEADER, short)
    with pytest.raises(ValueError, match="without any session.*es_bh"):
        _run(spark, data, tmp_path)


def test_nothing_is_merged_after_a_load_broke_off(spark, data, tmp_path, monkeypatch):
    _run(spark, data, tmp_path)
    _write(data / "listings/mg/a.csv.gz", LISTING_HEADER, [_listing("M1"), _listing("M2")])

    def fails(*args, **options):
        raise OSError("executor lost")

    monkeypatch.setattr("seqprep.plans.convert.load_sessions", fails)
    with pytest.raises(OSError):
        _run(spark, data, tmp_path)
    with pytest.raises(RuntimeError, match=r"not to the end.*\['mg'\]"):
        _run(spark, data, tmp_path, final_only=True)


def test_large_files_are_dealt_out(spark, data, monkeypatch):
    monkeypatch.setattr(raw, "SPREAD_BYTES", 10)
    monkeypatch.setattr(raw, "TASK_BYTES", 50)
    scanned = raw.checked_scan(spark, str(data), raw.EVENT_FOLDERS, ["mg"], EVENT_HEADER, "events input")
    assert scanned.rows.rdd.getNumPartitions() > 2 and scanned.rows.count() == 15


def test_final_only_and_unfinished_regions(spark, data, tmp_path):
    with pytest.raises(RuntimeError, match=r"not to the end.*\['es_bh', 'mg'\]"):
        _run(spark, data, tmp_path, final_only=True)
    done = _run(spark, data, tmp_path, regions=["mg"])
    with pytest.raises(RuntimeError, match=r"\['es_bh'\]"):
        _run(spark, data, tmp_path, final_only=True)
    again = _run(spark, data, tmp_path, regions=["mg"], final_only=True)
    assert again == done | {"loaded": [], "stages": {}}


def test_region_order_decides_the_ids(spark, data, tmp_path):
    _run(spark, data, tmp_path, regions=["es_bh", "mg"])
    events = spark.read.parquet(f"{tmp_path}/work/events.parquet")
    assert events.filter("uid = 1").first()["canonical_listing_id"] in ("L1", "L9")
    items = spark.read.parquet(f"{tmp_path}/work/items.parquet")
    assert items.filter("canonical_listing_id = 'L1'").first()["price"] == 9.0


def test_region_without_sessions(spark, data, tmp_path):
    _write(data / "events/none/a.csv.gz", EVENT_HEADER, _session("s", ("L1", "LeadClicked")))
    _write(data / "listings/none/a.csv.gz", LISTING_HEADER, [_listing("L1")])
    with pytest.raises(ValueError, match="without any session.*none"):
        _run(spark, data, tmp_path, regions=["mg", "none"])


def test_numeric_region_names_stay_text(spark, data, tmp_path):
    for folder in ("listings", "events"):
        for source in (data / folder / "mg").iterdir():
            target = data / folder / "01" / source.name
            target.parent.mkdir(exist_ok=True)
            target.write_bytes(source.read_bytes())
    assert _run(spark, data, tmp_path, regions=["01"])["sessions"] == 3
    assert _run(spark, data, tmp_path, regions=["01"])["loaded"] == []


def test_bad_inputs(spark, data, tmp_path):
    with pytest.raises(FileNotFoundError, match="no .csv.gz files"):
        _run(spark, data, tmp_path, regions=["mg", "sp"])
    with pytest.raises(FileNotFoundError, match="none of the expected source folders"):
        _run(spark, tmp_path / "nowhere", tmp_path)
    for options in ({"regions": []}, {"regions": ["mg", "mg"]}, {"min_session_length": 1}, {"max_session_length": 2}, {"min_item_freq": 0}, {"output_partitions": 0}):
        with pytest.raises(ValueError):
            _run(spark, data, tmp_path, **options)
    _write(data / "events/es_bh/a.csv.gz", EVENT_HEADER[:3], [["a", "s", "1"]])
    with pytest.raises(ValueError, match="events input: no column event_type"):
        raw.checked_scan(spark, str(data), raw.EVENT_FOLDERS, ["es_bh"], EVENT_HEADER, "events input")


def test_other_column_order_fails_instead_of_mixing_columns(spark, data):
    _write(data / "events/mg/b.csv.gz", EVENT_HEADER[::-1], [["LeadClicked", "1", "s", "L1"]])
    scanned = raw.scan_csv(spark, str(data), raw.EVENT_FOLDERS, ["mg"])
    with pytest.raises(Exception, match="(?i)header"):
        scanned.collect()


def test_singular_folder_names(spark, data):
    (data / "events").rename(data / "event")
    assert raw.scan_csv(spark, str(data), raw.EVENT_FOLDERS, ["mg"]).count() == 15


def test_table_sinks(spark, tmp_path):
    df = spark.range(10)
    path = f"{tmp_path}/t"
    assert not tables.table_exists(spark, path)
    tables.write_table(df, path)
    assert tables.table_exists(spark, path)
    with pytest.raises(Exception, match="(?i)exists"):
        tables.write_table(df, path)
    tables.write_table(df.limit(3), path, force=True)
    assert tables.read_table(spark, path).count() == 3
    first, second = spark.range(2).selectExpr("id", "1 AS a"), spark.range(2).selectExpr("id", "2 AS b")
    tables.write_table(first, f"{path}1")
    tables.write_table(second, f"{path}2")
    assert tables.read_tables(spark, [f"{path}1", f"{path}2"]).columns == ["id", "a", "b"]
    written, seen = tables.counted(spark.range(25), "rows")
    tables.write_table(written, f"{path}3")
    assert seen.get["rows"] == 25


def test_sorted_sink_keeps_groups_whole(spark, tmp_path):
    df = spark.range(1000).selectExpr("id % 50 AS uid", "1000 - id AS timestamp")
    tables.write_sorted(df, f"{tmp_path}/s", "uid", ["timestamp"], 5)
    files = sorted(Path(f"{tmp_path}/s").glob("*.parquet"))
    assert len(files) == 5
    keys = [{r["uid"] for r in spark.read.parquet(str(file)).collect()} for file in files]
    assert sum(len(found) for found in keys) == 50
    rows = [tuple(r) for r in spark.read.parquet(str(files[0])).collect()]
    assert rows == sorted(rows)


def test_jobs_empty_their_spools(spark, data, tmp_path):
    _run(spark, data, tmp_path)
    with spool_scope(spark):
        kept = spool(spark.range(1000), "inside")
        folder = Path(kept.inputFiles()[0].removeprefix("file:")).parent
    assert spark.read.parquet(str(folder)).count() == 0
    assert spool(spark.range(7), "after").count() == 7


def test_spools_live_in_the_configured_folder(spark):
    assert shared_folder(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")


def test_lines_that_do_not_parse(spark, data, tmp_path):
    """They stay in the rows, padded or cut, as long as nobody leaves them out, and are told line by line."""
    path = data / "events/mg/broken.csv.gz"
    with gzip.open(path, "wt") as stream:
        stream.write(",".join(EVENT_HEADER) + "\nL1,s1\nL1,s1,1700000009000,ListingRendered,more\n\nL2,s2,1700000009000,LeadClicked\n")
    scan = raw.checked_scan(spark, str(data), raw.EVENT_FOLDERS, ["mg"], EVENT_HEADER, "events input")
    assert len(scan.rows.collect()) == 18 and scan.counts() == {"lines": 18, "rejected": 2, "no_key": 0}
    assert scan.rows.columns == [*EVENT_HEADER, "region"]
    lines = {"L1,s1", "L1,s1,1700000009000,ListingRendered,more"}
    assert {tuple(r) for r in scan.rejects.collect()} == {("mg", "broken.csv.gz", "L1", line) for line in lines}
    strict = raw.checked_scan(spark, str(data), raw.EVENT_FOLDERS, ["mg"], EVENT_HEADER, "events input", keep_rejects=False)
    assert len(strict.rows.collect()) == 16
    assert raw.write_rejects(scan, f"{tmp_path}/rejects", "one") == 2
    assert spark.read.parquet(f"{tmp_path}/rejects/load=one/region=mg").count() == 2


def test_counts_of_every_load_are_kept_by_region(spark, data, tmp_path):
    done = _run(spark, data, tmp_path)
    kept = manifest.metrics(spark, f"{tmp_path}/work/load_metrics")
    sums = {(r["stage"], r["metric"]): r["n"] for r in kept.groupBy("stage", "metric").agg(F.sum("rows").alias("n")).collect()}
    stages = done["stages"]
    assert sums == {
        ("listings", "lines"): stages["raw_listings"], ("listings", "rejected"): stages["rejected_listings"],
        ("listings", "listings"): stages["listings"], ("events", "lines"): stages["raw_events"],
        ("events", "rejected"): stages["rejected_events"], ("events", "events"): stages["events"],
        ("sessions", "session_events"): stages["session_events"],
    }
    stored = spark.read.parquet(f"{tmp_path}/work/listings_processed").groupBy("region").count().collect()
    found = kept.filter("metric = 'listings'").collect()
    assert {r["region"]: r["rows"] for r in found} == {r["region"]: r["count"] for r in stored}
    recorded = manifest.stage_loads(spark, f"{tmp_path}/work/loads")
    assert {(r["region"], r["stage"], r["load"]) for r in kept.collect()} == {(*key, e.load) for key, e in recorded.items()}


def test_only_new_files_are_read(spark, data, tmp_path):
    _run(spark, data, tmp_path)
    render = "ListingRendered"
    _write(data / "events/mg/c.csv.gz", EVENT_HEADER, _session("s7", ("L1", render), ("L2", render), ("L1", render)))
    more = _run(spark, data, tmp_path)
    assert more["loaded"] == ["mg"] and more["stages"]["raw_events"] == 3 and "raw_listings" not in more["stages"]
    new = [_listing("L7"), _listing("L1", updated="2023-01-01 00:00:00", price="R$ 7"), _listing("L4", updated="2024-03-01 00:00:00", price="R$ 4")]
    _write(data / "listings/mg/b.csv.gz", LISTING_HEADER, new)
    again = _run(spark, data, tmp_path)
    assert again["stages"]["raw_listings"] == 3 and again["stages"]["listings"] == 4 and again["stages"]["raw_events"] == 18
    fresh = convert(spark, str(data), f"{tmp_path}/fresh", min_item_freq=2, output_partitions=3)
    for name in ("events", "items"):
        grown, whole = (sorted(map(str, spark.read.parquet(f"{tmp_path}/{where}/{name}.parquet").collect())) for where in ("work", "fresh"))
        assert grown == whole
    assert {k: v for k, v in again.items() if k not in ("stages", "loaded")} == {k: v for k, v in fresh.items() if k not in ("stages", "loaded")}
    (data / "events/mg/c.csv.gz").unlink()
    assert _run(spark, data, tmp_path)["stages"]["raw_events"] == 15
