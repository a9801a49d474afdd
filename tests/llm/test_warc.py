"""Archives: exact round trips."""

import hashlib
import os
import zlib

import pytest

from seqprep.llm import warc
from seqprep.sources.package import ship_package

BIG = "<p>" + "é" * 200 + "</p>\r\n\r\nWARC/1.1\r\n"
ROWS = [
    (5, "http://a/1", BIG),
    (3, "http://a/2", BIG),
    (9, None, BIG),
    (9, None, BIG),
    (None, "http://n", BIG),
    (1, "http://a/ 1\r\nX: y", "small"),
    (2, "http://a/3", "small"),
    (4, "u", None),
    (6, "u", ""),
    (7, "u", "x" * 99),
    (8, "u", "x" * 99),
    (10, "u", "x" * 100),
    (11, "u", "x" * 100),
    (12, "u", "long" * 100_000),
]


def pages(spark, rows):
    ship_package(spark)
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    return frame.selectExpr("*", "1 AS file", "2 AS offset", "3 AS length", "4 AS payload", "5 AS first_id")


def expected(rows):
    payloads = [(html or "").encode() for _, _, html in rows]
    first = {}
    for (identity, _, _), payload in zip(rows, payloads):
        if len(payload) >= 100 and identity is not None:
            first[payload] = min(first.get(payload, identity), identity)
    result = []
    for (identity, _, _), payload in zip(rows, payloads):
        refers = first.get(payload)
        revisit = refers is not None and identity != refers
        digest = hashlib.sha256(payload).hexdigest()
        result.append((identity, "revisit" if revisit else "response", refers if revisit else None, digest, len(payload), None if revisit else payload))
    return sorted(result, key=str)


def records(frame):
    names = ("page_id", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload")
    return sorted((tuple(bytes(x) if isinstance(x, bytearray) else x for x in (row[n] for n in names)) for row in frame.collect()), key=str)


def test_round_trip(spark):
    index, folder = warc.archive_pages(pages(spark, ROWS))
    assert records(warc.read_archives(index, folder)) == expected(ROWS)


@pytest.mark.parametrize(("gap", "read"), [(0, 1), (1 << 30, 1 << 30)])
def test_selected_records_by_any_range_size(spark, tmp_path, gap, read, monkeypatch):
    monkeypatch.setattr(warc, "GAP_BYTES", gap)
    monkeypatch.setattr(warc, "READ_BYTES", read)
    index, folder = warc.archive_pages(pages(spark, ROWS), str(tmp_path / "archives"))
    some = [row for row in expected(ROWS) if row[0] in (1, 3, 9, 12)]
    assert records(warc.read_archives(index.filter("page_id IN (1, 3, 9, 12)"), folder)) == some


def test_archives_are_whole_files_of_gzip_members(spark, tmp_path):
    index, folder = warc.archive_pages(pages(spark, ROWS), str(tmp_path / "archives"))
    lengths = {row["file"]: row["n"] for row in index.groupBy("file").agg({"length": "sum"}).toDF("file", "n").collect()}
    assert {name: os.path.getsize(f"{folder}/{name}") for name in lengths} == lengths
    for row in index.collect():
        with open(f"{folder}/{row['file']}", "rb") as file:
            file.seek(row["offset"])
            record = zlib.decompress(file.read(row["length"]), 31)
        assert record.startswith(b"WARC/1.1\r\nWARC-Type: ") and record.endswith(b"\r\n\r\n")
        assert record.count(b"\r\nX: y") == 0


def test_a_damaged_payload_is_noticed():
    row = {"page_id": 1, "url": "u", "payload": b"abc", "payload_digest": "0" * 64, "payload_bytes": 3, "record_type": "response", "refers_to": None}
    with pytest.raises(ValueError, match="digest"):
        warc.parse_record(warc.record_bytes(row))


def test_empty_table(spark):
    index, folder = warc.archive_pages(pages(spark, []))
    assert warc.read_archives(index, folder).collect() == []
