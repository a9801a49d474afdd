"""Rows that may be among keys."""

from seqprep.llm import among
from seqprep.llm.among import maybe_among
from seqprep.sources.package import ship_package


def test_every_row_of_a_key_and_few_others(spark, monkeypatch):
    ship_package(spark)
    monkeypatch.setattr(among, "PART_BYTES", 5000)
    rows = spark.range(-5000, 5000).selectExpr("id", "cast(id AS string) AS text", "array(id) AS `odd name`")
    rows = rows.unionByName(rows.filter("id = 7")).unionByName(rows.filter("id = 1").selectExpr("null AS id", "text", "`odd name`"))
    keys = spark.range(-5000, 5000, 100).selectExpr("id + 7 AS id").unionByName(spark.sql("SELECT cast(null AS bigint) AS id"))
    found = maybe_among(rows, "id", keys)
    assert found.columns == rows.columns
    ids = [row["id"] for row in found.collect()]
    assert {7 + i for i in range(-5000, 5000, 100)} <= set(ids) and ids.count(7) == 2
    assert len(ids) < 130 and None not in ids


def test_no_keys_and_no_rows(spark):
    ship_package(spark)
    none, some = spark.range(0), spark.range(10)
    assert maybe_among(some, "id", none).count() == 0
    assert maybe_among(none, "id", some).count() == 0
