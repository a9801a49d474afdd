"""Shape of the physical plans: no Python, few shuffles, nothing whole in one task."""

import re

import pytest
from pyspark.sql import functions as F

from seqprep.driver import fixtures as fx, queries
from seqprep.operators import catalog, checks, dataset, features, sessions, skew
from seqprep.sources.spool import spool

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def static_plans(spark):
    """Plans without runtime changes or broadcasts chosen by size."""
    names = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _count(plan, node):
    return len(re.findall(rf"(?m)^[\s:+\-*()0-9]*{node}\b", plan))


def test_collapse_and_length_limit_shuffle_once(spark, static_plans):
    plan = _plan(sessions.session_runs(fx.click_events(spark, SF_DIR), 3, 50, order=queries.ORDER))
    assert _count(plan, "Exchange") == 1 and _count(plan, "Sort") <= 3
    assert "SinglePartition" not in plan and "Python" not in plan


def test_length_limit_cuts_before_the_shuffle(spark, static_plans):
    runs = spool(sessions.collapse_runs(fx.click_events(spark, SF_DIR), order=queries.ORDER), "runs")
    plan = _plan(sessions.filter_sessions_by_length(runs, 3, 50))
    assert _count(plan, "Exchange") == 1
    exchange = plan.index("Exchange")
    assert "WindowGroupLimit" in plan[exchange:] and "Partial" in plan[exchange:]


def test_latest_version_cuts_before_the_shuffle(spark, static_plans):
    plan = _plan(catalog.latest_versions(fx.listing_versions(spark, SF_DIR)))
    assert _count(plan, "Exchange") == 1
    assert "WindowGroupLimit" in plan[plan.index("Exchange") :]


def test_event_type_filter_and_columns_reach_the_scan(spark):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet").filter(F.col("event_type").isin("view"))
    plan = _plan(sessions.item_support(events.withColumnRenamed("user_id", "item_id")))
    assert "In(event_type, [view])" in plan or "EqualTo(event_type,view)" in plan
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in plan


def test_salted_join_has_no_global_task(spark, static_plans):
    events = spool(fx.click_events(spark, SF_DIR), "events")
    frequent = sessions.filter_rare_items(events, 2, broadcast_rows=0, group_rows=10)
    plan = _plan(frequent)
    assert "salt" in plan and "SinglePartition" not in plan.replace("TakeOrderedAndProject", "")
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_sequences_group_bounded_chunks(spark, static_plans):
    rows = spark.read.parquet(f"{SF_DIR}/events.parquet").selectExpr(
        "user_id AS uid", "event_id AS sid", "1 AS behavior", "user_id AS intensity",
        "1 AS market_segment", "value AS latitude", "value AS longitude", "event_id AS position",
        "event_type AS split",
    )
    plan = _plan(dataset.sequences(rows))
    assert _count(plan, "Exchange") == 1
    # The chunk is part of the partitioning, so a long session is spread over tasks.
    keys = re.search(r"hashpartitioning\((.*)\), ENSURE", plan).group(1)
    assert keys.count("#") == 3


def test_vector_assembly_needs_no_shuffle(spark):
    smap, pairs = fx.part_map(spark, SF_DIR)
    aligned = spool(features.align_items(smap, pairs, fx.catalog_items(spark, SF_DIR)), "aligned")
    plan = _plan(features.feature_matrix(aligned).features)
    assert "Python" not in plan
    # Only the vocabulary tables, broadcast to the items, are shuffled.
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan


def test_null_keys_of_a_left_join_are_dealt_out(spark, static_plans):
    big = spark.range(4000).selectExpr("CASE WHEN id % 2 = 0 THEN id % 9 END AS key", "id")
    side = spark.range(9).selectExpr("id AS key", "id * 10 AS value")
    joined = skew.join_skewed(big, side, ["key"], "left", broadcast_rows=0, group_rows=100)
    tasks = joined.filter("key IS NULL").groupBy(F.spark_partition_id()).count().collect()
    assert sum(row["count"] for row in tasks) == 2000 and max(row["count"] for row in tasks) < 700
    assert joined.filter("value = key * 10").count() == 2000


@pytest.mark.parametrize("name", sorted(queries.REGISTRY))
def test_no_python_and_no_cross_join_in_any_query(spark, name):
    plan = _plan(queries.REGISTRY[name](spark, SF_DIR))
    for forbidden in ("Python", "ArrowEval", "MapInPandas", "CartesianProduct", "NestedLoop"):
        assert forbidden not in plan


def test_checks_on_one_table_share_its_scan(spark, static_plans):
    table = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").selectExpr(
        "l_suppkey AS sid", "CAST(l_partkey AS STRING) AS canonical_listing_id", "l_quantity - 25 AS intensity"
    )
    asked = [checks.null_event_keys(table), checks.sid_conflicts(table), checks.no_rows(table), checks.bad_intensity(table)]
    found = checks.all_checks(asked)
    plan = _plan(found)
    assert _count(plan, "FileScan") == 1 and "SinglePartition" not in plan and "Join" not in plan
    first = {r["check_name"]: (r["violations"], r["examples"]) for r in found.collect()}
    suppliers = sorted(str(r["sid"]) for r in table.groupBy("sid").count().filter("count > 1").collect())
    assert first["sid_conflict"] == (len(suppliers), suppliers[:5]) and first["no_rows"] == (0, [])
    assert first["bad_intensity"] == (table.filter("intensity < 0").count(), []) and first["null_event_key"] == (0, [])
