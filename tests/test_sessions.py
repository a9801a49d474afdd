"""Session operators: literal rows, traps, oversized groups and a plain reference model."""

import random
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from seqprep.operators import sessions as ops, skew
from seqprep.operators.catalog import active_catalog, enrich_events, latest_versions, unique_items
from seqprep.operators.dense_ids import dense_ids, dense_maps
from seqprep.operators.regions import merge_regions
from seqprep.operators.skew import join_skewed, number_within_groups

SCHEMA = "user_id string, item_id string, event_type string, timestamp long, event_ms long"


def _events(spark, rows):
    """Rows of (session, item, type, ms)."""
    return spark.createDataFrame([(u, i, k, ms // 1000, ms) for u, i, k, ms in rows], SCHEMA)


def _runs(df):
    columns = ["user_id", "run_seq", "item_id", "event_type", "timestamp", "intensity"]
    return sorted(tuple(row) for row in df.select(columns).collect())


def model_runs(rows):
    """Plain Python run collapse, for comparison."""
    grouped = defaultdict(list)
    for session, item, kind, ms in rows:
        grouped[session].append((ms, item, kind))
    result = []
    for session, events in grouped.items():
        number, before = 0, None
        for ms, item, kind in sorted(events):
            if (item, kind) != before:
                number, before = number + 1, (item, kind)
                result.append([session, number, item, kind, ms // 1000, 0])
            result[-1][-1] += 1
    return sorted(tuple(row) for row in result)


def test_run_collapse_counts_and_keeps_the_first_second(spark):
    rows = [
        ("s", "A", "x", 1999), ("s", "A", "x", 2500), ("s", "A", "x", 3500),
        ("s", "A", "y", 4000), ("s", "B", "y", 5000), ("s", "A", "y", 6000), ("t", "A", "x", 1),
    ]
    assert _runs(ops.collapse_runs(_events(spark, rows))) == [
        ("s", 1, "A", "x", 1, 3), ("s", 2, "A", "y", 4, 1), ("s", 3, "B", "y", 5, 1),
        ("s", 4, "A", "y", 6, 1), ("t", 1, "A", "x", 0, 1),
    ]


def test_milliseconds_decide_the_order_inside_a_second(spark):
    rows = [("s", "A", "x", 1900), ("s", "B", "x", 1100), ("s", "A", "x", 1000)]
    assert [row[2] for row in _runs(ops.collapse_runs(_events(spark, rows)))] == ["A", "B", "A"]


def test_session_events_drop_rows_without_keys(spark):
    df = spark.createDataFrame(
        [("s", "A", "x", 5000), (None, "A", "x", 1), ("s", None, "x", 1), ("s", "A", "x", None)],
        "anonymized_session_id string, canonical_listing_id string, event_type string, event_ms long",
    ).withColumn("event_ts", F.timestamp_millis("event_ms"))
    assert [tuple(row) for row in ops.session_events(df).collect()] == [("s", "A", "x", 5, 5000)]


ROWS = st.lists(
    st.tuples(
        st.sampled_from("stu"), st.sampled_from("AB"), st.sampled_from("xy"), st.integers(0, 12)
    ),
    min_size=1,
    max_size=60,
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS, limit=st.sampled_from([1, 3, 8, 1000]))
def test_collapse_equals_the_model_for_any_block_cut(spark, rows, limit):
    expected = model_runs(rows)
    events = _events(spark, rows).repartition(3)
    assert _runs(ops.collapse_runs(events, group_rows=limit)) == expected


def test_one_session_with_most_rows_and_many_copies(spark):
    choose = random.Random(7)
    rows = [("bot", choose.choice("AB"), "x", choose.randrange(400)) for _ in range(3000)]
    rows += [("bot", "A", "x", 100)] * 3000  # copies of one row
    rows += [(f"s{choose.randrange(200)}", choose.choice("ABC"), "x", choose.randrange(50)) for _ in range(2000)]
    expected = model_runs(rows)
    for partitions in (1, 17):
        runs = ops.collapse_runs(_events(spark, rows).repartition(partitions), group_rows=100)
        assert _runs(runs) == expected
    assert sum(row[-1] for row in expected) == len(rows)


def test_hot_sessions_are_spread_over_blocks(spark):
    rows = [("bot", f"i{n % 7}", "x", n) for n in range(5000)]
    split = ops.split_hot_groups(_events(spark, rows), ["user_id"], 100)
    cold, hot = split.cold, split.hot
    assert split.rows == 5000
    assert hot.blocks == 50
    blocks = ops.ordered_blocks(hot.rows, ["user_id"], ["event_ms", "item_id"], hot.blocks, "test")
    sizes = [row["count"] for row in blocks.groupBy("block").count().collect()]
    assert cold.count() == 0 and sum(sizes) == 5000
    assert len(sizes) > 40 and max(sizes) < 400


def test_a_small_limit_does_not_make_a_block_of_every_few_rows(spark, monkeypatch):
    events = spark.range(40_000).select((F.col("id") % 400).cast("string").alias("user_id"), F.col("id").alias("o"))
    assert ops.split_hot_groups(events, ["user_id"], 20).hot.blocks == 64
    monkeypatch.setattr(skew, "BLOCK_ROWS", 400)
    assert ops.split_hot_groups(events, ["user_id"], 20).hot.blocks == 100
    assert ops.split_hot_groups(events, ["user_id"], 30).hot.blocks == 100
    numbered = number_within_groups(events, ["user_id"], ["o"], 20)  # blocks that hold several groups and cut some
    wrong = (F.col("position") != F.floor(F.col("o") / 400) + 1) | (F.col("group_size") != 100)
    assert numbered.count() == 40_000 and numbered.filter(wrong).count() == 0


def _cuts(monkeypatch):
    """The blocks that oversized sessions are cut into from now on."""
    cuts = []

    def cut(*args):
        cuts.append(skew.ordered_blocks(*args))
        return cuts[-1]

    monkeypatch.setattr(ops, "ordered_blocks", cut)
    return cuts


def test_untimed_runs_in_few_blocks_equal_those_of_whole_sessions(spark, monkeypatch):
    """Times fall along the order, types are missing, runs go on over block edges."""
    place = F.col("id")
    events = spark.range(6000).select(
        F.concat(F.lit("s"), place % 30).alias("user_id"),
        F.when(F.floor(place / 900) % 2 == 0, "A").otherwise("B").alias("item_id"),
        F.when(place % 7 == 0, F.when(place < 4000, "x").otherwise("y")).alias("event_type"),
        (-place).alias("timestamp"),
        place.alias("place"),
    )
    whole = _runs(ops.collapse_runs(events, order=["place"]))
    cuts = _cuts(monkeypatch)
    assert _runs(ops.collapse_runs(events, order=["place"], group_rows=10)) == whole
    assert sum(row[-1] for row in whole) == 6000
    assert cuts[0].select("block").distinct().count() <= 64


def test_files_of_blocks_follow_the_rows(spark, monkeypatch):
    """A limit of a few rows makes no more tasks and files that the driver hears of than one of many."""
    monkeypatch.setattr(skew, "BLOCK_ROWS", 200)
    cuts = _cuts(monkeypatch)
    columns = ["'s' AS user_id", "'A' AS item_id", "'x' AS event_type", "id AS timestamp", "id AS event_ms"]
    for size in (10_000, 20_000):
        runs = ops.collapse_runs(spark.range(size).selectExpr(columns), group_rows=20)
        assert [row[-1] for row in _runs(runs)] == [size]
    assert len(cuts[0].inputFiles()) <= 64
    assert len(cuts[1].inputFiles()) <= 100


def test_more_oversized_sessions_than_may_be_broadcast(spark, monkeypatch):
    """None of them holds a share that stands out: all stay whole."""
    rows = [(f"s{n % 6}", "AB"[n % 4 // 2], "x", n) for n in range(60)]
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 5)
    events = _events(spark, rows)
    assert ops.split_hot_groups(events, ["user_id"], 3).hot is None
    assert _runs(ops.collapse_runs(events, group_rows=3)) == model_runs(rows)
    built = ops.build_sessions(events, 3, 40, 1, broadcast_rows=0, group_rows=3)
    assert built.select("user_id").distinct().count() == 6


def _lengths(df):
    return Counter(row["user_id"] for row in df.collect())


@pytest.mark.parametrize("threshold", ["1000", "2"], ids=["per-task cut", "numbered"])
@pytest.mark.parametrize("group_rows", [5, 1000])
def test_length_limits(spark, threshold, group_rows):
    rows = [("long", f"i{n}", "x", n * 1000) for n in range(51)]
    rows += [("short", "A", "x", 0), ("short", "B", "x", 1), ("edge", "A", "x", 0), ("edge", "B", "x", 1), ("edge", "C", "x", 2)]
    name = "spark.sql.optimizer.windowGroupLimitThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, threshold)
    try:
        runs = ops.collapse_runs(_events(spark, rows))
        kept = ops.filter_sessions_by_length(runs, 3, 50, group_rows=group_rows)
        assert _lengths(kept) == {"long": 50, "edge": 3}
        assert "i0" not in {row["item_id"] for row in kept.collect()}
    finally:
        spark.conf.set(name, before)


def test_fused_collapse_and_length_limit(spark):
    rows = [("long", f"i{n}", "x", n) for n in range(70)] + [("s", "A", "x", 0)] * 9
    for limit in (10, 1000):
        kept = ops.session_runs(_events(spark, rows), 2, 50, group_rows=limit)
        assert sorted(row["run_seq"] for row in kept.collect()) == list(range(21, 71))


def test_length_limit_bounds():
    with pytest.raises(ValueError, match="at least 2"):
        ops.check_lengths(1, 50)
    with pytest.raises(ValueError, match="at least the min"):
        ops.check_lengths(3, 2)


def test_runs_joined_by_the_support_filter_stay_apart(spark):
    rows = [("s", "A", "x", 1), ("s", "R", "x", 2), ("s", "A", "x", 3), ("t", "A", "x", 1), ("t", "A", "y", 2)]
    built = ops.build_sessions(_events(spark, rows), 2, 50, 2)
    assert [(r[0], r[1], r[2]) for r in _runs(built)] == [("s", 1, "A"), ("s", 3, "A"), ("t", 1, "A"), ("t", 2, "A")]


def test_session_can_fall_under_the_minimum_after_the_support_filter(spark):
    rows = [("s", "R", "x", 1), ("s", "A", "x", 2), ("t", "A", "x", 1), ("t", "B", "x", 2), ("t", "A", "x", 3), ("t", "B", "x", 4)]
    built = ops.build_sessions(_events(spark, rows), 2, 50, 2)
    assert _lengths(built) == {"t": 4}
    # A lost one of its rows in the last step; its support is not checked again.
    assert {row["item_id_numeric"] for row in built.collect()} == {1, 2}


def test_build_is_the_same_for_any_layout_and_skew_path(spark):
    choose = random.Random(3)
    rows = [(choose.choice(["bot", "bot", f"s{choose.randrange(60)}"]), f"i{int(choose.paretovariate(1)) % 30}", choose.choice("xy"), choose.randrange(3000)) for _ in range(2500)]
    results = []
    for partitions, limits in ((1, {}), (17, {"broadcast_rows": 0, "group_rows": 50})):
        built = ops.build_sessions(_events(spark, rows).repartition(partitions), 3, 40, 5, **limits)
        columns = ["session_id_numeric", "item_id_numeric", "intensity", "user_id", "run_seq", "timestamp"]
        results.append(sorted(tuple(row) for row in built.select(columns).collect()))
    assert results[0] == results[1]
    sessions = {row[0] for row in results[0]}
    items = {row[1] for row in results[0]}
    assert sessions == set(range(1, len(sessions) + 1)) and items == set(range(1, len(items) + 1))


def test_regions_keep_their_own_sessions_and_ids(spark):
    rows = [("s", "A", "x", 1), ("s", "B", "x", 2), ("s", "A", "x", 3)]
    both = _events(spark, rows).withColumn("region", F.explode(F.array(F.lit("mg"), F.lit("es_bh"))))
    built = ops.build_sessions(both, 2, 50, 1, session=["region", "user_id"], within=["region"])
    events = ops.model_events(built, ["region"])
    assert {(r["region"], r["uid"], r["sid"]) for r in events.collect()} == {
        ("mg", 1, 1), ("mg", 1, 2), ("es_bh", 1, 1), ("es_bh", 1, 2),
    }
    ordered = events.withColumn("region_order", F.when(F.col("region") == "mg", 0).otherwise(1))
    merged = {(r["region"], r["uid"], r["sid"]) for r in merge_regions(ordered).collect()}
    assert merged == {("mg", 1, 1), ("mg", 1, 2), ("es_bh", 2, 3), ("es_bh", 2, 4)}


def test_latest_version_rules(spark):
    rows = [
        ("a", "ACTIVE", "2024-01-02", 1), ("a", "ACTIVE", "2024-01-02", 2), ("a", "ACTIVE", "2024-01-01", 0),
        ("b", "INACTIVE", "2024-05-01", 9), ("b", "ACTIVE", "2024-01-01", 3), ("b", "ACTIVE", None, 4),
        ("c", "ACTIVE", None, 5), ("d", "INACTIVE", "2024-01-01", 6), (None, "ACTIVE", "2024-01-01", 7),
    ]
    listings = spark.createDataFrame(rows, "anonymized_listing_id string, status string, updated_at string, version int")
    for partitions in (1, 5):
        catalog = active_catalog(listings.repartition(partitions))
        found = {(r["canonical_listing_id"], r["version"], r["listing_id_numeric"]) for r in catalog.collect()}
        assert found == {("a", 1, 1), ("b", 3, 2), ("c", 5, 3)}
    assert latest_versions(listings).count() == 5


def test_padded_ids_do_not_match_and_other_types_are_dropped(spark):
    raw = spark.createDataFrame(
        [("a", " s ", "5000", "LeadClicked"), ("a ", "s", "5000", "LeadClicked"), ("a", "s", "5000", "Other"), ("z", "s", "1", "LeadClicked"), ("a", " ", "x", "ShareClicked")],
        "anonymized_listing_id string, anonymized_session_id string, collector_timestamp string, event_type string",
    )
    mapping = spark.createDataFrame([("a", "a", 1)], "anonymized_listing_id string, canonical_listing_id string, listing_id_numeric long")
    found = enrich_events(raw, mapping).select("anonymized_session_id", "event_ms", "event_type").collect()
    assert {tuple(row) for row in found} == {("s", 5000, "LeadClicked"), (None, None, "ShareClicked")}


def test_unique_items_prefers_the_first_region(spark):
    items = spark.createDataFrame([("a", 1, "x"), ("a", 0, "z"), ("a", 0, "y"), ("b", 1, "w")], "canonical_listing_id string, region_order int, zip_code string")
    assert {tuple(r) for r in unique_items(items).collect()} == {("a", 0, "y"), ("b", 1, "w")}


def test_dense_ids_follow_key_order(spark):
    keys = [f"k{n:05d}" for n in random.Random(1).sample(range(100_000), 3000)]
    ids = dense_ids(spark.createDataFrame([(key,) for key in keys], "key string"), ["key"], "id")
    assert {row["key"]: row["id"] for row in ids.collect()} == {
        key: place for place, key in enumerate(sorted(keys), start=1)
    }


def test_dense_maps_number_each_column_on_its_own(spark):
    df = spark.createDataFrame([(10, "b", 1), (2, "a", 1), (10, "a", 2)], "n long, t string, g int")
    maps = dense_maps(df, ["n", "t"])
    assert maps.sizes() == {"n": 2, "t": 2}
    assert {tuple(r) for r in maps.mapping("n", "id").collect()} == {(2, 1), (10, 2)}
    assert {tuple(r) for r in maps.mapping("t", "id").collect()} == {("a", 1), ("b", 2)}
    grouped = dense_maps(df, ["n"], ["g"]).mapping("n", "id")
    assert {tuple(r) for r in grouped.collect()} == {(1, 2, 1), (1, 10, 2), (2, 10, 1)}


def test_a_long_limit_computes_the_runs_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def session(number):
        seen.add(1)
        return "long" if number < 290 else "short"

    rows = spark.range(300).select(F.col("id").alias("run_seq"), F.lit("A").alias("item_id"), F.lit(0).alias("timestamp"))
    runs = rows.withColumn("user_id", session("run_seq"))
    kept = ops.filter_sessions_by_length(runs, 3, 1000, group_rows=50)
    assert _lengths(kept) == {"long": 290, "short": 10}
    assert seen.value == 300


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_salted_join_equals_the_plain_join(spark, how):
    choose = random.Random(5)
    keys = ["hot"] * 900 + [f"k{choose.randrange(80)}" for _ in range(500)] + [None] * 5
    big = spark.createDataFrame([(key, n % 3) for n, key in enumerate(keys)], "key string, value int")
    side = spark.createDataFrame([("hot", 1)] + [(f"k{n}", n) for n in range(0, 100, 2)], "key string, extra int")
    plain = big.join(side, ["key"], how)
    salted = join_skewed(big.repartition(5), side, ["key"], how, broadcast_rows=0, group_rows=40)
    assert sorted(map(repr, salted.collect())) == sorted(map(repr, plain.collect()))


def test_numbering_of_oversized_groups(spark):
    rows = [("hot", n) for n in range(1000)] + [("a", 5), ("a", 3)]
    numbered = number_within_groups(spark.createDataFrame(rows, "g string, o int"), ["g"], ["o"], 50)
    found = {(r["g"], r["o"], r["position"], r["group_size"]) for r in numbered.collect()}
    assert found == {("hot", n, n + 1, 1000) for n in range(1000)} | {("a", 3, 1, 2), ("a", 5, 2, 2)}


def test_numbering_of_copies(spark, monkeypatch):
    """Copies of one row fill most of a group; each gets its own position."""
    monkeypatch.setattr(skew, "COPY_STEP", 64)
    rows = [("hot", 1, "a")] * 700 + [("hot", 1, "b")] * 2 + [("hot", 0, "z")]
    df = spark.createDataFrame(rows, "g string, o int, v string").repartition(4)
    for limit in (50, 10_000):
        numbered = number_within_groups(df, ["g"], ["o"], limit)
        found = sorted((r["position"], r["v"], r["group_size"]) for r in numbered.collect())
        expected = ["z"] + ["a"] * 700 + ["b"] * 2
        assert found == [(place, value, 703) for place, value in enumerate(expected, start=1)]


@pytest.mark.parametrize("group_rows", [1, 2, 7, 1_000_000])
def test_one_answer_at_every_size_limit(spark, group_rows):
    """Times that fall along the order, missing types, and copies of events."""
    rows = [("s", "A" if n % 11 < 8 else "B", (None, "x", "x", "y")[n % 4], 100 - n, n) for n in range(40)] + [
        ("s", "A", None, 500, 41), ("t", "A", None, 9, 1), ("t", "A", "z", 5, 2), ("t", "A", "z", 5, 2),
    ]
    schema = "user_id string, item_id string, event_type string, timestamp long, place long"
    events = spark.createDataFrame(rows, schema)
    expected, before = [], {}
    for user, item, kind, time, _ in sorted(rows, key=lambda row: (row[0], row[4])):
        last = before.get(user)
        run = [r for r in expected if r[0] == user]
        if last and last[0] == item and not (kind is not None and last[1] is not None and kind != last[1]):
            run[-1][2] = run[-1][2] if run[-1][2] is not None else kind
            run[-1][3], run[-1][4] = min(run[-1][3], time), run[-1][4] + 1
        else:
            expected.append([user, item, kind, time, 1, len(run) + 1])
        before[user] = (item, kind)
    runs = ops.collapse_runs(events, order=["place"], group_rows=group_rows)
    found = runs.select("user_id", "item_id", "event_type", "timestamp", "intensity", "run_seq").collect()
    assert sorted(map(list, found), key=str) == sorted(expected, key=str)
