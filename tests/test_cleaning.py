"""Column functions on literal rows."""

import math

import pytest
from pyspark.sql import functions as F

from seqprep.functions import cleaning
from seqprep.functions.encoding import hash_bucket, literal_list
from seqprep.functions.geo import tile_cell
from seqprep.operators.catalog import clean_events, clean_listings


def _apply(spark, function, values):
    """One value per input text, in order."""
    df = spark.createDataFrame(list(enumerate(values)), "place int, value string")
    rows = df.select("place", function(F.col("value")).alias("out")).orderBy("place").collect()
    return [row["out"] for row in rows]


@pytest.fixture(params=["true", "false"], ids=["ansi", "legacy"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.set("spark.sql.ansi.enabled", before)


def test_stripped_double(spark, ansi):
    values = ["R$ 1.234,56", "-15", "1.2.3", "n/a", "", None, "300000", "1e5"]
    assert _apply(spark, cleaning.stripped_double, values) == [
        1.23456, 15.0, None, None, None, None, 300000.0, 15.0,
    ]


def test_whole_number(spark, ansi):
    cases = {
        "3.0": 3, ".5": 0, "1e5": None, "1.5": 1, "-1.7": -1, " 4 ": 4, "\t5": 5, "+6": 6,
        "7.": 7, ".": 0, "": None, "abc": None, "1 2": None, "99999999999": None, "-": None,
        "2.x": None, "007": 7,
    }
    assert _apply(spark, cleaning.whole_number, list(cases)) == list(cases.values())
    assert _apply(spark, cleaning.whole_number, [None]) == [None]


def test_whole_number_agrees_with_the_legacy_cast(spark):
    values = ["1", "1.5", "-1.7", ".5", ".", "-.5", "5.", " 8", "9 ", "\t1", "1e2", "", "x", "--1",
              "2147483647", "2147483648", "-2147483648", "1.2.3", "+", "0.", "00", "1_0", "١"]
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        legacy = _apply(spark, lambda value: value.cast("int"), values)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert _apply(spark, cleaning.whole_number, values) == legacy


def test_epoch_millis(spark, ansi):
    values = ["1700000000123", "1700000000123.9", " 5 ", "bad", None, "-1", "9" * 18, "9" * 30]
    largest = 9_223_372_036_854_775
    assert _apply(spark, cleaning.epoch_millis, values) == [
        1700000000123, 1700000000123, 5, None, None, -1, largest, None,
    ]


def test_dates_and_timestamps(spark, ansi):
    dates = _apply(spark, cleaning.lenient_date, ["2024-02-29", "2023-02-29", "soon", None])
    assert [str(value) for value in dates] == ["2024-02-29", "None", "None", "None"]
    moments = _apply(spark, cleaning.lenient_timestamp, ["2024-01-02 03:04:05", "2024-13-01", ""])
    assert moments[0].second == 5 and moments[1:] == [None, None]


def test_blank_to_null_trims_spaces_only(spark):
    assert _apply(spark, cleaning.blank_to_null, [" a ", "  ", "", "\tb", None]) == [
        "a", None, None, "\tb", None,
    ]


@pytest.mark.parametrize(
    "business,usage,expected",
    [
        ("SALE", "RESIDENTIAL", "SALE_RESIDENTIAL"),
        (" sell\t", "commercial ", "SALE_COMMERCIAL"),
        ("RENTAL", "RESIDENTIAL", "RENTAL_RESIDENTIAL"),
        ("RENTAL", "MIXED", "OTHER"),
        ("SALE", None, "OTHER"),
        (None, "RESIDENTIAL", "NONE_RESIDENTIAL"),
        ("", "COMMERCIAL", "_COMMERCIAL"),
    ],
)
def test_market_segment(spark, business, usage, expected):
    df = spark.createDataFrame([(business, usage)], "b string, u string")
    assert df.select(cleaning.market_segment(F.col("b"), F.col("u"))).first()[0] == expected


def test_finite_double(spark, ansi):
    values = ["1.5", " 2 ", "1e3", ".5", "nan", "inf", "-Infinity", "1e999", "1.0d", "x", "", None]
    assert _apply(spark, cleaning.finite_double, values) == [
        1.5, 2.0, 1000.0, 0.5, None, None, None, None, None, None, None, None,
    ]


def test_coordinate_or_zero(spark, ansi):
    values = ["-20.006", "abc", "", None, "nan", "-inf"]
    assert _apply(spark, cleaning.coordinate_or_zero, values) == [
        -20.006, 0.0, 0.0, 0.0, 0.0, -math.inf,
    ]


@pytest.mark.parametrize(
    "text,expected",
    [
        ("['GARAGE', 'POOL']", ["GARAGE", "POOL"]),
        ("[]", []),
        (None, []),
        ("nan", []),
        ("None", []),
        ("garbage(", []),
        ("('A','B')", ["A", "B"]),
        ("('A')", []),
        ("('A',)", ["A"]),
        ("()", []),
        ("['A',]", ["A"]),
        ("[,]", []),
        ("['a ', None]", ["A", "NONE"]),
        ("[1, 2]", ["1", "2"]),
        ("[1.50, -3, True]", ["1.5", "-3", "TRUE"]),
        ('["KID\'S", \'b\']', ["KID'S", "B"]),
        ("{'a':1}", []),
        ("'A'", []),
        ("['x, None, y', '']", ["X, NONE, Y"]),
        (r"['it\'s', 'b\\c']", ["IT'S", r"B\C"]),
        (" [ 'a' , 'b' ] ", ["A", "B"]),
        ("['a' 'b'", []),
        ("['a', 'b'] trailing", []),
        ("['a'; 'b']", []),
        ("['A', 'A']", ["A", "A"]),
        (r"['a\nb', 'c\td']", ["A\nB", "C\tD"]),
        (r"['a\xa0b', '\u00e9', '\101']", ["A\xa0B", "É", "A"]),
        (r"['\q', 'a\\nb']", [r"\Q", r"A\NB"]),
        ("['A' 'B', \"C\"'d']", ["AB", "CD"]),
    ],
)
def test_literal_list(spark, text, expected):
    assert _apply(spark, literal_list, [text]) == [expected]


def test_literal_list_takes_long_texts(spark):
    many = "[" + ", ".join(f"'amenity {number}'" for number in range(20_000)) + "]"
    long = "['" + "x" * 200_000 + "']"
    first, second = _apply(spark, literal_list, [many, long])
    assert len(first) == 20_000 and first[-1] == "AMENITY 19999"
    assert len(second[0]) == 200_000


def test_hash_bucket(spark):
    assert _apply(spark, lambda value: hash_bucket(value, 32), ["34007361", " 34007361 ", " ", None]) == [
        19, 19, None, None,
    ]


def test_tile_cell(spark):
    rows = [("0", "0"), ("0", "-43"), ("abc", "1"), ("nan", "1"), (None, "1"), ("91", "0"),
            ("-20.006", "-43.96"), ("-20.0061", "-43.9601"), ("90", "180")]
    df = spark.createDataFrame(
        [(place, *row) for place, row in enumerate(rows)], "place int, lat string, lon string"
    )
    cells = [
        row["cell"]
        for row in df.select("place", tile_cell(F.col("lat"), F.col("lon"), 13).alias("cell"))
        .orderBy("place")
        .collect()
    ]
    assert [cell == 0 for cell in cells] == [True, False, True, True, True, True, False, False, False]
    assert cells[6] == cells[7]
    assert cells[6] >> 56 == 13
    x = math.floor((-43.96 + 180) / 360 * 2**13)
    assert (cells[6] >> 28) & (2**28 - 1) == x
    assert (cells[8] >> 28) & (2**28 - 1) == 2**13 - 1 and cells[8] & (2**28 - 1) == 0


def test_cleaning_touches_only_present_columns(spark):
    df = spark.createDataFrame([("R$ 10", "2.0", "x")], "price string, suites string, other string")
    assert clean_listings(df).first().asDict() == {"price": 10.0, "suites": 2, "other": "x"}
    events = spark.createDataFrame([(" a ", "1700000000999")], "anonymized_listing_id string, collector_timestamp string")
    row = clean_events(events).first()
    assert row["anonymized_listing_id"] == "a" and row["event_ms"] == 1700000000999
    assert row["event_ts"].microsecond == 999000
