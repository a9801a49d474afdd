"""The driver's tables seen as listings, catalogue items and click events.

Every view covers its whole table; the arithmetic below only derives attribute values, so that
each branch of an operator meets some rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from seqprep.operators.catalog import add_cells
from seqprep.operators.dense_ids import dense_ids

# Behaviour ids of the event types in the driver's events table.
EVENT_CODES = {"click": 1, "error": 2, "purchase": 3, "signup": 4, "view": 5}
TARGET = "purchase"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Stored timestamps carry no zone; read as UTC they match the SQL side.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def _event_key() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def click_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of one user and day; ``item_id`` has a skewed frequency."""
    moment = F.col("ts").cast("timestamp")
    key = _event_key()
    return table(spark, sf_dir, "events").select(
        F.concat(text("user_id"), F.lit("-"), F.date_format("ts", "yyyyMMdd")).alias("user_id"),
        text(F.floor(key * key / 100)).alias("item_id"),
        text(key).alias("canonical_listing_id"),
        "event_type",
        F.unix_micros(moment).alias("event_us"),
        F.unix_timestamp(moment).alias("timestamp"),
        "event_id",
        F.concat(F.lit("r"), text(F.col("user_id") % 2)).alias("region"),
    )


def user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events with one long session per user."""
    return click_events(spark, sf_dir).withColumn("user_id", F.split("user_id", "-").getItem(0))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw text, some ids padded or blank and some times unusable."""
    events = table(spark, sf_dir, "events")
    key = _event_key()
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    return events.select(
        "event_id",
        F.when(key % 10 == 3, F.concat(text(key), F.lit(" "))).otherwise(text(key)).alias(
            "anonymized_listing_id"
        ),
        F.when(key % 20 == 5, F.lit("  "))
        .when(key % 20 == 6, F.concat(F.lit("  s"), text("user_id"), F.lit(" ")))
        .otherwise(F.concat(F.lit("s"), text("user_id")))
        .alias("anonymized_session_id"),
        F.when(key % 25 == 7, F.lit("bad"))
        .when(key % 25 == 8, F.concat(text(millis), F.lit(".75")))
        .otherwise(text(millis))
        .alias("collector_timestamp"),
        "event_type",
    )


def listing_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as versions of a listing: part, ship date, status."""
    return table(spark, sf_dir, "lineitem").select(
        text("l_partkey").alias("anonymized_listing_id"),
        F.when(F.col("l_linestatus") == "O", "ACTIVE").otherwise("INACTIVE").alias("status"),
        F.col("l_shipdate").cast("timestamp").alias("updated_at"),
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        "l_quantity",
        F.concat(F.lit("r"), text(F.col("l_suppkey") % 3)).alias("region"),
    )


def _coordinate(start: int, zero_at: int) -> str:
    return f"""
        CASE WHEN p_partkey % 50 IN ({zero_at}, 0) THEN '0'
             WHEN p_partkey % 51 = {zero_at} THEN 'abc'
             WHEN p_partkey % 53 = {zero_at} THEN NULL
             ELSE concat('-', {start} + p_partkey % 20, '.', lpad(p_partkey % 1000, 3, '0')) END"""


ITEM_EXPRESSIONS = {
    "canonical_listing_id": "string(p_partkey)",
    "lat_region": _coordinate(5, 11),
    "lon_region": _coordinate(35, 13),
    "zip_code": """
        CASE WHEN p_partkey % 13 = 0 THEN ' '
             ELSE lpad(string(p_partkey * 7919 % 100000), 8, '3') END""",
    "neighborhood": "CASE WHEN p_partkey % 17 <> 0 THEN p_brand END",
    "usable_areas": "CASE WHEN p_partkey % 3 <> 0 THEN p_size * 10D END",
    "total_areas": "CASE WHEN p_partkey % 4 <> 0 THEN p_size * 12.5D - 100D END",
    "bedrooms": "p_size",
    "bathrooms": "CASE WHEN p_partkey % 5 <> 0 THEN p_size % 4 END",
    "suites": "CASE WHEN p_partkey % 6 <> 0 THEN p_size % 3 END",
    "parking_spaces": "CASE WHEN p_partkey % 7 <> 0 THEN p_size % 5 - 1 END",
    "price": "CASE WHEN p_partkey % 9 <> 0 THEN p_retailprice END",
    "unit_type": "p_type",
    "amenities": """
        CASE p_partkey % 8
             WHEN 0 THEN NULL
             WHEN 1 THEN concat("['", split(p_name, ' ')[0], "', ' ", split(p_name, ' ')[1], " ', None]")
             WHEN 2 THEN concat("('", split(p_name, ' ')[0], "', \\"", split(p_name, ' ')[1], "\\", 7)")
             WHEN 3 THEN concat('garbage(', split(p_name, ' ')[0])
             WHEN 4 THEN concat("['", split(p_name, ' ')[0], "', '", split(p_name, ' ')[0], "',]")
             WHEN 5 THEN '[]'
             ELSE concat("['", split(p_name, ' ')[0], "', '", split(p_name, ' ')[1], "']") END""",
    "business_type": """
        CASE p_partkey % 7
             WHEN 0 THEN NULL WHEN 1 THEN ' sell ' WHEN 2 THEN 'SALE' WHEN 3 THEN 'rental'
             WHEN 4 THEN 'RENTAL' WHEN 5 THEN 'Sale' ELSE 'RENTAL' END""",
    "usage_type": """
        CASE p_partkey % 5
             WHEN 0 THEN 'RESIDENTIAL' WHEN 1 THEN 'residential ' WHEN 2 THEN 'COMMERCIAL'
             WHEN 3 THEN 'MIXED' ELSE NULL END""",
}


def catalog_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as catalogue items with gaps in every optional attribute."""
    parts = table(spark, sf_dir, "part")
    return add_cells(
        parts.selectExpr(*(f"{text} AS {name}" for name, text in ITEM_EXPRESSIONS.items()))
    )


def part_map(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Item map over the parts that were ordered, and their (sid, canonical id) pairs."""
    keys = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("sid")).distinct()
    smap = dense_ids(keys, ["sid"], "dense_id").withColumn("dense_id", F.col("dense_id").cast("int"))
    return smap, smap.select("sid", text("sid").alias("canonical_listing_id"))
