"""Regional tables to one table with global ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def region_offsets(events: DataFrame, region: str = "region_order") -> DataFrame:
    """Highest ids of all earlier regions; one row per region."""
    top = events.groupBy(region).agg(F.max("uid").alias("max_uid"), F.max("sid").alias("max_sid"))
    # One row per region, a list the caller wrote out: a single ordered window is fine.
    earlier = Window.orderBy(region).rowsBetween(Window.unboundedPreceding, -1)
    return top.select(
        region,
        F.coalesce(F.sum("max_uid").over(earlier), F.lit(0)).alias("uid_offset"),
        F.coalesce(F.sum("max_sid").over(earlier), F.lit(0)).alias("sid_offset"),
    )


def merge_regions(events: DataFrame, region: str = "region_order") -> DataFrame:
    """Shift the ids of each region past those of the regions before it."""
    offsets = F.broadcast(region_offsets(events, region))
    return (
        events.join(offsets, region)
        .withColumn("uid", F.col("uid") + F.col("uid_offset"))
        .withColumn("sid", F.col("sid") + F.col("sid_offset"))
        .drop("uid_offset", "sid_offset")
    )


def merge_stats(events: DataFrame) -> DataFrame:
    """Rows, sessions and item ids of a merged table.

    Merged ids are dense from 1, so the highest id is the number of distinct ones: no shuffle.
    """
    return events.agg(
        F.count("*").alias("rows"),
        F.coalesce(F.max("uid"), F.lit(0)).alias("sessions"),
        F.coalesce(F.max("sid"), F.lit(0)).alias("items"),
    )
