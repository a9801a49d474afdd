"""Manifests: what a job wrote, from which input, with which parameters."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from seqprep.sources.fingerprints import TableState, file_state
from seqprep.sources.tables import read_regions, regions_exist, table_exists, write_load


def parameter_text(**parameters) -> str:
    return json.dumps(parameters, sort_keys=True, default=list)


def write_manifest(spark: SparkSession, path: str, content: dict, force: bool = False) -> None:
    """One JSON row."""
    text = json.dumps(content, sort_keys=True, default=list)
    frame = spark.range(1).select(F.lit(text).alias("value"))
    frame.write.mode("overwrite" if force else "errorifexists").text(path)


def read_manifest(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first()["value"])


def record_states(spark: SparkSession, folder: str, states: dict[str, TableState]) -> None:
    """Keep the states of tables in ``folder`` that were taken while writing, with the files they hold for."""
    content = {name: {"state": state.text, "files": file_state(spark, f"{folder}/{name}")} for name, state in states.items()}
    write_manifest(spark, f"{folder}/table_states", content, force=True)


def recorded_state(spark: SparkSession, folder: str, name: str) -> str:
    """The recorded state of a table, or one of its files if they are not those that were recorded."""
    files = file_state(spark, f"{folder}/{name}")
    if table_exists(spark, f"{folder}/table_states"):
        entry = read_manifest(spark, f"{folder}/table_states").get(name)
        if entry and entry["files"] == files:
            return entry["state"]
    return f"files-{files}"


@dataclass(frozen=True)
class StageLoad:
    """One stage of one region: what it was made from (empty while it is being made), and its load."""

    region: str
    stage: str
    made_from: str
    load: str


def stage_loads(spark: SparkSession, path: str) -> dict[tuple[str, str], StageLoad]:
    """The last entry of every region and stage."""
    if not regions_exist(spark, path):
        return {}
    rows = read_regions(spark, path).collect()  # a row per region and stage
    loads = [StageLoad(row["region"], row["stage"], row["made_from"], row["load"]) for row in rows]
    return {(entry.region, entry.stage): entry for entry in loads}


def record_stages(spark: SparkSession, path: str, entries: Iterable[StageLoad]) -> None:
    """Put entries in place of those of the same region and stage."""
    rows = [(entry.region, entry.stage, entry.made_from, entry.load) for entry in entries]
    frame = spark.createDataFrame(rows, "region string, stage string, made_from string, load string")
    writer = frame.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("region", "stage").parquet(path)


def record_metrics(
    spark: SparkSession, path: str, load: str, stage: str, counts: Mapping[tuple[str, str], int]
) -> None:
    """Keep a load's counts, (region, metric) to rows, next to those of other loads.

    They are observed while tables are written, so rows of a repeated task may be counted twice.
    """
    rows = [(region, metric, count, stage) for (region, metric), count in sorted(counts.items())]
    frame = spark.createDataFrame(rows, "region string, metric string, rows bigint, stage string")
    write_load(frame.coalesce(1), path, f"{load}-{stage}")


def metrics(spark: SparkSession, path: str) -> DataFrame:
    """(region, metric, rows, stage, load) of all loads recorded."""
    return read_regions(spark, path).withColumn("load", F.regexp_replace("load", "-[a-z]+$", ""))


_FILES = "path string, length bigint, modified bigint, region string, stage string"


def loaded_files(spark: SparkSession, path: str, stage: str) -> DataFrame:
    """(region, path, length, modified) of the files that finished loads of a stage have read."""
    known = read_regions(spark, path) if regions_exist(spark, path) else spark.createDataFrame([], _FILES)
    return known.filter(F.col("stage") == stage).select("region", "path", "length", "modified")


def record_files(spark: SparkSession, path: str, stage: str, files: DataFrame) -> None:
    """Put the files of the given regions in place of those recorded before."""
    writer = files.withColumn("stage", F.lit(stage)).coalesce(1).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy("region", "stage").parquet(path)
