"""Parquet tables: reading, writing, counting and fingerprinting on the way."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from seqprep.sources.fingerprints import TableState, observed, state_of


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _united(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)


def read_tables(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Several tables as one, matched by column name; a column missing in one is NULL there."""
    return _united([spark.read.parquet(path) for path in paths])


def _found(load) -> bool:
    """Whether a reader finds its path."""
    try:
        load()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` holds a finished table (one with a ``_SUCCESS`` mark)."""
    return _found(lambda: spark.read.format("binaryFile").load(f"{path}/_SUCCESS"))


def regions_exist(spark: SparkSession, path: str) -> bool:
    """Whether any region was written to ``path``; Spark leaves no mark on partial overwrites."""
    return _found(lambda: spark.read.format("binaryFile").option("basePath", path).load(f"{path}/region=*"))


def write_table(
    df: DataFrame, path: str, force: bool = False, partition_by: Sequence[str] = ()
) -> None:
    """Write a table; an existing one is replaced only with ``force``."""
    writer = df.write.mode("overwrite" if force else "errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_hashed(df: DataFrame, path: str, force: bool = False) -> TableState:
    """``write_table``, and the state of what was written, taken on the way."""
    rows, seen = observed(df)
    write_table(rows, path, force)
    return state_of(seen)


def write_load(df: DataFrame, path: str, load: str) -> None:
    """Write rows by region in the folder of a load, next to those of other loads, and record their columns."""
    df.write.mode("errorifexists").partitionBy("region").parquet(f"{path}/load={load}")
    columns = df.sparkSession.range(1).select(F.lit(df.schema.json()).alias("value"))
    columns.write.mode("errorifexists").text(f"{path}_schemas/load={load}")


def load_schemas(spark: SparkSession, path: str, loads: Sequence[str]) -> dict[str, T.StructType]:
    """Load to the columns that it wrote, as recorded; no table file is opened."""
    folders = [f"{path}_schemas/load={load}" for load in loads]
    recorded = spark.read.option("basePath", f"{path}_schemas").schema("value string, load string").text(folders, wholetext=True)
    return {row["load"]: T.StructType.fromJson(json.loads(row["value"])) for row in recorded.collect()}  # a row per load


def read_regions(spark: SparkSession, path: str) -> DataFrame:
    """A table stored by region (and load); these names stay text even if they look like numbers."""
    schema = spark.read.parquet(path).schema
    for name in {"region", "load"} & set(schema.names):
        schema[name].dataType = T.StringType()
    return spark.read.schema(schema).parquet(path)


def read_loads(spark: SparkSession, path: str, loads: Mapping[str, str]) -> DataFrame:
    """Of each region the partitions that its loads wrote; ``loads`` is region to load, or to several with commas.

    Loads with other columns are united by name, by the columns recorded for each; one missing in a load is NULL
    there. Only folders of the wanted loads are listed. A load that wrote nothing for its region has no partition,
    so older rows never stand in for it.
    """
    by_load: dict[str, list[str]] = {}
    for region, names in loads.items():
        for load in names.split(","):
            by_load.setdefault(load, []).append(region)
    alike: dict[str, list[str]] = {}
    schemas = load_schemas(spark, path, list(by_load))
    for load in by_load:
        alike.setdefault(schemas[load].json(), []).append(load)
    parts = []
    for own in alike.values():
        wanted = [(F.col("load") == load) & F.col("region").isin(*by_load[load]) for load in own]
        schema = T.StructType([*schemas[own[0]].fields, T.StructField("load", T.StringType())])
        stored = spark.read.schema(schema).option("basePath", path).parquet(*(f"{path}/load={load}" for load in own))
        parts.append(stored.filter(reduce(lambda one, two: one | two, wanted)).drop("load"))
    return _united(parts)


def write_sorted(
    df: DataFrame, path: str, key: str, order: Sequence[str], partitions: int | None = None
) -> TableState:
    """Write files that each hold whole ``key`` groups in order; returns the state of the rows.

    Without a number of partitions Spark chooses by size.
    """
    if partitions is not None and partitions <= 0:
        raise ValueError("output partitions must be positive")
    spread = df.repartition(key) if partitions is None else df.repartition(partitions, key)
    rows, seen = observed(spread.sortWithinPartitions(key, *order))
    rows.write.mode("overwrite").parquet(path)
    return state_of(seen)


def in_regions(regions: Sequence[str], label: str, condition: Column | None = None) -> dict[str, Column]:
    """Metrics for ``counted``: rows of each region, of those that meet ``condition`` if there is one."""
    wanted = F.lit(True) if condition is None else condition
    return {f"{label}/{region}": F.count_if((F.col("region") == region) & wanted) for region in regions}


def by_region(metrics: Mapping[str, int]) -> dict[tuple[str, str], int]:
    """What ``in_regions`` counted, as (region, label) to rows."""
    split = [(name.split("/", 1), rows) for name, rows in metrics.items() if "/" in name]
    return {(region, label): rows for (label, region), rows in split}


def counted(
    df: DataFrame, label: str | None = None, **metrics: Column
) -> tuple[DataFrame, Observation]:
    """Count rows (and more) while the frame is written, without a job of its own."""
    observation = Observation(label)
    extra = [column.alias(name) for name, column in metrics.items()]
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), *extra), observation
