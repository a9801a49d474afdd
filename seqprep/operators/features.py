"""Item feature vectors aligned to the dense item ids.

Vector blocks, in order: log values, counts, coordinates, one-hot categories, amenities, hashed
values. Every block is an array expression on the item row, so building a vector needs no shuffle
beyond the alignment joins, and the plan does not grow with the vector.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from seqprep import contract
from seqprep.functions.cleaning import finite_double, market_segment
from seqprep.sources.schema import expect_columns
from seqprep.functions.encoding import hash_bucket, indicator, literal_list, one_of
from seqprep.operators.dense_ids import dense_ids
from seqprep.operators.skew import BROADCAST_ROWS, GROUP_ROWS, join_sized, join_skewed


@dataclass(frozen=True)
class ItemFeatures:
    """``features(dense_id, features)`` with padding row 0, and ``columns(position, name)``."""

    features: DataFrame
    columns: DataFrame
    dimensions: int


@dataclass(frozen=True)
class SparseFeatures:
    """``features(dense_id, indices, values)``: set positions in rising order; padding row 0 has none."""

    features: DataFrame
    columns: DataFrame
    dimensions: int


def catalog_with_segment(items: DataFrame) -> DataFrame:
    expect_columns(items, contract.CATALOG_COLUMNS, "items")
    return items.withColumn(
        "market_segment", market_segment(F.col("business_type"), F.col("usage_type"))
    )


def with_amenity_list(items: DataFrame) -> DataFrame:
    if "amenities" not in items.columns:
        return items
    return items.withColumn("amenity_list", literal_list(F.col("amenities")))


def sid_to_canonical(events: DataFrame) -> DataFrame:
    """Distinct (sid, canonical id) pairs; pairs are merged ahead of the shuffle."""
    return events.select("sid", "canonical_listing_id").distinct()


def align_items(
    smap: DataFrame,
    sid_canonical: DataFrame,
    items: DataFrame,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Catalogue row of every dense id, with its amenities parsed into ``amenity_list``.

    A listing known in two regions serves two dense ids.
    """
    named = smap.join(sid_canonical, "sid").select("dense_id", "canonical_listing_id")
    # A canonical id repeats once per region at most.
    aligned = join_sized(named, items, ["canonical_listing_id"], "inner", broadcast_rows)
    return with_amenity_list(catalog_with_segment(aligned))


def vocabularies(aligned: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value, count, rank)``: per column, ranks from 1 by falling count, then by text.

    All columns are counted in one pass over the items.
    """
    entries = F.array(
        *(
            F.struct(F.lit(name).alias("column"), F.col(name).cast("string").alias("value"))
            for name in columns
        )
    )
    counts = (
        aligned.select(F.explode(entries).alias("entry"))
        .select("entry.*")
        .dropna(subset=["value"])
        .groupBy("column", "value")
        .agg(F.count("*").alias("count"))
    )
    return dense_ids(counts, ["column", F.desc("count"), "value"], "rank", ["column"])


def amenity_counts(aligned: DataFrame) -> DataFrame:
    """Mentions per amenity over the model items; repeats within an item count again."""
    mentions = aligned.select(F.explode("amenity_list").alias("value"))
    return mentions.groupBy("value").agg(F.count("*").alias("count"))


def top_amenities(aligned: DataFrame, top: int = contract.AMENITIES_TOP) -> DataFrame:
    """The ``top`` most frequent amenities with their rank."""
    best = amenity_counts(aligned).orderBy(F.desc("count"), "value").limit(top)
    # At most ``top`` rows are left, so one ordered window is fine.
    rank = F.row_number().over(Window.orderBy(F.desc("count"), "value"))
    return best.withColumn("rank", rank)


def _number(aligned: DataFrame, name: str) -> Column:
    """The column as a finite double; all NULL when the table has no such column."""
    if name not in aligned.columns:
        return F.lit(None).cast("double")
    if not isinstance(aligned.schema[name].dataType, T.NumericType):
        return finite_double(F.col(name))
    number = F.col(name).cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) < float("inf")), number)


def _value(number: Column) -> Column:
    return F.coalesce(number, F.lit(0.0)).cast("float")


def log_block(aligned: DataFrame) -> dict[str, Column]:
    """log1p of the value; negative counts as missing."""
    block = {}
    for name in contract.LOG_FEATURES:
        number = _number(aligned, name)
        present = F.when(number >= 0, number)
        block[f"log1p_{name}"] = _value(F.log1p(present))
        block[f"missing_{name}"] = indicator(present.isNull())
    return block


def count_block(aligned: DataFrame) -> dict[str, Column]:
    block = {}
    for name in contract.COUNT_FEATURES:
        number = _number(aligned, name)
        block[name] = _value(number)
        block[f"missing_{name}"] = indicator(number.isNull())
    return block


def coordinate_block(aligned: DataFrame) -> dict[str, Column]:
    """Both values, then both indicators; 0.0 counts as missing on each axis."""
    numbers = {
        feature: F.nullif(_number(aligned, source), F.lit(0.0))
        for feature, source in contract.COORDINATE_FEATURES.items()
    }
    values = {feature: _value(number) for feature, number in numbers.items()}
    missing = {f"missing_{name}": indicator(number.isNull()) for name, number in numbers.items()}
    return values | missing


def hash_buckets(aligned: DataFrame) -> DataFrame:
    """Add ``{column}_bucket`` per hashed column; NULL where the value is missing."""
    return aligned.withColumns(
        {
            f"{name}_bucket": hash_bucket(F.col(name), buckets)
            if name in aligned.columns
            else F.lit(None).cast("int")
            for name, buckets in contract.HASHED_FEATURES.items()
        }
    )


def hash_block() -> tuple[list[str], list[Column]]:
    """Per hashed column a missing indicator and its bucket, one-hot: names and arrays."""
    names, arrays = [], []
    for name, buckets in contract.HASHED_FEATURES.items():
        bucket = F.col(f"{name}_bucket")
        names += [f"missing_{name}", *(f"{name}_hash_{slot}" for slot in range(buckets))]
        arrays += [F.array(indicator(bucket.isNull())), *one_of(bucket, buckets)]
    return names, arrays


def feature_matrix(
    aligned: DataFrame,
    amenities_top: int = contract.AMENITIES_TOP,
    broadcast_rows: int = BROADCAST_ROWS,
    group_rows: int = GROUP_ROWS,
) -> ItemFeatures:
    """Vectors of all aligned items plus the zero padding row.

    ``aligned`` should be a stored table: the vocabularies and the vectors both read it. The driver
    holds block widths and at most ``amenities_top`` amenity names; category vocabularies stay
    tables and are joined.
    """
    if amenities_top < 0:
        raise ValueError("amenities top cannot be negative")
    spark = aligned.sparkSession
    fixed = log_block(aligned) | count_block(aligned) | coordinate_block(aligned)
    arrays: list[Column] = [F.array(*fixed.values())]
    names: list[DataFrame] = [_named(spark, list(fixed), 0)]
    width = len(fixed)

    encoded, categories = _category_slots(aligned, broadcast_rows, group_rows)
    for name, size, vocabulary in categories:
        names.append(_category_names(name, vocabulary, width))
        arrays += one_of(F.col(f"{name}_slot"), size)
        width += size

    best = _best_amenities(aligned, amenities_top)
    if best:
        wanted = F.array(*(F.lit(value) for value in best))
        held = F.col("amenity_list")
        arrays.append(
            F.transform(wanted, lambda value: indicator(F.array_contains(held, value)))
        )
        names.append(_named(spark, [f"amenity={value}" for value in best], width))
        width += len(best)

    hashed_names, hashed = hash_block()
    names.append(_named(spark, hashed_names, width))
    width += len(hashed_names)

    vectors = hash_buckets(encoded).select("dense_id", F.concat(*arrays, *hashed).alias("features"))
    padding = spark.range(1).select(
        F.lit(0).cast(aligned.schema["dense_id"].dataType).alias("dense_id"),
        F.array_repeat(F.lit(0.0).cast("float"), width).alias("features"),
    )
    return ItemFeatures(vectors.unionByName(padding), reduce(DataFrame.unionByName, names), width)


def sparse_features(
    aligned: DataFrame,
    amenities_top: int = contract.AMENITIES_TOP,
    broadcast_rows: int = BROADCAST_ROWS,
    group_rows: int = GROUP_ROWS,
) -> SparseFeatures:
    """The vectors of ``feature_matrix`` as their cells other than zero.

    A row's size follows what its item has, not the vocabularies: each block gives at most a cell per
    source column, the amenities one per amenity that the item has.
    """
    if amenities_top < 0:
        raise ValueError("amenities top cannot be negative")
    spark = aligned.sparkSession
    fixed = log_block(aligned) | count_block(aligned) | coordinate_block(aligned)
    names: list[DataFrame] = [_named(spark, list(fixed), 0)]
    cells = [_cell(F.lit(position), value) for position, value in enumerate(fixed.values())]
    width = len(fixed)

    encoded, categories = _category_slots(aligned, broadcast_rows, group_rows)
    for name, size, vocabulary in categories:
        names.append(_category_names(name, vocabulary, width))
        cells.append(_cell(F.col(f"{name}_slot") + width, F.lit(1.0)))
        width += size

    held = F.array().cast(_CELLS)
    best = _best_amenities(aligned, amenities_top)
    if best:
        wanted, start = F.array(*(F.lit(value) for value in best)), width - 1
        places = F.transform(F.array_distinct("amenity_list"), lambda value: F.array_position(wanted, value))
        found = F.filter(places, lambda place: place > 0)
        held = F.coalesce(F.transform(found, lambda place: _cell(place + start, F.lit(1.0))).cast(_CELLS), held)
        names.append(_named(spark, [f"amenity={value}" for value in best], width))
        width += len(best)

    for name, buckets in contract.HASHED_FEATURES.items():
        # The missing indicator comes first, then the buckets.
        cells.append(_cell(F.coalesce(F.col(f"{name}_bucket") + 1, F.lit(0)) + width, F.lit(1.0)))
        width += 1 + buckets
    hashed_names, _ = hash_block()
    names.append(_named(spark, hashed_names, width - len(hashed_names)))

    listed = F.concat(F.array(*cells).cast(_CELLS), held)
    is_set = F.filter(listed, lambda cell: cell["position"].isNotNull() & (cell["value"] != 0))
    rows = hash_buckets(encoded).select("dense_id", F.array_sort(is_set).alias("cells"))
    vectors = rows.select("dense_id", F.col("cells.position").alias("indices"), F.col("cells.value").alias("values"))
    padding = spark.range(1).select(
        F.lit(0).cast(aligned.schema["dense_id"].dataType).alias("dense_id"),
        F.array().cast("array<int>").alias("indices"),
        F.array().cast("array<float>").alias("values"),
    )
    return SparseFeatures(vectors.unionByName(padding), reduce(DataFrame.unionByName, names), width)


_CELLS = "array<struct<position: int, value: float>>"


def _cell(position: Column, value: Column) -> Column:
    return F.struct(position.cast("int").alias("position"), value.cast("float").alias("value"))


def dense_view(result: SparseFeatures) -> ItemFeatures:
    """Sparse vectors at full width: the zeros between neighbouring positions are filled in."""

    def zeros(count: Column) -> Column:
        return F.array_repeat(F.lit(0.0).cast("float"), count.cast("int"))

    def filled(value: Column, place: Column) -> Column:
        before = F.coalesce(F.get("indices", place - 1), F.lit(-1))
        return F.concat(zeros(F.get("indices", place) - before - 1), F.array(value))

    last = F.coalesce(F.get("indices", F.size("indices") - 1), F.lit(-1))
    features = F.concat(F.flatten(F.transform("values", filled)), zeros(F.lit(result.dimensions - 1) - last))
    rows = result.features.select("dense_id", features.alias("features"))
    return ItemFeatures(rows, result.columns, result.dimensions)


def sparse_cells(result: SparseFeatures) -> DataFrame:
    """One row per item and set position."""
    zipped = F.arrays_zip("indices", "values")
    cells = result.features.select("dense_id", F.explode(zipped).alias("cell"))
    cells = cells.select("dense_id", F.col("cell.indices").alias("position"), F.col("cell.values").alias("value"))
    named = join_skewed(cells, result.columns, ["position"], side_rows=result.dimensions)
    return named.select("dense_id", "position", "name", "value")


def sparse_stats(result: SparseFeatures) -> DataFrame:
    """``matrix_stats`` of sparse vectors; positions out of order or range make a vector's width -1."""
    finite = F.forall("values", lambda value: ~F.isnan(value) & (F.abs(value) < float("inf")) & (value != 0))
    rising = F.transform("indices", lambda index, place: index > F.coalesce(F.get("indices", place - 1), F.lit(-1)))
    fits = F.forall(rising, lambda ok: ok) & (F.coalesce(F.array_max("indices"), F.lit(-1)) < result.dimensions)
    fits = fits & (F.size("indices") == F.size("values"))
    width = F.when(fits, result.dimensions).otherwise(-1)
    return result.features.agg(
        F.count("*").alias("rows"),
        F.max("dense_id").cast("bigint").alias("num_items"),
        F.min(width).alias("min_width"),
        F.max(width).alias("max_width"),
        F.count_if(~finite).alias("not_finite"),
        F.count_if((F.col("dense_id") == 0) & (F.size("indices") > 0)).alias("padding_not_zero"),
    )


def _category_slots(
    aligned: DataFrame, broadcast_rows: int, group_rows: int
) -> tuple[DataFrame, list[tuple[str, int, DataFrame]]]:
    """The items with ``{column}_slot``, the zero-based rank of their value; per column its size and vocabulary."""
    encoded = aligned
    categories = [name for name in contract.ONE_HOT_FEATURES if name in aligned.columns]
    ranked = vocabularies(aligned, categories)
    found = ranked.groupBy("column").agg(F.count("*").alias("values")).collect()
    sizes = {row["column"]: row["values"] for row in found}
    listed = []
    for name in categories:
        own = ranked.filter(F.col("column") == name).select("value", (F.col("rank") - 1).alias("slot"))
        key = f"{name}_key"
        keyed = F.col(name).cast("string").alias(key)
        encoded = join_skewed(
            encoded.select("*", keyed),
            own.select(F.col("value").alias(key), F.col("slot").alias(f"{name}_slot")),
            [key],
            "left",
            broadcast_rows,
            group_rows,
            sizes.get(name, 0),
            keyed_like=aligned.select(keyed),
        )
        listed.append((name, sizes.get(name, 0), own))
    return encoded, listed


def _category_names(name: str, vocabulary: DataFrame, start: int) -> DataFrame:
    return vocabulary.select(
        (F.col("slot") + start).cast("int").alias("position"),
        F.concat(F.lit(f"{name}="), "value").alias("name"),
    )


def _best_amenities(aligned: DataFrame, top: int) -> list[str]:
    if "amenity_list" not in aligned.columns or not top:
        return []
    return [row["value"] for row in top_amenities(aligned, top).orderBy("rank").take(top)]


def _named(spark: SparkSession, names: list[str], start: int) -> DataFrame:
    """A block of column names as a table of positions."""
    listed = F.from_json(F.lit(json.dumps(names)), "array<string>")
    slots = spark.range(1).select(F.posexplode(listed).alias("slot", "name"))
    return slots.select((F.col("slot") + start).alias("position"), "name")


def long_features(result: ItemFeatures, wanted: Column | None = None) -> DataFrame:
    """One row per item and vector position; ``wanted`` picks positions by ``name``."""
    cells = result.features.select("dense_id", F.posexplode("features").alias("position", "value"))
    columns = result.columns if wanted is None else result.columns.filter(wanted)
    named = join_skewed(cells, columns, ["position"], side_rows=result.dimensions)
    return named.select("dense_id", "position", "name", "value")


def matrix_stats(result: ItemFeatures) -> DataFrame:
    """Shape and invariants of the matrix, in one pass."""
    finite = F.forall("features", lambda value: ~F.isnan(value) & (F.abs(value) < float("inf")))
    zero = F.forall("features", lambda value: value == 0)
    return result.features.agg(
        F.count("*").alias("rows"),
        F.max("dense_id").cast("bigint").alias("num_items"),
        F.min(F.size("features")).alias("min_width"),
        F.max(F.size("features")).alias("max_width"),
        F.count_if(~finite).alias("not_finite"),
        F.count_if((F.col("dense_id") == 0) & ~zero).alias("padding_not_zero"),
    )
