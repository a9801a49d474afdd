"""Mixing sources to target weights by hash thresholds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from seqprep.sources.spool import spool

WEIGHTS = (3, 1, 2)  # of the sources in code-point order, repeating
BUDGET = (3, 2)  # all targets together, as a fraction of all sizes
REPEATS = 2  # a document is taken so many times at most
DIGITS = 3  # hexadecimal digits of the hash that a histogram tells apart: 4096 buckets
LEVELS = 4  # histograms, each over the boundary bucket of the one before


def size_of(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, budget: tuple[int, int] = BUDGET, repeats: int = REPEATS
) -> DataFrame:
    """(source, source_size) to (source, source_size, target), one row per source.

    Shares are given by weight; a source stops at ``repeats`` times its size and the rest is shared again by
    weight. With sources ordered by size per weight, those that stop come first, so one running sum settles
    who stops and what one unit of weight is worth to the others. Sources without any words get 0.
    """
    places = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    everything = Window.partitionBy()
    ranked = (
        sizes.withColumn("place", F.row_number().over(places) - 1)
        .withColumn("weight", weight.cast("bigint"))
        .withColumn("cap", F.col("source_size") * repeats)
        .withColumn("all_sizes", F.sum("source_size").over(everything))
        .withColumn("all_weights", F.sum("weight").over(everything))
    )
    earlier = Window.orderBy((F.col("cap") / F.col("weight")).asc(), "place").rowsBetween(
        Window.unboundedPreceding, -1
    )
    left = F.col("all_sizes") * budget[0] / budget[1] - F.coalesce(F.sum("cap").over(earlier), F.lit(0))
    open_weights = F.col("all_weights") - F.coalesce(F.sum("weight").over(earlier), F.lit(0))
    worth = ranked.withColumn("worth", left / open_weights)
    # The value that holds is that of the first source that does not stop; from there on values fall.
    level = F.max(F.when(F.col("worth") * F.col("weight") < F.col("cap"), F.col("worth"))).over(everything)
    target = F.least(F.col("cap").cast("double"), F.coalesce(level * F.col("weight"), F.col("cap").cast("double")))
    return worth.select("source", "source_size", target.alias("target"))


def hash_digits(identity: Column) -> Column:
    """Hexadecimal digits that place a document: MD5 of its id as text (null: empty)."""
    return F.substring(F.md5(F.coalesce(identity.cast("string"), F.lit(""))), 1, DIGITS * LEVELS)


def mix_limits(
    docs: DataFrame,
    identity: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: Sequence[int] = WEIGHTS,
    budget: tuple[int, int] = BUDGET,
    repeats: int = REPEATS,
) -> tuple[DataFrame, DataFrame]:
    """Stored (doc_id, source, size, digits) of all rows, and one row per source that decides on them.

    The limits hold source_size, target, copies that every document gets, and the hash digits up to which it
    gets one more.
    """
    narrow = docs.select(
        F.col(identity).alias("doc_id"),
        F.col(source).alias("source"),
        size_of(F.col(text)).alias("size"),
        hash_digits(F.col(identity)).alias("digits"),
    )
    narrow = spool(narrow, "mix-sizes")
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = source_targets(sizes, weights, budget, repeats)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = spool(
        plan.withColumn("copies", F.least(whole, F.lit(repeats)).cast("bigint")).withColumn(
            "left", F.col("target") - F.col("copies") * F.col("source_size")
        ),
        "mix-plan",
    )
    threshold = plan.select("source", "left", F.lit("").alias("digits_below"))
    for step in range(1, LEVELS + 1):
        threshold = spool(_open_bucket(narrow, threshold, step), "mix-threshold")
    limits = plan.join(
        threshold.select(F.col("source").alias("at"), "digits_below", "take_last"),
        F.col("source").eqNullSafe(F.col("at")),
        "left",
    ).drop("at")
    return narrow, spool(limits.drop("left"), "mix-limits")


def take_by_limits(rows: DataFrame, limits: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """Add source_size, target, taken and copies to rows with source, size and digits; each row is decided alone."""
    below = (F.col("digits") < F.col("digits_below")) | (
        (F.col("digits") == F.col("digits_below")) & F.col("take_last")
    )
    more = F.least(F.col("copies") + F.coalesce(below, F.lit(False)).cast("bigint"), F.lit(repeats))
    # One row per source; Spark broadcasts it only if its size allows.
    joined = rows.join(limits.withColumnRenamed("source", "at"), F.col("source").eqNullSafe(F.col("at")), "left")
    return joined.select(
        *rows.columns, "source_size", "target", (F.col("size") * more).alias("taken"), more.alias("copies")
    )


def mix_sources(
    docs: DataFrame,
    identity: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: Sequence[int] = WEIGHTS,
    budget: tuple[int, int] = BUDGET,
    repeats: int = REPEATS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source, source_size, target, taken, copies.

    Every document is taken ``floor(target / source_size)`` times, and once more if its hash is below the
    source's threshold. The threshold comes from nested histograms: sizes summed by source and hash bucket,
    the bucket where the running sum passes the budget opened into finer buckets, and so on; no rows are
    sorted, and only the few rows of boundary buckets are looked at again. The last bucket is taken if that
    comes nearer to the target (half or more of it fits). Rows with one id stand or fall together, hash
    included, so a rerun decides alike. Null text has size 0; a null source is a source of its own, last in
    order; null ids share one hash. An empty table gives an empty result; other columns are not looked at.
    """
    narrow, limits = mix_limits(docs, identity, source, text, weights, budget, repeats)
    return take_by_limits(narrow, limits, repeats).select(
        "doc_id", "size", "source", "source_size", "target", "taken", "copies"
    )


def _open_bucket(narrow: DataFrame, threshold: DataFrame, step: int) -> DataFrame:
    """The bucket, one level finer, in which the running sum passes what is left of each source."""
    opened = threshold.select(F.col("source").alias("at"), "left", "digits_below")
    inside = narrow.join(
        opened,
        F.col("source").eqNullSafe(F.col("at")) & F.col("digits").startswith(F.col("digits_below")),
    )
    buckets = inside.groupBy("source", F.substring("digits", 1, DIGITS * step).alias("bucket")).agg(
        F.sum("size").alias("words"), F.first("left").alias("left")
    )
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("words").over(running), F.lit(0))
    passed = buckets.withColumn("before", before).filter(F.col("before") + F.col("words") > F.col("left"))
    first = passed.groupBy("source").agg(F.min_by(F.struct("bucket", "before", "words", "left"), "bucket").alias("b"))
    rest = F.col("b.left") - F.col("b.before")
    return first.select(
        "source",
        rest.alias("left"),
        F.col("b.bucket").alias("digits_below"),
        (rest * 2 >= F.col("b.words")).alias("take_last"),
    )
