"""Data-quality checks.

A check looks for offending rows of a table. ``all_checks`` gives ``(check_name, violations, examples)``, a row per
check: the count of offending rows, or of distinct offending keys with up to five of them as text. Checks on one table
share one scan of it. ``enforce`` runs checks and raises on those that found any.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from seqprep import contract
from seqprep.sources.spool import spool

EXAMPLES = 5
PARTS = 256  # into which the offending keys of a check are dealt

MESSAGES = {
    "unknown_behavior": "event types outside the code table",
    "bad_intensity": "intensities that are negative or no number",
    "smap_not_contiguous": "item map ids are not exactly 1 to n",
    "sid_not_in_events": "mapped items that no event has",
    "item_not_in_catalog": "event items that the catalogue lacks",
    "duplicate_canonical": "catalogue ids with several rows",
    "null_event_key": "events without item keys",
    "sid_conflict": "item numbers shared by several listings",
    "empty_region": "regions left without any session",
    "no_rows": "nothing is left",
    "target_absent": "no event has the target behaviour",
    "matrix_invariant": "vectors with odd values, widths or padding",
}


class CheckFailed(ValueError):
    """A data-quality check found violations."""


@dataclass(frozen=True, eq=False)
class Check:
    """What offends in the rows of a table.

    ``weight`` is what a row adds to the violations, nothing if NULL or 0. With ``key`` distinct values of that column
    are counted instead, of those that at least ``least`` such rows have. ``absent`` checks are violated, once, if no
    row has a weight.
    """

    name: str
    table: DataFrame
    weight: Column
    key: str | None = None
    least: int = 1
    absent: bool = False

    def first(self) -> Row:
        """The result of this check alone."""
        return all_checks([self]).first()


def unknown_behaviors(
    events: DataFrame, column: str = "event_type", codes: Iterable[str] = contract.BEHAVIOR_IDS
) -> Check:
    known = F.coalesce(F.col(column).isin(*codes), F.lit(False))
    return Check("unknown_behavior", events, (~known).cast("int"), column)


def bad_intensity(events: DataFrame) -> Check:
    value = F.col("intensity").cast("double")
    good = F.coalesce((value >= 0) & (value < float("inf")) & ~F.isnan(value), F.lit(False))
    return Check("bad_intensity", events, (~good).cast("int"))


def _neighbours(keys: DataFrame, column: str, steps_of_one: bool) -> DataFrame:
    """Rows of a column, and how many break its order: repeats, NULLs, and with ``steps_of_one`` also gaps.

    The column is range partitioned, sorted and stored, so a row meets its neighbour inside its partition; the
    partitions' first and last values, one row each, settle what happens between them.
    """
    sorted_keys = keys.select(F.col(column).alias("key")).repartitionByRange("key").sortWithinPartitions("key")
    stored = spool(sorted_keys.select("key", F.spark_partition_id().alias("part")), "check-order")
    before = F.lag("key").over(Window.partitionBy("part").orderBy("key"))
    step = F.col("key") - F.col("before") if steps_of_one else F.lit(None).cast("bigint")
    broken = (F.col("key") == F.col("before")) | F.col("key").isNull()
    if steps_of_one:
        broken = broken | (step != 1)
    inside = stored.withColumn("before", before).groupBy("part").agg(
        F.count("*").alias("rows"), F.count_if(broken).alias("broken"), F.min("key").alias("key"), F.max("key").alias("last")
    )
    previous = F.lag("last").over(Window.orderBy("part"))  # a row per partition
    between = (F.col("key") != F.col("before") + 1) if steps_of_one else (F.col("key") == F.col("before"))
    return inside.withColumn("before", previous).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("broken"), F.lit(0)).alias("inside"),
        F.count_if(between).alias("between"),
        F.min("key").alias("least"),
    )


def smap_not_contiguous(smap: DataFrame) -> Check:
    """Any of: empty, ids not 1..n, repeated ids, repeated sids."""
    out_of_order = F.col("inside") + F.col("between") > 0
    not_from_one = (F.col("rows") == 0) | (F.coalesce("least", F.lit(0)) != 1)
    ids = _neighbours(smap, "dense_id", steps_of_one=True).select((out_of_order | not_from_one).alias("broken"))
    sids = _neighbours(smap, "sid", steps_of_one=False).select(out_of_order.alias("broken"))
    both = ids.unionByName(sids).agg(F.max("broken").alias("broken"))
    return Check("smap_not_contiguous", both, F.col("broken").cast("int"))


def sids_not_in_events(smap: DataFrame, sid_canonical: DataFrame) -> Check:
    return Check("sid_not_in_events", smap.join(sid_canonical, "sid", "left_anti"), F.lit(1), "sid")


def items_not_in_catalog(
    sid_canonical: DataFrame, items: DataFrame, smap: DataFrame | None = None
) -> Check:
    """Canonical ids of the model's items that the catalogue lacks (all event items without smap)."""
    used = sid_canonical if smap is None else sid_canonical.join(smap, "sid", "left_semi")
    key = "canonical_listing_id"
    return Check("item_not_in_catalog", used.join(items, key, "left_anti"), F.lit(1), key)


def duplicate_canonicals(items: DataFrame) -> Check:
    return Check("duplicate_canonical", items, F.lit(1), "canonical_listing_id", least=2)


def null_event_keys(events: DataFrame) -> Check:
    missing = F.col("sid").isNull() | F.col("canonical_listing_id").isNull()
    return Check("null_event_key", events, missing.cast("int"))


def sid_conflicts(sid_canonical: DataFrame) -> Check:
    return Check("sid_conflict", sid_canonical, F.lit(1), "sid", least=2)


def empty_regions(regions: DataFrame, events: DataFrame, region: str = "region") -> Check:
    """Expected regions without a single session event."""
    present = events.select(region).distinct()
    return Check("empty_region", regions.join(present, region, "left_anti"), F.lit(1), region)


def no_rows(df: DataFrame) -> Check:
    return Check("no_rows", df, F.lit(1), absent=True)


def target_absent(kept: DataFrame, target: str, column: str = "behavior") -> Check:
    return Check("target_absent", kept, (F.col(column) == target).cast("int"), absent=True)


def matrix_invariants(stats: DataFrame) -> Check:
    broken = (
        F.col("not_finite")
        + F.col("padding_not_zero")
        + (F.col("min_width") != F.col("max_width")).cast("int")
    )
    return Check("matrix_invariant", stats, broken)


def _offences(placed: list[tuple[int, Check]]) -> DataFrame:
    """(place, key, weight) of all rows of one table that offend in one of its checks, in one scan."""
    table = placed[0][1].table

    def offence(place: int, check: Check) -> Column:
        key = F.lit(None) if check.key is None else F.col(check.key)
        return F.struct(
            F.lit(place).alias("place"), key.cast("string").alias("key"), check.weight.cast("bigint").alias("weight")
        )

    if all(check.absent for _, check in placed):  # one row tells
        found = [table.filter(check.weight > 0).limit(1).select(offence(place, check)) for place, check in placed]
        return reduce(DataFrame.unionByName, found).toDF("one").select("one.*")
    offending = table.filter(reduce(lambda one, two: one | two, [check.weight > 0 for _, check in placed]))
    each = F.array(*(F.when(check.weight > 0, offence(place, check)) for place, check in placed))
    return offending.select(F.inline(F.array_compact(each)))


def all_checks(checks: Iterable[Check]) -> DataFrame:
    """A row per check, all in one plan.

    Offences are summed up by check and key ahead of the shuffle. Keys that offend are dealt into ``PARTS``, numbered
    there, and each part passes on its count and its first few, so no task gathers the keys of a check.
    """
    placed = list(enumerate(checks))
    tables: dict[int, list[tuple[int, Check]]] = {}
    for place, check in placed:
        tables.setdefault(id(check.table), []).append((place, check))
    offences = reduce(DataFrame.unionByName, [_offences(own) for own in tables.values()])

    def of_check(values: Iterable) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), F.col("place") + 1)

    part = F.pmod(F.xxhash64("key"), F.lit(PARTS)).alias("part")
    keys = offences.groupBy("place", part, "key").agg(F.sum("weight").alias("weight"))
    keys = keys.filter(F.col("weight") >= of_check(check.least for _, check in placed))
    number = F.row_number().over(Window.partitionBy("place", "part").orderBy(F.asc_nulls_first("key")))
    parts = keys.withColumn("number", number).groupBy("place", "part").agg(
        F.sum("weight").alias("weight"),
        F.max("number").cast("bigint").alias("keys"),
        F.collect_list(F.when(F.col("number") <= EXAMPLES, F.struct("key"))).alias("first"),
    )
    nothing = F.array(*(F.lit(place) for place, _ in placed))
    unoffended = offences.sparkSession.range(1).select(
        F.explode(nothing).alias("place"),
        F.lit(0).cast("bigint").alias("weight"),
        F.lit(0).cast("bigint").alias("keys"),
        F.array().cast("array<struct<key:string>>").alias("first"),
    )
    total = parts.drop("part").unionByName(unoffended).groupBy("place").agg(
        F.sum("weight").alias("weight"), F.sum("keys").alias("keys"), F.flatten(F.collect_list("first")).alias("first")
    )
    keyed = of_check(check.key is not None for _, check in placed)
    none_found = (F.col("weight") == 0).cast("bigint")
    examples = F.filter(F.slice(F.array_sort("first"), 1, EXAMPLES)["key"], lambda key: key.isNotNull())
    return total.select(
        of_check(check.name for _, check in placed).alias("check_name"),
        F.when(keyed, F.col("keys"))
        .when(of_check(check.absent for _, check in placed), none_found)
        .otherwise(F.col("weight"))
        .alias("violations"),
        F.when(keyed, examples).otherwise(F.array().cast("array<string>")).alias("examples"),
    )


def enforce(checks: Iterable[Check]) -> None:
    """Run all checks as one job and raise for those that found something."""
    checks = list(checks)
    failed = all_checks(checks).filter("violations > 0").take(len(checks))
    if failed:
        raise CheckFailed(
            "; ".join(
                f"{MESSAGES[row['check_name']]}: {row['violations']} violation(s)"
                + (f", e.g. {row['examples']}" if row["examples"] else "")
                for row in failed
            )
        )
