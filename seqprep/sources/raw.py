"""Regional CSV sources.

Layout: ``<root>/<listings|listing>/<region>/*.csv.gz`` and ``<root>/<events|event>/<region>/...``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from seqprep.sources.schema import expect_columns
from seqprep.sources.tables import by_region, counted, in_regions, write_load

LISTING_FOLDERS = ("listings", "listing")
EVENT_FOLDERS = ("events", "event")
FILE, LINE = "source_file", "unparsed_line"  # columns that a scan adds
SPREAD_BYTES = 64 << 20  # a compressed file above this makes the scan deal out its rows
TASK_BYTES = 16 << 20  # compressed bytes per task then


def check_regions(regions: Sequence[str]) -> list[str]:
    regions = list(regions)
    if not regions or len(set(regions)) != len(regions):
        raise ValueError("regions must be non-empty and unique")
    return regions


def _files(spark: SparkSession, pattern: str | Sequence[str]) -> DataFrame | None:
    """Names, sizes and times of the matching files (contents are not read), or None."""
    try:
        found = spark.read.format("binaryFile").load(pattern)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return found.select("path", "length", "modificationTime")


def source_folder(spark: SparkSession, root: str, folders: Sequence[str]) -> str:
    """The first of the accepted folder names that holds any region's files."""
    for folder in folders:
        if _files(spark, f"{root}/{folder}/*/*.csv.gz") is not None:
            return folder
    raise FileNotFoundError(f"none of the expected source folders exist under {root}: {folders}")


def region_pattern(root: str, folder: str, region: str) -> str:
    return f"{root}/{folder}/{region}/*.csv.gz"


def listed_files(spark: SparkSession, root: str, folders: Sequence[str], regions: Iterable[str]) -> DataFrame:
    """(region, path, length, modified) of every file of the regions; contents are not read."""
    folder = source_folder(spark, root, folders)
    parts = []
    for region in regions:
        files = _files(spark, region_pattern(root, folder, region))
        if files is None:
            raise FileNotFoundError(f"no .csv.gz files found for {region} in {root}/{folder}")
        parts.append(files.select(F.lit(region).alias("region"), "path", "length", F.unix_micros("modificationTime").alias("modified")))
    return reduce(DataFrame.unionByName, parts)


def added_files(current: DataFrame, loaded: DataFrame) -> dict[str, list[str] | None]:
    """Per region the files that no load has read yet; None where a loaded file changed or is gone.

    Both tables are as ``listed_files`` makes them. The driver gets the paths of new files.
    """
    gone = {row["region"] for row in loaded.join(current, current.columns, "left_anti").select("region").distinct().collect()}
    found: dict[str, list[str] | None] = {}
    for row in current.join(loaded, current.columns, "left_anti").select("region", "path").collect():
        found.setdefault(row["region"], []).append(row["path"])
    return found | dict.fromkeys(gone)


def _part(spark: SparkSession, pattern: str | Sequence[str]) -> DataFrame:
    """Text columns by the header, the file's name, and the whole line where it has other than the header's fields."""
    header = spark.read.option("header", True).csv(pattern).schema
    reader = spark.read.schema(header.add(LINE, "string")).option("header", True).option("enforceSchema", False)
    # Without pruning a line is held against all columns, whichever are used later.
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", LINE).option("columnPruning", False)
    return reader.csv(pattern).withColumn(FILE, F.col("_metadata.file_name"))


def scan_csv(
    spark: SparkSession,
    root: str,
    folders: Sequence[str],
    regions: Iterable[str],
    files: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """All regions, or of each only the given ``files``, as one table of text columns plus ``region``, ``FILE`` and ``LINE``.

    Columns that only some regions have are NULL elsewhere. Within a region every file must have
    the same header; another column order fails instead of being read by position. A line with too few fields
    has NULLs, one with too many loses the last ones; both keep their text in ``LINE``, which is NULL otherwise.
    """
    regions = list(regions)
    folder = source_folder(spark, root, folders)
    parts = []
    for region in regions:
        pattern = list(files[region]) if files else region_pattern(root, folder, region)
        if _files(spark, pattern) is None:
            raise FileNotFoundError(f"no .csv.gz files found: {pattern}")
        parts.append(_part(spark, pattern).withColumn("region", F.lit(region)))
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)


@dataclass(frozen=True)
class Scan:
    """Rows of a regional scan; the lines among them that did not parse; and the number of both, once read.

    ``rows`` holds all lines, padded or cut to the header, unless the scan was told to leave out the others.
    """

    rows: DataFrame
    rejects: DataFrame
    seen: Observation

    def counts(self) -> dict[str, int]:
        """Lines read, rejected, and without a key; only after ``rows`` was written or collected."""
        found = self.seen.get
        return {"lines": found["rows"], "rejected": found["rejected"], "no_key": found["no_key"]}

    def region_counts(self) -> dict[tuple[str, str], int]:
        """(region, ``lines`` or ``rejected``) to a number; only after ``rows`` was written or collected."""
        return by_region(self.seen.get)


def checked_scan(
    spark: SparkSession,
    root: str,
    folders: Sequence[str],
    regions: Iterable[str],
    required: Sequence[str],
    label: str,
    keep_rejects: bool = True,
    files: Mapping[str, Sequence[str]] | None = None,
) -> Scan:
    """Scan, with the required columns checked; text of large files is dealt out to more tasks.

    One gzip file is one task up to the next shuffle, whatever its size. Rejects are counted in the same pass
    as rows; reading ``rejects`` (region, file, key, line) is a scan of its own, for when there are some.
    """
    regions = list(regions)
    scanned = scan_csv(spark, root, folders, regions, files)
    expect_columns(scanned, required, label)
    # Spark reads the rejected line only along with a column of the file: the key.
    rejects = scanned.filter(F.col(LINE).isNotNull()).select(
        "region", F.col(FILE).alias("file"), F.col(required[0]).alias("key"), F.col(LINE).alias("line")
    )
    totals = {"rejected": F.count(LINE), "no_key": F.count_if(F.col(required[0]).isNull())}
    each = in_regions(regions, "lines") | in_regions(regions, "rejected", F.col(LINE).isNotNull())
    rows, seen = counted(scanned, **totals, **each)
    if not keep_rejects:
        rows = rows.filter(F.col(LINE).isNull())
    rows = rows.drop(FILE, LINE)
    folder = source_folder(spark, root, folders)
    read = [_files(spark, list(files[r]) if files else region_pattern(root, folder, r)) for r in regions]
    sizes = reduce(DataFrame.unionByName, read).agg(F.max("length").alias("most"), F.sum("length").alias("all"))
    size = sizes.first()
    if size["most"] > SPREAD_BYTES:
        rows = rows.repartition(max(2, size["all"] // TASK_BYTES))
    return Scan(rows, rejects, seen)


def write_rejects(scan: Scan, path: str, load: str) -> int:
    """Store the rejected lines of a load by region, if its scan met any; call it when the rows have been read."""
    rejected = scan.counts()["rejected"]
    if rejected:
        write_load(scan.rejects, path, load)
    return rejected


def input_fingerprints(files: DataFrame) -> DataFrame:
    """One fingerprint per region over paths, sizes and times of its files, as ``listed_files`` gives them."""
    each = F.xxhash64("path", "length", "modified")
    return files.groupBy("region").agg(F.count("*").alias("files"), F.bit_xor(each).alias("fingerprint"))
