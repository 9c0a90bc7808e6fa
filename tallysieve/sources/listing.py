"""File listings and admission: what is there, what may be read, and why not.

Only file metadata is read. A listing is a table with a row for each file, folder or link below the root, made by tasks.
Stores that tasks cannot open are listed by Spark's own file index, which holds all names on the driver and leaves out
hidden ones and folders without files.
"""

from __future__ import annotations

from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..plans.evaluate import Stage
from ..sinks.staging import Staging
from . import stores


@dataclass(frozen=True)
class Limits:
    """Admission limits; None switches one off."""

    entries: int | None = None
    archive_bytes: int | None = None
    file_bytes: int | None = None
    total_bytes: int | None = None
    compression_ratio: float | None = None


UNLIMITED = Limits()
PACKAGE_LIMITS = Limits(
    fv.MAX_ENTRIES, fv.MAX_ARCHIVE_BYTES, fv.MAX_FILE_BYTES, fv.MAX_TOTAL_BYTES, fv.MAX_COMPRESSION_RATIO
)


def over(c: Column, limit: float | None) -> Column:
    return F.lit(False) if limit is None else c > F.lit(limit)


def schema_hint(name: Column) -> Column:
    """Contract that a file name announces, NULL for unknown names; letter case does not matter."""
    low = F.lower(name)
    hint = F.when(low.rlike(fv.SALES_FILE_NAME), F.lit("vendas"))
    for file_name, contract in fv.DIMENSION_FILE_NAMES.items():
        hint = hint.when(low == file_name, F.lit(contract))
    return hint


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def relative_to(path: Column, root: str) -> Column:
    """Path below `root`; the part before it (scheme, host) is dropped as well."""
    bare = root.split("://", 1)[-1] if "://" in root else root.removeprefix("file:")
    bare = bare.rstrip("/") + "/"
    at = F.locate(bare, path)
    return F.when(at > 0, F.substring(path, at + len(bare), F.length(path))).otherwise(base_name(path))


def binary_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path)


def is_skipped(source_file: Column) -> Column:
    """Placeholders anywhere and the README at the top are no data."""
    return (base_name(source_file) == fv.PLACEHOLDER_NAME) | (F.lower(source_file) == fv.README_NAME.lower())


def _described(found: DataFrame) -> DataFrame:
    name = F.col("source_file")
    is_file = F.col("kind") == stores.FILE
    return found.withColumns({
        "schema_hint": F.when(is_file, schema_hint(base_name(name))), "skipped": is_file & is_skipped(name),
    })


def list_files(spark: SparkSession, root: str, stage: Stage | None = None) -> DataFrame:
    """What is below `root`: path, source_file, kind, length, modified, schema_hint, skipped."""
    if not stores.opens(root):
        return _described(_indexed(spark, root))
    found = stores.walk(spark, root, stage or Staging(spark))
    return _described(found.withColumn("modified", F.timestamp_micros(F.floor(F.col("modified_ns") / 1000))).drop("modified_ns"))


def _indexed(spark: SparkSession, root: str) -> DataFrame:
    """The same from Spark's file index."""
    files = binary_files(spark, root)
    # A scan leaves empty files out; the file index, which the driver holds anyway, still names them.
    names = spark.createDataFrame([(unquote(n),) for n in files.inputFiles()], "name string")
    key = lambda c: F.regexp_replace(c, r"^(\w+:)/+", "$1/")
    scanned = files.select("path", "length", "modificationTime").withColumn("key", key(F.col("path")))
    joined = names.withColumn("key", key(F.col("name"))).join(scanned, "key", "left")
    found = joined.select(
        F.coalesce("path", "name").alias("path"), F.coalesce("length", F.lit(0)).cast("bigint").alias("length"),
        F.col("modificationTime").alias("modified"),
    ).withColumns({"source_file": relative_to(F.col("path"), root), "kind": F.lit(stores.FILE)})
    parts = F.split("source_file", "/")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    folders = found.where(F.size(parts) > 1).select(F.explode(prefixes).alias("source_file")).distinct()
    return found.unionByName(folders.withColumn("kind", F.lit(stores.FOLDER)), allowMissingColumns=True)


def listing_problems(listing: DataFrame, limits: Limits = UNLIMITED) -> DataFrame:
    """(source_file, problem): links, unexpected, empty or oversized files, and broken totals."""
    name, size, kind = F.lower("source_file"), F.col("length"), F.col("kind")
    is_file = kind == stores.FILE
    per_entry = listing.where((kind != stores.FOLDER) & ~F.col("skipped")).select(
        "source_file",
        F.when(kind == stores.LINK, "link")
        .when(~is_file, "not a regular file")
        .when(~name.endswith(".csv") | (base_name(name) == ".csv"), "unexpected file")
        .when(size == 0, "empty file")
        .when(over(size, limits.file_bytes), "file over the size limit")
        .alias("problem"),
    )
    totals = (
        listing.agg(
            F.count(F.lit(1)).alias("entries"),
            F.coalesce(F.sum(F.when(is_file, size)), F.lit(0)).alias("bytes"),
            F.count_if(is_file & ~F.col("skipped")).alias("accepted"),
        )
        .select(
            F.lit("").alias("source_file"),
            F.explode(
                F.array(
                    F.when(over(F.col("entries"), limits.entries), "too many entries"),
                    F.when(over(F.col("bytes"), limits.total_bytes), "input over the total size limit"),
                    F.when(F.col("accepted") == 0, "no delimited file found"),
                )
            ).alias("problem"),
        )
    )
    return per_entry.unionByName(totals).where("problem is not null")


def find_batches(spark: SparkSession, folder: str, stage: Stage | None = None) -> DataFrame:
    """Archives in a folder, newest first, equal times by name."""
    found = list_files(spark, folder, stage).where((F.col("kind") == stores.FILE) & ~F.contains("source_file", F.lit("/")))
    archives = found.where(F.lower("source_file").endswith(".zip"))
    return archives.select("path", F.col("source_file").alias("name"), "length", "modified").orderBy(F.desc("modified"), F.asc("name"))


def pick_batch(batches: DataFrame, name: str | None = None) -> DataFrame:
    """The archive of that name, or the newest one."""
    chosen = batches if name is None else batches.where(F.col("name") == name)
    return chosen.orderBy(F.desc("modified"), F.asc("name")).limit(1)
