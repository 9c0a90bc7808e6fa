"""One batch of input: an archive, a folder or a single file, as four validated raw tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..contracts import CONTRACTS
from ..errors import ArchiveError, DelimitedError, IngestionError, InputError
from ..plans.evaluate import Stage
from ..sinks.staging import Staging
from . import archives, delimited, listing, ranges, stores

SHOWN_PROBLEMS = 20


def _refuse(problems: DataFrame, error: type[IngestionError]) -> None:
    """Raise with the first problems found and how many there are in all."""
    found = problems.limit(SHOWN_PROBLEMS + 1).collect()
    if not found:
        return
    text = "; ".join(": ".join(str(x) for x in row if x not in (None, "")) for row in found[:SHOWN_PROBLEMS])
    if len(found) > SHOWN_PROBLEMS:
        text += f"; {problems.count()} problems in all, {SHOWN_PROBLEMS} shown"
    raise error(text)


def combine(frames: Sequence[DataFrame], contract: str) -> DataFrame:
    """UNION ALL of the tables of one contract; a contract without table is an error."""
    if not frames:
        raise InputError(f"no table of contract {contract}")
    return reduce(DataFrame.unionByName, frames)


@dataclass(frozen=True)
class Batch:
    """Parsed input. `parsed` holds every record with file, contract and line, `inspected` a row for each file."""

    parsed: DataFrame
    inspected: DataFrame

    def table(self, contract: str) -> DataFrame:
        return delimited.contract_rows(self.parsed, contract)

    def tables(self) -> dict[str, DataFrame]:
        """All contracts; a batch that lacks one cannot be built."""
        names = self.inspected.where("problem is null").select("schema_name").distinct()
        present = {row[0] for row in names.collect()}  # one row per contract
        return {c: combine([self.table(c)] if c in present else [], c) for c in CONTRACTS}

    def summary(self) -> DataFrame:
        """Contract, format, header and number of rows of each file."""
        counted = self.parsed.where("problem is null and line > 1").groupBy("source_file").agg(F.count(F.lit(1)).alias("rows"))
        return (
            self.inspected.where("problem is null").join(counted, "source_file", "left")
            .select(
                "source_file", "schema_name", "encoding", "delimiter", F.col("fields").alias("headers"),
                F.coalesce("rows", F.lit(0)).alias("rows"),
            )
            .orderBy(F.lower("source_file"), "source_file")
        )

    def totals(self) -> DataFrame:
        return self.summary().agg(
            F.count(F.lit(1)).alias("total_files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows")
        )


def read_batch(
    spark: SparkSession,
    path: str,
    limits: listing.Limits = listing.UNLIMITED,
    stage: Stage | None = None,
    range_bytes: int = ranges.RANGE_BYTES,
) -> Batch:
    """Validate and read one input. Every refused file refuses the whole batch.

    The parse runs once: its rows are written to the shared folder and read from there. Files of a folder are read in
    ranges of `range_bytes`; members of an archive, and files of stores that only Spark opens, are one unit each.
    """
    keep = stage or Staging(spark)
    suffix = path.rstrip("/").rsplit("/", 1)[-1].lower()
    if suffix.endswith(".zip"):
        inspected, parsed = _whole_files(_archive_files(spark, path, limits, keep), keep)
    elif stores.opens(path):
        files = _admitted(spark, path, limits, keep)
        inspected, parsed = ranges.read_ranged(files, keep, size=range_bytes)
    else:
        _admitted(spark, path, limits, keep)
        inspected, parsed = _whole_files(_spark_files(spark, path), keep)
    parsed = keep("parsed", parsed)
    _refuse(parsed.where("problem is not null").select("source_file", "problem"), DelimitedError)
    return Batch(parsed, inspected)


def _whole_files(files: DataFrame, stage: Stage) -> tuple[DataFrame, DataFrame]:
    inspected = stage("inspected", delimited.inspect_files(files).drop("content"))
    return inspected, delimited.parse_files(files)


def _archive_files(spark: SparkSession, path: str, limits: listing.Limits, stage: Stage) -> DataFrame:
    files = listing.binary_files(spark, path)
    oversized = files.where(listing.over(F.col("length"), limits.archive_bytes))
    _refuse(oversized.select("path", F.lit("archive over the size limit")), ArchiveError)
    members = stage("manifest", archives.manifest(files))
    _refuse(archives.member_problems(members, limits), ArchiveError)
    expanded = stage("expanded", archives.expand(files, limits))
    _refuse(expanded.where("problem is not null").select("source_file", "problem"), ArchiveError)
    return expanded.select("source_file", "schema_hint", "content")


def _admitted(spark: SparkSession, path: str, limits: listing.Limits, stage: Stage) -> DataFrame:
    """The files to read, after all that is there was found fit."""
    try:
        found = stage("listing", listing.list_files(spark, path, stage))
    except AnalysisException as error:
        raise InputError(f"no such input: {path}") from error
    _refuse(listing.listing_problems(found, limits), InputError)
    return found.where((F.col("kind") == stores.FILE) & ~F.col("skipped"))


def _spark_files(spark: SparkSession, path: str) -> DataFrame:
    name = listing.relative_to(F.col("path"), path)
    content = listing.binary_files(spark, path).withColumn("source_file", name).where(~listing.is_skipped(F.col("source_file")))
    hinted = content.withColumn("schema_hint", listing.schema_hint(listing.base_name(F.col("source_file"))))
    return hinted.select("source_file", "schema_hint", "content")
