"""Versioned publishing: every table under its version, then one numbered entry in the version log.

Readers resolve tables through the entry with the highest number, so a run that fails half-way leaves the previous version
live, and nothing published is ever overwritten. An entry appears whole and only where none of its number is, whatever
clocks say: of two writers that reach for the same number one goes on to the next. A writer that builds on a version names
it, and is refused if another one was committed since.

Each entry says of its tables how many rows they have and a fingerprint that no order of rows changes. Both are observed
while the tables are written, so that nothing is read twice.
"""

from __future__ import annotations

import json
import operator
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..errors import ConflictError
from ..functions.dates import month_of
from ..operators.explore import MONTH_PARTITION
from ..sources import stores

VERSION_LOG = "versions"
LOG_SCHEMA = "number bigint, version string, tables array<struct<name: string, rows: bigint, total: string, mixed: bigint>>"
Facts = dict[str, object]


def new_version() -> str:
    return uuid.uuid4().hex


# --- fingerprints ------------------------------------------------------------------------------------
def row_hashes(columns: list[str]) -> tuple[Column, Column]:
    """Two hashes of a row; NULLs hash by their place."""
    places = F.array(*[F.col(c).isNull() for c in columns])
    return F.xxhash64(F.lit(1), places, *columns), F.xxhash64(F.lit(2), places, *columns)


def row_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row (missing, added): how many rows of `a` are not in `b`, and of `b` not in `a`, repeated rows counted.

    Rows meet by both hashes of all their columns, 128 bits, so what is shuffled is 24 bytes a row and not the row.
    """
    first, second = (h.alias(n) for h, n in zip(row_hashes(sorted(a.columns)), ("f", "g")))
    sides = [df.select(first, second, F.lit(sign).alias("n")) for df, sign in ((a, 1), (b, -1))]
    left = sides[0].unionAll(sides[1]).groupBy("f", "g").agg(F.sum("n").alias("n")).where("n <> 0")
    count = lambda c: F.coalesce(F.sum(F.greatest(c, F.lit(0))), F.lit(0)).cast("bigint")
    return left.agg(count(F.col("n")).alias("missing"), count(-F.col("n")).alias("added"))


def row_facts(columns: list[str]) -> list[Column]:
    """Aggregates that name a multiset of rows: its size, and the sum and the exclusive or of two hashes of its rows.

    The sum counts repeated rows, which the exclusive or cannot see in pairs; NULLs hash by their place.
    """
    first, second = row_hashes(columns)
    return [
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(first.cast("decimal(20,0)")), F.lit(0)).cast("string").alias("total"),
        F.coalesce(F.bit_xor(second), F.lit(0)).alias("mixed"),
    ]


def fingerprint(df: DataFrame) -> Facts:
    """(rows, total, mixed) of any frame in one aggregate; equal for equal rows in any order and number of files."""
    return df.agg(*row_facts(sorted(df.columns))).collect()[0].asDict()


# --- tables ------------------------------------------------------------------------------------------
def published_form(df: DataFrame) -> DataFrame:
    """Dates are published as zone-free timestamps at midnight."""
    days = [f.name for f in df.schema.fields if f.dataType.typeName() == "date"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in days})


def merged(facts: list[Facts]) -> Facts:
    """The facts of a table from those of the parts that it was written in."""
    return {
        "name": facts[0]["name"], "rows": sum(f["rows"] for f in facts), "total": str(sum(int(f["total"]) for f in facts)),
        "mixed": reduce(operator.xor, [f["mixed"] for f in facts]),
    }


def write_table(df: DataFrame, root: str, version: str, name: str, by_month: str | None = None, mode: str = "overwrite") -> Facts:
    """One table of one version as ZSTD Parquet, or with mode `append` a further part of it; gives the facts of what it wrote.
    With `by_month`, one folder per month of that date column.

    Rebalancing lets AQE split a month that holds most of the rows and merge the small ones. Facts are observed behind
    that shuffle: a task that runs again there counts once.
    """
    out = published_form(df)
    columns = sorted(out.columns)
    if by_month is not None:
        out = out.withColumn(MONTH_PARTITION, month_of(F.col(by_month))).hint("rebalance", MONTH_PARTITION)
    seen = Observation(f"{name} {version} {uuid.uuid4().hex}")
    writer = out.observe(seen, *row_facts(columns)).write.mode(mode).option("compression", "zstd")
    if by_month is not None:
        writer = writer.partitionBy(MONTH_PARTITION)
    writer.parquet(f"{root}/version={version}/{name}")
    return {"name": name, **seen.get}


# --- log ---------------------------------------------------------------------------------------------
def _last_number(root: str) -> int:
    """The highest number in the log; one name a version, the root's own listing."""
    folder = f"{root}/{VERSION_LOG}"
    if stores.kind_of(folder)[0] is None:
        return 0
    numbers = [int(n.removesuffix(".json")) for n in stores.children(folder) if n.endswith(".json") and n[:1].isdigit()]
    return max(numbers, default=0)


def _entry(root: str, number: int) -> str:
    return f"{root}/{VERSION_LOG}/{number:012d}.json"


def commit_version(root: str, version: str, tables: list[Facts], base: int | None = None) -> int:
    """Make a version the current one; gives its number.

    With `base`, the number of the version it builds on, a version committed since is a conflict. Without, the next free
    number is taken, after as many others as came first.
    """
    while True:
        last = _last_number(root)
        if base is not None and last != base:
            raise ConflictError(f"version {last} was committed since version {base} was read")
        entry = {"number": last + 1, "version": version, "tables": tables}
        if stores.create_new(_entry(root, last + 1), json.dumps(entry).encode()):
            return last + 1


def versions(spark: SparkSession, root: str) -> DataFrame:
    """Committed versions, newest first."""
    return spark.read.schema(LOG_SCHEMA).json(f"{root}/{VERSION_LOG}").orderBy(F.desc("number"))


def current_entry(root: str) -> dict:
    number = _last_number(root)
    if not number:
        raise FileNotFoundError(f"nothing published at {root}")
    return json.loads(stores.read_all(_entry(root, number)))


def current_version(root: str) -> str:
    return current_entry(root)["version"]


def facts_of(spark: SparkSession, root: str, version: str) -> dict[str, Facts]:
    """What the log says of each table of a version."""
    tables = versions(spark, root).where(F.col("version") == version).collect()[0]["tables"]
    return {t["name"]: t.asDict() for t in tables}


def read_table(
    spark: SparkSession, root: str, name: str, version: str | None = None, month_partition: bool = False
) -> DataFrame:
    """A table of the current or a given version; the month partition column stays hidden unless asked for."""
    chosen = version or current_version(root)
    df = spark.read.parquet(f"{root}/version={chosen}/{name}")
    return df if month_partition or MONTH_PARTITION not in df.columns else df.drop(MONTH_PARTITION)
