"""Strict delimited text: format checks, header contracts, and rows with their physical start line."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..contracts import CONTRACTS, Contract, contract_table

CHUNK_ROWS = 20_000
PARSED = (
    "source_file string, schema_name string, encoding string, delimiter string, line bigint, "
    "fields array<string>, problem string"
)


# --- format ------------------------------------------------------------------------------------------
def encoding_of(head: Column, valid: Column) -> Column:
    """`utf-8` or `utf-8-sig` by the first bytes; NULL for a refused byte order mark or bytes that are not UTF-8."""
    start = F.hex(F.substring(head, 1, 4))
    refused = F.lit(False)
    for bom in fv.REFUSED_BOM_HEX:
        refused = refused | start.startswith(bom)
    name = F.when(start.startswith(fv.UTF8_BOM_HEX), "utf-8-sig").otherwise("utf-8")
    return F.when(valid & ~refused, name)


def header_line(content: Column) -> Column:
    text = F.regexp_replace(content.cast("string"), "^\ufeff", "")
    return F.regexp_extract(text, r"^([^\r\n]*)", 1)


def delimiter_of(header: Column) -> Column:
    """The most frequent candidate of the header line; earlier candidates win ties; NULL without any."""
    counts = [F.length(header) - F.length(F.replace(header, F.lit(d), F.lit(""))) for d in fv.DELIMITER_CANDIDATES]
    best = F.greatest(*counts)
    found = F.lit(None).cast("string")
    for d, n in reversed(list(zip(fv.DELIMITER_CANDIDATES, counts, strict=True))):
        found = F.when(n == best, F.lit(d)).otherwise(found)
    return F.when(best > 0, found)


def header_fields(header: Column) -> Column:
    """Column names of a header line; a quoted name loses its quotes."""
    return F.transform(
        F.split(header, fv.DELIMITER, -1), lambda x: F.regexp_replace(x, '^"(.*)"$', "$1")
    )


def header_difference(expected: Column, received: Column) -> Column:
    """Missing, extra or reordered columns in words; NULL for equal headers."""
    missing, extra = F.array_except(expected, received), F.array_except(received, expected)
    parts = F.concat_ws(
        "; ",
        F.when(F.size(missing) > 0, F.concat(F.lit("missing="), F.array_join(missing, ","))),
        F.when(F.size(extra) > 0, F.concat(F.lit("extra="), F.array_join(extra, ","))),
        F.when((F.size(missing) == 0) & (F.size(extra) == 0), F.lit("column order differs")),
    )
    return F.when(expected != received, parts)


def resolve_headers(headers: DataFrame, contracts: dict[str, Contract] | None = None) -> DataFrame:
    """Add schema_name and problem to rows with `fields` (array<string>) and `schema_hint`.

    A hinted file must carry exactly that contract's header; any other must equal exactly one contract.
    """
    expected = F.broadcast(contract_table(headers.sparkSession, contracts))  # one row per contract
    by_hint = expected.select(F.col("schema_name").alias("schema_hint"), F.col("expected").alias("hinted"))
    by_header = expected.select(F.col("schema_name").alias("matched"), F.col("expected").alias("fields"))
    joined = headers.join(by_hint, "schema_hint", "left").join(by_header, "fields", "left")
    fields = F.col("fields")
    blank = (F.size(fields) == 0) | F.exists(fields, lambda x: x == "")
    problem = (
        F.when(blank, "empty header or column name")
        .when(F.size(F.array_distinct(fields)) != F.size(fields), "repeated column")
        .when(
            F.col("hinted").isNotNull() & (F.col("hinted") != fields),
            F.concat(F.lit("header differs from the contract: "), header_difference(F.col("hinted"), fields)),
        )
        .when(F.col("hinted").isNull() & F.col("matched").isNull(), "header matches no contract")
    )
    return joined.withColumns(
        {"schema_name": F.coalesce(F.col("schema_hint"), F.col("matched")), "header_problem": problem}
    ).drop("hinted", "matched")


def inspect_heads(files: DataFrame, contracts: dict[str, Contract] | None = None) -> DataFrame:
    """Format and contract of each file of (source_file, schema_hint, length, head, valid, binary, ...).

    `head` has the first line at least, or is NULL where none was found; `valid` and `binary` speak of all bytes.
    Adds encoding, delimiter, fields, schema_name and `problem`, which is NULL if the file is sound.
    """
    formed = (
        files.withColumns({"encoding": encoding_of(F.col("head"), F.col("valid")), "__header": header_line(F.col("head"))})
        .withColumn("delimiter", delimiter_of(F.col("__header")))
        .withColumn("fields", header_fields(F.col("__header")))
    )
    resolved = resolve_headers(formed, contracts)
    problem = (
        F.when(F.col("length") == 0, "empty file")
        .when(F.col("encoding").isNull(), F.when(F.col("head").isNull(), "no header line found").otherwise("not UTF-8"))
        .when(F.col("binary"), "binary content")
        .when(F.col("delimiter").isNull(), "no delimiter found")
        .when(F.col("delimiter") != fv.DELIMITER, F.concat(F.lit("wrong delimiter: "), F.col("delimiter")))
        .otherwise(F.col("header_problem"))
    )
    return resolved.withColumn("problem", problem).drop("__header", "header_problem", "head", "valid", "binary")


def inspect_files(files: DataFrame, contracts: dict[str, Contract] | None = None) -> DataFrame:
    """The same for files held whole, (source_file, schema_hint, content)."""
    content = F.col("content")
    text = content.cast("string")
    about = {
        "length": F.length(content), "head": content, "valid": F.is_valid_utf8(text),
        "binary": F.contains(text, F.lit("\u0000")),
    }
    return inspect_heads(files.withColumns(about), contracts)


# --- strict reader -----------------------------------------------------------------------------------
def _parser(delimiter: str, chunk_rows: int):
    """The task function. It closes over plain values only, so executors need not have this package."""
    names = ["source_file", "schema_name", "encoding", "delimiter", "line", "fields", "problem"]

    def records(content: bytes, encoding: str) -> Iterator[tuple[int, list[str] | None, str | None]]:
        """(start line, fields, problem) of one file; stops at the first problem."""
        text = io.TextIOWrapper(io.BytesIO(content), encoding=encoding, errors="strict", newline="")
        reader = csv.reader(text, delimiter=delimiter, strict=True)
        width, line = None, 1
        try:
            for fields in reader:
                width = len(fields) if width is None else width
                if len(fields) != width:
                    yield line, None, f"line {line}: {len(fields)} fields instead of {width}"
                    return
                yield line, fields, None
                line = reader.line_num + 1
        except csv.Error as error:
            yield line, None, f"line {line}: {error}"

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file in batch.itertuples(index=False):
                about = (file.source_file, file.schema_name, file.encoding, file.delimiter)
                if file.problem is not None:
                    yield pd.DataFrame([(*about, None, None, file.problem)], columns=names)
                    continue
                rows: list[tuple] = []
                for record in records(file.content, file.encoding):
                    rows.append((*about, *record))
                    if len(rows) >= chunk_rows:
                        yield pd.DataFrame(rows, columns=names)
                        rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    return parse


def parse_files(files: DataFrame, contracts: dict[str, Contract] | None = None) -> DataFrame:
    """Rows of every file, header included as line 1; a refused file gives one row with its problem.

    One file is one unit of work, as members of archives are; what lies in a folder is read by `ranges.read_ranged`.
    """
    inspected = inspect_files(files, contracts).select(
        "source_file", "schema_name", "encoding", "delimiter", "problem",
        F.when(F.col("problem").isNull(), F.col("content")).alias("content"),
    )
    return inspected.mapInPandas(_parser(fv.DELIMITER, CHUNK_ROWS), PARSED)


def contract_rows(parsed: DataFrame, contract: str) -> DataFrame:
    """Typed-as-text rows of one contract with their provenance."""
    columns = CONTRACTS[contract].columns
    return parsed.where(
        (F.col("schema_name") == contract) & F.col("problem").isNull() & (F.col("line") > 1)
    ).select(
        *[F.get("fields", F.lit(i)).alias(c) for i, c in enumerate(columns)],
        F.col("source_file").alias(fv.SOURCE_FILE),
        F.col("line").alias(fv.SOURCE_LINE),
    )
