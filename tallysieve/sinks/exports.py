"""Delimited exports. Spark writes a folder of part files; small reports go to one part."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import explore
from . import publish


# Text of a published day: at midnight in the export of the fact, as a plain date elsewhere.
MOMENT, DAY = "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd"


def write_delimited(df: DataFrame, path: str, sep: str = ";", moment: str = DAY) -> str:
    """Text as it is: header, no byte order mark, NULL as nothing, blanks kept; `moment` is the form of timestamps."""
    (
        df.write.mode("overwrite")
        .option("timestampNTZFormat", moment).option("dateFormat", DAY).option("sep", sep).option("header", True).option("emptyValue", "").option("nullValue", "")
        .option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def write_report(report: DataFrame, path: str) -> str:
    """The quality report, one row per rule of the catalog, as one part file."""
    return write_delimited(report.orderBy("position").drop("position").coalesce(1), path, ",")


def write_quarantine(rejected: DataFrame, path: str) -> str:
    return write_delimited(rejected, path, ",")


def write_board(board: DataFrame, path: str) -> str:
    """The filtered quality board, at most one row per rule."""
    return write_delimited(board.coalesce(1), path)


def write_investigation(investigated: DataFrame, path: str) -> str:
    return write_delimited(explore.export_rows(investigated), path)


def export_fact(spark: SparkSession, root: str, path: str) -> str:
    """The whole current fact as delimited text; fails when nothing was published."""
    return write_delimited(publish.read_table(spark, root, "fact_vendas"), path, moment=MOMENT)
