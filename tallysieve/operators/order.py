"""Proof that written rows lie in an order, without sorting them again.

A sorted table is a row of part files, each in order, each beginning where the one before ended. So every part is walked
on its own, comparing neighbours, and gives its first and last key; the borders between parts are compared over one row
a part. Nothing is shuffled but these rows and each part's keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PLACE = ("__file", "__block", "__row")


def placed(written: DataFrame) -> DataFrame:
    """Rows read from files with where they lie: file, block of the file, place in the block."""
    return written.withColumns({
        "__file": F.col("_metadata.file_name"), "__block": F.col("_metadata.file_block_start"), "__row": F.monotonically_increasing_id(),
    })


def _key(order: Sequence[tuple[Column, bool]]) -> Column:
    return F.struct(*[c.alias(f"k{i}") for i, (c, _) in enumerate(order)])


def out_of_order(before: Column, after: Column, order: Sequence[tuple[Column, bool]]) -> Column:
    """Whether two keys stand the wrong way round; NULLs come last in either direction, equal keys are in order."""

    def wrong(i: int) -> Column:
        a, b, ascending = before[f"k{i}"], after[f"k{i}"], order[i][1]
        return (a.isNull() & b.isNotNull()) | F.coalesce(a > b if ascending else a < b, F.lit(False))

    def same_until(i: int) -> Column:
        return reduce(lambda x, y: x & y, [before[f"k{j}"].eqNullSafe(after[f"k{j}"]) for j in range(i)], F.lit(True))

    return reduce(lambda x, y: x | y, [same_until(i) & wrong(i) for i in range(len(order))])


def order_breaks(written: DataFrame, order: Sequence[tuple[Column, bool]]) -> DataFrame:
    """One row: parts, rows, and how many neighbours stand the wrong way round, within parts and at their borders.

    `order` gives columns and whether they ascend. A table without rows has no breaks.
    """
    keyed = placed(written).select(*PLACE, _key(order).alias("key"))
    part = Window.partitionBy("__file", "__block").orderBy("__row")
    walked = keyed.withColumn("before", F.lag("key").over(part))
    parts = walked.groupBy("__file", "__block").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("before").isNotNull() & out_of_order(F.col("before"), F.col("key"), order)).alias("within"),
        F.min_by("key", "__row").alias("first"), F.max_by("key", "__row").alias("last"),
    )
    along = parts.withColumn("ended", F.lag("last").over(Window.orderBy("__file", "__block")))  # a row for each part
    border = F.col("ended").isNotNull() & out_of_order(F.col("ended"), F.col("first"), order)
    return along.agg(
        F.count(F.lit(1)).alias("parts"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("within")), F.lit(0)).alias("within"), F.count_if(border).alias("borders"),
    ).withColumn("breaks", F.col("within") + F.col("borders"))
