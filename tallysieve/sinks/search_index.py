"""A skip index for text search: which files of a published fact may hold a text.

Every file has a Bloom filter of the three-character pieces of its searched values, in lower case, kept as the words of the
filter that have any bit. A file can be left out if a piece of the wanted text is not in its filter; what is read is
then searched as always, so the index decides how much is read and never what is found. Texts of fewer than three characters
read everything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import text
from ..operators import explore
from . import publish

TABLE = "fact_search_index"
PIECE = 3
#: Bits of a file's filter: 2,048 words at most.
BITS = 1 << 17


def _pieces(value: Column) -> Column:
    places = F.sequence(F.lit(1), F.length(value) - (PIECE - 1))
    return F.when(F.length(value) >= PIECE, F.transform(places, lambda i: F.substring(value, i, PIECE))).otherwise(F.array().cast("array<string>"))


def _words(pieces: DataFrame, *keys: str) -> DataFrame:
    """(keys, word, mask) of the pieces in column `piece`."""
    bit = F.pmod(F.xxhash64("piece"), F.lit(BITS))
    placed = pieces.select(*keys, F.shiftright(bit, 6).cast("int").alias("word"), (bit % 64).cast("int").alias("bit"))
    return placed.groupBy(*keys, "word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("mask"))


def index_of(fact: DataFrame) -> DataFrame:
    """(file, word, mask) for a fact as read from its files.

    A bit set twice is a bit set once, so nothing is made distinct and a task sends no more than the words of its files.
    """
    searched = [text.upper_label(F.col(c)) if c == "marca" else F.col(c) for c in fv.SEARCHED_COLUMNS]
    values = F.array(*[F.lower(c.cast("string")) for c in searched])
    rows = fact.select(F.col("_metadata.file_path").alias("file"), F.explode(values).alias("value")).where("value is not null")
    return _words(rows.select("file", F.explode(_pieces(F.col("value"))).alias("piece")), "file")


def publish_index(spark: SparkSession, root: str, version: str) -> publish.Facts:
    fact = publish.read_table(spark, root, "fact_vendas", version, month_partition=True)
    return publish.write_table(index_of(fact), root, version, TABLE)


def files_to_read(index: DataFrame, query: str) -> DataFrame | None:
    """(file) of the files that may hold the text; None where the index cannot tell."""
    wanted = query.strip()
    if len(wanted) < PIECE:
        return None
    one = index.sparkSession.range(1).select(F.explode(_pieces(F.lower(F.lit(wanted)))).alias("piece"))
    needed = _words(one).withColumnRenamed("mask", "needed")
    count = needed.count()  # as many as the text has pieces at most
    if not count:  # lower case may be shorter
        return None
    there = index.join(F.broadcast(needed), "word").where(F.col("mask").bitwiseAND(F.col("needed")) == F.col("needed"))
    return there.groupBy("file").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == count).select("file")


def search(spark: SparkSession, root: str, version: str, query: str) -> DataFrame:
    """The explored sales that hold a text, reading only files that may."""
    whole = publish.read_table(spark, root, "fact_vendas", version, month_partition=True)
    found = files_to_read(publish.read_table(spark, root, TABLE, version), query)
    if found is not None:
        names = [r["file"] for r in found.collect()]  # names of the files that will be read
        base = f"{root}/version={version}/fact_vendas"
        whole = spark.read.schema(whole.schema).option("basePath", base).parquet(*names) if names else whole.where(F.lit(False))
    return explore.search(explore.explored(whole), query)
