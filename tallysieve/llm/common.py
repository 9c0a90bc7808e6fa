"""What several operators share: the documents' contract, words, folds, and staged tables."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallysieve.sinks.staging import Staging

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """Only what most operators read; other columns, whatever their names, never reach them."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text modulo `parts`; NULL ids have no fold."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def words_of(text: str | None) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` as UTF-8: exactly what bytes.split() cuts."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def hash_order(*columns: Column) -> Column:
    """A repeatable order in no relation to content or arrival, to draw bounded fitting samples by."""
    return F.xxhash64(*columns, F.lit("fitting sample"))


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Runs within the block send so many rows to Python at once; rows that carry two texts each are large."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


class Stage(Staging):
    """Staged tables of one operator call, in the cluster's shared folder; snappy, since most are read once."""

    def __init__(self, spark: SparkSession, codec: str = "snappy") -> None:
        super().__init__(spark, codec=codec)
