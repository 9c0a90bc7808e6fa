"""The corpus pipeline: documents to packed token sequences, stage by stage.

Each stage takes the documents that its predecessor kept, is written as Parquet and read again, so that a lost executor
costs no more than the stage it was in. All but the last keep the columns of documents.

1. quality: documents that the classifier scores below 0.3 go.
2. near_duplicates: one document of each class stays.
3. decontamination: documents that contain a benchmark item go.
4. secrets: spans that the scan finds are replaced by a mark; n_chars follows the text.
5. packing: token pieces with their sequence and offset.

NULL and empty texts, repeated rows, empty tables and further columns are treated as each operator says. No stage is
expressible in SQL, so ORACLE_SQL is None and the run is tested against plain versions of the stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallysieve.llm import decontamination, neardup, packing, quality, secrets
from tallysieve.llm.common import Stage, batches_of, documents, fold, table

ORACLE_SQL: str | None = None

#: Documents that a Python worker gets at once.
BATCH_ROWS = 2000

StageFunction = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least 0.3; labels are learnt from outside the held-out fold only."""
    model = quality.train(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id"), 5) == 0)
    scored = quality.score_texts(docs, model, "__quality")
    return scored.where(F.col("__quality") >= quality.ACCEPT).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class."""
    return neardup.deduplicated(docs).select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark item."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark")).select(docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked."""
    masked = secrets.redact(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return masked.select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of each document: where it lies in which sequence."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, StageFunction]] = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = Stage(spark)
    docs = documents(spark, sf_dir)
    # Workers live through all stages and keep the memory of their largest batch.
    with batches_of(spark, BATCH_ROWS):
        for name, function in STAGES:
            docs = stage(name, function(spark, docs, sf_dir))
    return docs
