"""The queries of this subpackage, each an operator with production parameters over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from . import bpe, decontamination, language, licenses, manifest, neardup, packing, passages, quality, rules, secrets, suffixes, vectors
from .common import documents, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(documents(spark, sf_dir))


def op3_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.remove_repeats(documents(spark, sf_dir))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(documents(spark, sf_dir))


def op8_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(documents(spark, sf_dir))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op10_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(documents(spark, sf_dir))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.verified_manifest(documents(spark, sf_dir))


def op12_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.compress(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_secret_scan": op2_secret_scan,
    "op3_repeated_passages": op3_repeated_passages,
    "op4_quality_rules": op4_quality_rules,
    "op5_packing": op5_packing,
    "op6_decontamination": op6_decontamination,
    "op7_language_id": op7_language_id,
    "op8_minhash_neardup": op8_minhash_neardup,
    "op9_license_scan": op9_license_scan,
    "op10_suffix_array": op10_suffix_array,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_bpe_round_trip": op12_bpe_round_trip,
    "op13_vector_codes": op13_vector_codes,
    "pipeline": corpus_pipeline.run,
}
ORACLES: dict[str, str] = {
    "op9_license_scan": licenses.oracle(),
    "op11_merkle_manifest": manifest.oracle(),
    "op13_vector_codes": vectors.oracle(),
}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
