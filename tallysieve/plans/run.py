"""The whole run: read a batch, normalise, evaluate, publish, and say what came of it."""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Collection, Iterable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import explore, marts, rules
from ..session import tune
from ..sinks import exports, publish, search_index
from ..sinks.staging import Staging, free
from ..sources.batch import read_batch
from ..sources.listing import UNLIMITED, Limits
from ..sources.ranges import RANGE_BYTES
from .evaluate import BETWEEN, Evaluation, evaluate, evaluate_slices, report_from, slices_of
from .normalise import normalise_all

TABLES = (
    "raw_vendas", "dim_consultores", "dim_lojas", "dim_veiculos", "fact_vendas", "rejected_sales",
    "quality_report", "mart_vendas_mensal",
)
REPORT_EXPORT, QUARANTINE_EXPORT = "quality_report_csv", "rejected_sales_csv"
PARTS = (*TABLES, search_index.TABLE, REPORT_EXPORT, QUARANTINE_EXPORT)
# Parts that are made from judged sales.
JUDGED = ("fact_vendas", "rejected_sales", "quality_report")
# Parts that are made from a published table.
MADE_FROM = {
    "mart_vendas_mensal": "fact_vendas", search_index.TABLE: "fact_vendas", REPORT_EXPORT: "quality_report",
    QUARANTINE_EXPORT: "rejected_sales",
}


@dataclass(frozen=True)
class Run:
    version: str
    output: str
    quarantine: str
    summary: DataFrame


def build(
    tables: dict[str, DataFrame], stage: Staging, as_of: Column | None = None
) -> tuple[dict[str, DataFrame], Evaluation | Iterable[Evaluation]]:
    """Normalised tables and their evaluation, both staged: several outputs read them. That of many sales comes in slices."""
    clean = {name: stage(f"clean_{name}", df) for name, df in normalise_all(tables).items()}
    slices = slices_of(clean["vendas"])
    if slices > 1:
        return clean, evaluate_slices(clean, as_of, stage, slices)
    ev = evaluate(clean, as_of, stage=stage)
    stage.drop(BETWEEN)
    return clean, ev


def publish_run(
    spark: SparkSession,
    output: str,
    quarantine: str,
    raw_sales: DataFrame,
    clean: dict[str, DataFrame],
    ev: Evaluation | Iterable[Evaluation],
    version: str,
    stage: Staging | None = None,
) -> None:
    """Write all tables and exports of one version; only the last step makes it current."""
    publish.commit_version(output, version, publish_parts(spark, output, quarantine, raw_sales, clean, ev, version, stage=stage))


def publish_parts(
    spark: SparkSession,
    output: str,
    quarantine: str,
    raw_sales: DataFrame,
    clean: dict[str, DataFrame],
    ev: Evaluation | Iterable[Evaluation],
    version: str,
    parts: Collection[str] = PARTS,
    stage: Staging | None = None,
) -> list[publish.Facts]:
    """Write some or all parts of a version that is not current yet; gives the facts of its tables.

    `ev` is the whole evaluation or its slices. A slice that several parts read is staged for them in `stage` and then dropped. A part that is made from a published one (`MADE_FROM`) needs that one written, now or before.
    """
    facts: list[publish.Facts] = []

    def read(name: str) -> DataFrame:
        return publish.read_table(spark, output, name, version)

    def write(name: str, df: Callable[[], DataFrame], by_month: str | None = None) -> None:
        if name in parts:
            free(spark)  # shuffles of the part before
            facts.append(publish.write_table(df(), output, version, name, by_month))

    write("raw_vendas", lambda: raw_sales)
    for name in ("consultores", "lojas", "veiculos"):
        write(f"dim_{name}", lambda name=name: clean[name])
    if isinstance(ev, Evaluation):
        write("fact_vendas", lambda: ev.fact, "data_venda")
        write("rejected_sales", lambda: ev.rejected)
        write("quality_report", lambda: ev.report)
    elif not set(JUDGED).isdisjoint(parts):
        made, report = _write_slices(spark, output, version, ev, [name for name in JUDGED if name in parts], stage)
        facts += made
        write("quality_report", lambda: report)
    write("mart_vendas_mensal", lambda: marts.monthly_mart(read("fact_vendas")))
    if search_index.TABLE in parts:
        facts.append(search_index.publish_index(spark, output, version))
    if REPORT_EXPORT in parts:
        exports.write_report(read("quality_report"), f"{output}/version={version}/{REPORT_EXPORT}")
    if QUARANTINE_EXPORT in parts:
        exports.write_quarantine(read("rejected_sales"), f"{quarantine}/version={version}/{QUARANTINE_EXPORT}")
    return facts


def _write_slices(
    spark: SparkSession, output: str, version: str, slices: Iterable[Evaluation], parts: list[str], stage: Staging | None
) -> tuple[list[publish.Facts], DataFrame]:
    """The fact and the rejected sales, slice after slice; gives their facts and the quality report."""
    made: dict[str, list[publish.Facts]] = {name: [] for name in JUDGED[:2] if name in parts}
    failures: Counter[str] = Counter()
    for k, ev in enumerate(slices):
        free(spark)  # shuffles of the slice before
        if len(parts) > 1:
            stage = stage or Staging(spark)
            ev = replace(ev, judged=stage(f"judged_{k}", ev.judged))
            free(spark)
        mode = "append" if k else "overwrite"
        if "fact_vendas" in made:
            made["fact_vendas"].append(publish.write_table(ev.fact, output, version, "fact_vendas", "data_venda", mode))
        if "rejected_sales" in made:
            made["rejected_sales"].append(publish.write_table(ev.rejected, output, version, "rejected_sales", mode=mode))
        if "quality_report" in parts:
            failures.update({r["rule_id"]: r["failed_rows"] for r in rules.sales_failures(ev.judged, ev.rules).collect()})  # a row a rule
        if len(parts) > 1:
            stage.drop(f"judged_{k}")
    counted = spark.createDataFrame([(r.rule_id, failures[r.rule_id]) for r in ev.rules], "rule_id string, failed_rows bigint")
    return [publish.merged(f) for f in made.values()], report_from(counted, ev.dims, ev.rules)


def summarise(spark: SparkSession, output: str, version: str, input_files: DataFrame) -> DataFrame:
    """One row: files, received, valid and rejected sales, as the version log has them from the writes."""
    facts = publish.facts_of(spark, output, version)
    received, valid, rejected = (facts[name]["rows"] for name in ("raw_vendas", "fact_vendas", "rejected_sales"))
    files = input_files.agg(F.count(F.lit(1)).alias("n")).scalar()
    return explore.volume_row(spark, received, valid, rejected).withColumn("arquivos", files)


def run_batch(
    spark: SparkSession,
    path: str,
    output: str,
    quarantine: str,
    as_of: Column | None = None,
    limits: Limits = UNLIMITED,
    range_bytes: int = RANGE_BYTES,
) -> Run:
    tune(spark)
    started = time.time()
    stage = Staging(spark)
    batch = read_batch(spark, path, limits, stage, range_bytes)
    raw = batch.tables()
    clean, ev = build(raw, stage, as_of)
    version = publish.new_version()
    publish_run(spark, output, quarantine, raw["vendas"], clean, ev, version, stage)
    summary = summarise(spark, output, version, batch.summary()).withColumn(
        "segundos", F.lit(round(time.time() - started, 2))
    )
    known = spark.createDataFrame(summary.collect(), summary.schema)  # one row, so that staged tables can go
    stage.drop()
    return Run(version, output, quarantine, known)
