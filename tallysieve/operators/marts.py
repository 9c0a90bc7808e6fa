"""Monthly mart and its reconciliation with the fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_stamp
from .metrics import financial_aggregates

MART_KEYS = ("mes", "marca", "loja", "uf")
# What the mart and its reconciliation read of the fact.
MART_READS = (
    "data_venda", "marca", "loja", "uf", "valor_venda", "valor_referencia", "desconto_concedido", "agio_referencia",
    "variacao_liquida_referencia",
)
_TOTALS = {
    "quantidade_vendas": "bigint",
    "receita": "decimal(28,2)",
    "desconto_concedido_total": "decimal(28,2)",
    "agio_referencia_total": "decimal(28,2)",
    "variacao_liquida_referencia_total": "decimal(28,2)",
}


def monthly_mart(fact: DataFrame) -> DataFrame:
    """Month x brand x store x state; groups with a NULL part are kept and brands keep their case."""
    return (
        fact.withColumn("mes", month_stamp(F.col("data_venda")))
        .groupBy(*MART_KEYS)
        .agg(*financial_aggregates())
    )


def _totals_of_fact(fact: DataFrame) -> DataFrame:
    return fact.agg(*[c for c in financial_aggregates("decimal(28,2)")]).select(
        *[F.col(c).cast(t).alias(c) for c, t in _TOTALS.items()]
    )


def _totals_of_mart(mart: DataFrame) -> DataFrame:
    return mart.agg(*[F.sum(c).cast(t).alias(c) for c, t in _TOTALS.items()])


def _long(totals: DataFrame, value: str) -> DataFrame:
    texts = totals.select(*[F.col(c).cast("string").alias(c) for c in _TOTALS])
    return texts.unpivot([], list(_TOTALS), "metrica", value)


def reconcile(fact: DataFrame, mart: DataFrame) -> DataFrame:
    """One row per total: value in the fact, value in the mart, and whether they agree."""
    return (
        _long(_totals_of_fact(fact), "fato")
        .join(_long(_totals_of_mart(mart), "mart"), "metrica", "left")
        .withColumn("confere", F.col("fato").eqNullSafe(F.col("mart")))
    )
