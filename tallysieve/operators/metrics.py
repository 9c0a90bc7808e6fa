"""Discount and premium against the reference amount, in exact decimals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import MONEY, PERCENT, mean_amount, weighted_percent

METRIC_COLUMNS = (
    "desconto_concedido", "agio_referencia", "variacao_liquida_referencia", "desconto_percentual",
)


def _surplus(a: Column, b: Column) -> Column:
    """a - b when positive, else zero; NULL when either side is NULL (greatest alone would skip it)."""
    gap = (a - b).cast(MONEY)
    return F.when(gap.isNotNull(), F.greatest(gap, F.lit(0).cast(MONEY)))


def with_metrics(fact: DataFrame) -> DataFrame:
    ref, amount = F.col("valor_referencia"), F.col("valor_venda")
    discount, premium = F.col("desconto_concedido"), F.col("agio_referencia")
    return fact.withColumns(
        {"desconto_concedido": _surplus(ref, amount), "agio_referencia": _surplus(amount, ref)}
    ).withColumns(
        {
            "variacao_liquida_referencia": (discount - premium).cast(MONEY),
            "desconto_percentual": F.when(ref > 0, (discount / ref * 100).cast(PERCENT)),
        }
    )


def below_reference() -> Column:
    return F.col("valor_venda") < F.col("valor_referencia")


def discount_percent() -> Column:
    """Discount over reference, both only of sales below their reference; NULL when there are none."""
    return weighted_percent(
        F.sum(F.when(below_reference(), F.col("desconto_concedido"))),
        F.sum(F.when(below_reference(), F.col("valor_referencia"))),
    )


def financial_aggregates(money: str = MONEY, ticket: str = MONEY) -> list[Column]:
    """Count, revenue, mean ticket, discount, premium, net variation and weighted discount."""
    revenue = F.sum("valor_venda")
    return [
        F.count(F.lit(1)).alias("quantidade_vendas"),
        revenue.cast(money).alias("receita"),
        mean_amount(revenue, F.count("valor_venda"), ticket).alias("ticket_medio"),
        F.sum("desconto_concedido").cast(money).alias("desconto_concedido_total"),
        F.sum("agio_referencia").cast(money).alias("agio_referencia_total"),
        F.sum("variacao_liquida_referencia").cast(money).alias("variacao_liquida_referencia_total"),
        discount_percent().alias("desconto_percentual_ponderado"),
    ]


def overall(fact: DataFrame) -> DataFrame:
    """The same figures over the whole fact. Totals are wide: (18,2) would overflow on a very large fact."""
    return fact.agg(*financial_aggregates("decimal(28,2)", "decimal(18,4)"))
