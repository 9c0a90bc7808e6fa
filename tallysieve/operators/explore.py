"""Exploration of the published fact: filters, figures, rankings, quality board and traceability.

Every function takes and returns a DataFrame; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, fields
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import ptbr, text
from ..functions.dates import month_of
from ..functions.numbers import finite, mean_amount
from . import keys

TOTAL = "decimal(28,2)"
MONTH_PARTITION = "__mes"


def explored(fact: DataFrame) -> DataFrame:
    """The columns that exploration reads, as far as `fact` has them, with canonical labels for brand, channel and payment."""
    kept = [c for c in (*fv.EXPLORED_COLUMNS, MONTH_PARTITION) if c in fact.columns]
    labels = {
        "marca": text.upper_label(F.col("marca")),
        "canal_origem": text.title_label(F.col("canal_origem")),
        "forma_pagamento": text.sentence_label(F.col("forma_pagamento")),
    }
    return fact.select(*kept).withColumns({c: label for c, label in labels.items() if c in kept})


@dataclass(frozen=True)
class Selection:
    """What the user picked. Nothing picked for an attribute means no restriction on it."""

    start: date | None = None
    end: date | None = None
    marca: Sequence[str] = field(default_factory=tuple)
    loja: Sequence[str] = field(default_factory=tuple)
    uf: Sequence[str] = field(default_factory=tuple)
    canal_origem: Sequence[str] = field(default_factory=tuple)
    forma_pagamento: Sequence[str] = field(default_factory=tuple)
    consultor: Sequence[str] = field(default_factory=tuple)

    @property
    def active(self) -> bool:
        return any(getattr(self, f.name) for f in fields(self))

    def cleared(self) -> Selection:
        return Selection()

    def conditions(self, columns: Sequence[str]) -> list[Column]:
        out: list[Column] = []
        day = F.col("data_venda")
        if self.start is not None:
            out.append(day >= F.lit(self.start))
        if self.end is not None:
            out.append(day <= F.lit(self.end))
        if MONTH_PARTITION in columns:
            # Same restriction on the partition column, so that whole months are never opened.
            month = F.col(MONTH_PARTITION)
            if self.start is not None:
                out.append(month >= F.lit(self.start.replace(day=1)))
            if self.end is not None:
                out.append(month <= F.lit(self.end.replace(day=1)))
        for attribute in fv.FILTER_ATTRIBUTES:
            picked = getattr(self, attribute)
            if picked:
                out.append(F.col(attribute).isin(*picked))
        return out


def apply_selection(sales: DataFrame, selection: Selection) -> DataFrame:
    conditions = selection.conditions(sales.columns)
    return sales.where(reduce(lambda a, b: a & b, conditions)) if conditions else sales


def filter_options(sales: DataFrame) -> DataFrame:
    """Distinct values per attribute as rows (atributo, valor); ordering is left to the reader."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(a).alias("atributo"), F.col(a).alias("valor")) for a in fv.FILTER_ATTRIBUTES])
    )
    return sales.select(pairs.alias("x")).select("x.*").where("valor is not null").distinct()


def period(sales: DataFrame) -> DataFrame:
    return sales.agg(F.min("data_venda").alias("inicio"), F.max("data_venda").alias("fim"))


# --- figures ---------------------------------------------------------------------------------------
def kpis(sales: DataFrame) -> DataFrame:
    revenue = F.sum("valor_venda")
    return sales.agg(
        F.coalesce(revenue, F.lit(0)).cast(TOTAL).alias("faturamento"),
        F.count(F.lit(1)).alias("vendas"),
        mean_amount(revenue, F.count("valor_venda"), "decimal(18,4)").alias("ticket_medio"),
        F.coalesce(F.sum("desconto_concedido"), F.lit(0)).cast(TOTAL).alias("desconto_concedido"),
    )


def kpi_texts(figures: DataFrame) -> DataFrame:
    return figures.select(
        ptbr.compact_currency(F.col("faturamento")).alias("faturamento"),
        ptbr.compact_number(F.col("vendas")).alias("vendas"),
        ptbr.compact_currency(F.col("ticket_medio")).alias("ticket_medio"),
        ptbr.compact_currency(F.col("desconto_concedido")).alias("desconto_concedido"),
    )


def monthly_series(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy(month_of(F.col("data_venda")).alias("mes"))
        .agg(F.sum("valor_venda").cast(TOTAL).alias("receita"), F.count("venda_id").alias("vendas"))
        .orderBy("mes")
    )


def revenue_by_brand(sales: DataFrame) -> DataFrame:
    """Brands without name are left out."""
    return sales.where("marca is not null").groupBy("marca").agg(F.sum("valor_venda").cast(TOTAL).alias("receita"))


def top_brands(sales: DataFrame, n: int = 10) -> DataFrame:
    """The n brands with most revenue; ties go to the brand that sorts first."""
    return revenue_by_brand(sales).orderBy(F.desc("receita"), F.asc("marca")).limit(n)


def by_store(sales: DataFrame) -> DataFrame:
    return (
        sales.where("loja is not null").groupBy("loja")
        .agg(F.count("venda_id").alias("vendas"), F.sum("valor_venda").cast(TOTAL).alias("receita"))
        .orderBy(F.asc("receita"), F.asc("loja"))
    )


def by_channel(sales: DataFrame) -> DataFrame:
    """Count and share of all; a missing channel is a bucket of its own."""
    counts = sales.groupBy(text.or_not_informed(F.col("canal_origem")).alias("canal")).agg(
        F.count(F.lit(1)).alias("vendas")
    )
    # The window runs over one row per channel.
    total = counts.withColumn("__total", F.sum("vendas").over(Window.partitionBy()))
    shared = total.withColumn("percentual", ptbr.ratio_text(F.col("vendas"), F.col("__total")))
    return shared.drop("__total").orderBy(F.desc("vendas"), F.asc("canal"))


def by_payment(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy(text.or_not_informed(F.col("forma_pagamento")).alias("forma"))
        .agg(F.count(F.lit(1)).alias("vendas"))
        .orderBy(F.desc("vendas"), F.asc("forma"))
    )


def volumes(raw: DataFrame, fact: DataFrame, rejected: DataFrame) -> DataFrame:
    """Received, valid and rejected as one row, with the approval rate."""
    counted = [df.agg(F.count(F.lit(1)).alias("n")).scalar() for df in (raw, fact, rejected)]
    return _volume_row(raw.sparkSession, counted)


def volume_row(spark: SparkSession, received: int, valid: int, rejected: int) -> DataFrame:
    """The same row from counts that are known."""
    return _volume_row(spark, [F.lit(n).cast("bigint") for n in (received, valid, rejected)])


def _volume_row(spark: SparkSession, counts: list[Column]) -> DataFrame:
    names = ("recebidos", "validos", "rejeitados")
    row = spark.range(1).select(*[c.alias(n) for c, n in zip(counts, names, strict=True)])
    return row.withColumn("taxa_aprovacao", ptbr.ratio_text(F.col("validos"), F.col("recebidos")))


def axis_ticks(df: DataFrame, column: str, tick_count: int = 5) -> DataFrame:
    """Readable axis positions around the values of a column, one row per tick."""
    x = F.coalesce(F.min("__x"), F.lit(0.0)), F.coalesce(F.max("__x"), F.lit(0.0))
    span = df.select(finite(F.col(column)).alias("__x")).agg(
        F.least(F.lit(0.0), x[0]).alias("lo"), F.greatest(F.lit(0.0), x[1]).alias("hi")
    )
    raw_step = (F.col("hi") - F.col("lo")) / float(max(tick_count - 1, 1))
    sized = span.withColumn("raw", raw_step).withColumn(
        "mag", F.pow(F.lit(10.0), F.floor(F.log10(F.nullif(F.col("raw"), F.lit(0.0)))))
    )
    step = F.lit(None).cast("double")
    for m in reversed(fv.TICK_MULTIPLIERS):
        step = F.when(F.col("raw") / F.col("mag") <= m, F.lit(m)).otherwise(step)
    scaled = sized.withColumn("step", step * F.col("mag"))
    first = F.floor(F.col("lo") / F.col("step"))
    last = F.ceil(F.col("hi") / F.col("step"))
    ticks = F.when(F.col("lo") == F.col("hi"), F.array(F.col("lo"))).otherwise(
        F.transform(F.sequence(first, last), lambda i: i * F.col("step"))
    )
    return scaled.select(F.posexplode(ticks).alias("posicao", "valor"))


# --- quality board ---------------------------------------------------------------------------------
def board_order(report: DataFrame) -> DataFrame:
    return report.orderBy(F.desc("failed_rows"), F.asc("check"))


def quality_board(report: DataFrame) -> DataFrame:
    """Report rows with display texts, most affected rule first."""
    return board_order(report).select(
        text.rule_label(F.col("check")).alias("regra"),
        text.severity_label(F.col("severity")).alias("severidade"),
        F.col("failed_rows").alias("registros_afetados"),
        text.status_label(F.col("status")).alias("status"),
    )


def filter_board(board: DataFrame, severity: str | None = None, status: str | None = None) -> DataFrame:
    if severity is not None:
        board = board.where(F.col("severidade") == severity)
    if status is not None:
        board = board.where(F.col("status") == status)
    return board


def affected_rules(board: DataFrame) -> DataFrame:
    return board.where(F.col("registros_afetados") > 0).orderBy(F.asc("registros_afetados"), F.asc("regra"))


def rule_counts(report: DataFrame) -> DataFrame:
    return report.agg(
        F.count(F.lit(1)).alias("executadas"),
        F.count_if(F.col("status") == "passed").alias("aprovadas"),
        F.count_if(F.col("status") == "failed").alias("falhas"),
        F.count_if(F.col("status") == "warning").alias("avisos"),
    )


# --- traceability ------------------------------------------------------------------------------------
SORTS = {
    "newest": ("data_venda", False),
    "oldest": ("data_venda", True),
    "highest": ("valor_venda", False),
    "lowest": ("valor_venda", True),
}


def search(sales: DataFrame, query: str) -> DataFrame:
    """Rows with the text in any searched column; a blank text keeps every row."""
    wanted = query.strip()
    if not wanted:
        return sales
    return sales.where(
        reduce(lambda a, b: a | b, [text.contains_text(F.col(c), wanted) for c in fv.SEARCHED_COLUMNS])
    )


def with_alerts(sales: DataFrame, present: bool | None) -> DataFrame:
    if present is None:
        return sales
    alert = text.has_alert(F.col("quality_issues"))
    return sales.where(alert if present else ~alert)


def sort_sales(sales: DataFrame, order: str = "newest") -> DataFrame:
    """Sorted by date or amount, NULLs last; ties stay in source order."""
    return sales.orderBy(*[c.asc_nulls_last() if ascending else c.desc_nulls_last() for c, ascending in sales_order(order)])


def sales_order(order: str = "newest") -> list[tuple[Column, bool]]:
    """The columns of a sort and whether they ascend."""
    column, ascending = SORTS[order]
    return [(F.col(column), ascending), *((c, True) for c in keys.source_order())]


def trace_counts(sales: DataFrame) -> DataFrame:
    return sales.agg(
        F.count(F.lit(1)).alias("registros"),
        F.count_if(text.has_alert(F.col("quality_issues"))).alias("com_alertas"),
    )


def investigate(
    sales: DataFrame, query: str = "", alerts: bool | None = None, order: str = "newest"
) -> DataFrame:
    return sort_sales(with_alerts(search(sales, query), alerts), order)


def export_rows(investigated: DataFrame) -> DataFrame:
    return investigated.select(*fv.EXPORTED_COLUMNS)


def presented(investigated: DataFrame) -> DataFrame:
    """The investigation as shown: titles, texts for amounts and percentages, a word for no alerts."""
    shown = {
        "quality_issues": text.alerts_or_none(F.col("quality_issues")),
        "valor_venda": ptbr.currency(F.col("valor_venda")),
        "valor_referencia": ptbr.currency(F.col("valor_referencia")),
        "desconto_percentual": ptbr.percent_text(F.col("desconto_percentual")),
    }
    return investigated.select(*[shown.get(c, F.col(c)).alias(t) for c, t in fv.TRACE_TITLES.items()])
