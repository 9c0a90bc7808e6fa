"""Cleaning, arithmetic and display functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import dates, numbers, ptbr, text
from ..operators import explore, metrics, rules
from ..plans.evaluate import canonical
from ..plans.normalise import CLEANERS
from . import adapter, oracle as o
from .book import query
from .world import as_of

ROW = ("__source_file", "__source_line")
AT = ", ".join(ROW)


def _pt(x: str, places: int) -> str:
    return f"translate(format('{{:,.{places}f}}', cast({x} as double)), ',.', '.,')"


def _shorter(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '(,[0-9]*?)0+$', '\\1'), ',$', '')"


def _compact(x: str) -> str:
    d = f"cast({x} as double)"
    return (
        f"case when abs({d}) >= 1e9 then {_pt(f'({d} / 1e9)', 1)} || ' B' when abs({d}) >= 1e6 then {_pt(f'({d} / 1e6)', 1)} || ' M' "
        f"when abs({d}) >= 1e3 then {_pt(f'({d} / 1e3)', 1)} || ' mil' when {d} = floor({d}) then {_pt(d, 0)} "
        f"else {_shorter(_pt(d, 1))} end"
    )


@query("c01_clean_text", f"select {AT}, {o.text('canal_origem')} as canal_origem, {o.text('forma_pagamento')} as forma_pagamento from raw_vendas")
def _(w):
    cols = ("canal_origem", "forma_pagamento")
    return w.raw("vendas").select(*ROW, *[text.clean_text(F.col(c)).alias(c) for c in cols])


_IDS = ("venda_id", "veiculo_id", "loja_id", "consultor_id")


@query("c02_clean_id", f"select {AT}, {', '.join(f'{o.ident(c)} as {c}' for c in _IDS)} from raw_vendas")
def _(w):
    return w.raw("vendas").select(*ROW, *[text.clean_id(F.col(c)).alias(c) for c in _IDS])


@query("c03_parse_date", f"select {AT}, {o.day('data_venda')} as data_venda from raw_vendas")
def _(w):
    return w.raw("vendas").select(*ROW, dates.parse_date(F.col("data_venda")).alias("data_venda"))


@query("c04_number_text", f"select {AT}, {o.bare(o.text('valor_referencia'))} as texto from raw_vendas")
def _(w):
    return w.raw("vendas").select(*ROW, numbers.number_text(F.col("valor_referencia")).alias("texto"))


_NUMBERS = ("ano_modelo", "quilometragem", "score_avaliacao")


@query("c05_parse_number", f"select {AT}, veiculo_id, {', '.join(f'{o.number(c)} as {c}' for c in _NUMBERS)} from raw_veiculos")
def _(w):
    return w.raw("veiculos").select(*ROW, "veiculo_id", *[numbers.parse_number(F.col(c)).alias(c) for c in _NUMBERS])


@query("c06_parse_money", f"select {AT}, {o.money('valor_referencia')} as valor_referencia, {o.money('valor_venda')} as valor_venda from raw_vendas")
def _(w):
    cols = ("valor_referencia", "valor_venda")
    return w.raw("vendas").select(*ROW, *[numbers.parse_money(F.col(c)).alias(c) for c in cols])


_CENTS = "cast(round(l_extendedprice * 100) as bigint)"
_LONG_AMOUNTS = {  # amounts that plain decimals cannot be read from, made from the line prices: text, value
    0: (f"concat({_CENTS}, repeat('0', 20), 'e-22')", f"cast({_CENTS} as decimal(18,2)) / 100"),
    1: (f"concat({_CENTS}, '.', repeat('0', 30), 'E-002')", f"cast({_CENTS} as decimal(18,2)) / 100"),
    2: (f"concat('-', repeat('0', 45), 'e', {_CENTS})", "0"),
    3: (f"concat(l_quantity, ',', repeat('0', 70), '.0')", "l_quantity"),
    4: (f"concat({_CENTS}, 'e-10')", "null"),
    5: (
        f"concat('0.', repeat('0', 60), {_CENTS}, 'e', 58 + length(cast({_CENTS} as varchar(20))))",
        f"cast({_CENTS} as decimal(18,2)) / 100",
    ),
}


def _long_amount(part: int) -> str:
    return "case (l_orderkey + l_linenumber) % 6 " + " ".join(f"when {k} then {v[part]}" for k, v in _LONG_AMOUNTS.items()) + " end"


@query("c06_long_amounts", f"select l_orderkey, l_linenumber, cast({_long_amount(1)} as decimal(18,2)) as amount from lineitem")
def _(w):
    text_of = F.expr(_long_amount(0).replace("concat(l_quantity", "concat(cast(l_quantity as int)"))
    return adapter.table(w.spark, w.sf, "lineitem").select("l_orderkey", "l_linenumber", numbers.parse_money(text_of).alias("amount"))


for _name in CLEANERS:

    @query(f"c07_normalise_{_name}", f"select * from {_name}")
    def _(w, _name=_name):
        return w.read(_name)


@query("c08_keep_originals", f"select {AT}, data_venda as data_venda_original, valor_referencia as valor_referencia_original, valor_venda as valor_venda_original from raw_vendas")
def _(w):
    return w.read("vendas").select(*ROW, "data_venda_original", "valor_referencia_original", "valor_venda_original")


@query("c09_upper_state", f"select {AT}, {o.ident('uf')} as uf from raw_lojas")
def _(w):
    return w.raw("lojas").select(*ROW, F.upper(text.clean_text(F.col("uf"))).alias("uf"))


for _dim in ("veiculos", "lojas", "consultores"):

    @query(f"c10_renamed_{_dim}", f"select * from canon_{_dim}")
    def _(w, _dim=_dim):
        return canonical(w.read(_dim), _dim)


def _metric(name: str, column: str) -> None:
    @query(name, f"select {AT}, {column} from fact")
    def _(w):
        valid = w.fact_of(*ROW, "valor_venda", "valor_referencia")
        return metrics.with_metrics(valid).select(*ROW, column)


_metric("c11a_discount", "desconto_concedido")
_metric("c11b_premium", "agio_referencia")
_metric("c11c_net_variation", "variacao_liquida_referencia")
_metric("c11d_discount_percent", "desconto_percentual")


@query("c12_issue_list", f"select {AT}, quality_issues, is_valid from flagged")
def _(w):
    return w.judged(*ROW, "quality_issues").select(*ROW, "quality_issues", "is_valid")


@query("c13_rule_status", 'select "check", failed_rows, status from report')
def _(w):
    return w.report.select("check", "failed_rows", rules.rule_status(F.col("failed_rows"), F.col("severity")).alias("status"))


_LABELLED = ("marca", "canal_origem", "forma_pagamento")


@query("c14_canonical_labels", f"select {AT}, marca, canal_origem, forma_pagamento from sales")
def _(w):
    return w.sales_of(*ROW, *_LABELLED).select(*ROW, *_LABELLED)


_LABELS = ", ".join(f"('{k}', '{v}')" for k, v in fv.RULE_LABELS.items())
_BOARD = (
    "select label as regra, case severity when 'error' then 'Erro' else 'Aviso' end as severidade, "
    "failed_rows as registros_afetados, case status when 'passed' then 'Aprovada' when 'failed' then 'Falhou' else 'Aviso' end as status "
    f'from report join (values {_LABELS}) t(id, label) on "check" = id'
)


@query("c15_rule_labels", _BOARD)
def _(w):
    return explore.quality_board(w.report)


@query("c16_missing_category", f"select {AT}, coalesce(canal_origem, '{fv.NOT_INFORMED}') as canal, coalesce(forma_pagamento, '{fv.NOT_INFORMED}') as forma from fact")
def _(w):
    return w.fact_of(*ROW, "canal_origem", "forma_pagamento").select(
        *ROW, text.or_not_informed(F.col("canal_origem")).alias("canal"), text.or_not_informed(F.col("forma_pagamento")).alias("forma")
    )


@query("c17_no_alerts", f"select {AT}, case when trim(coalesce(quality_issues, '')) <> '' then quality_issues else '{fv.NO_ALERTS}' end as alertas from fact")
def _(w):
    return w.fact_of(*ROW, "quality_issues").select(*ROW, text.alerts_or_none(F.col("quality_issues")).alias("alertas"))


@query("c18_month_bucket", f"select {AT}, cast(date_trunc('month', data_venda) as date) as mes from fact")
def _(w):
    return w.fact_of(*ROW, "data_venda").select(*ROW, dates.month_of(F.col("data_venda")).alias("mes"))


_SIZE = "cast({} * 100 as hugeint)"
_RATIO = (
    "case when valor_referencia <> 0 then cast(cast(sign(valor_venda) * sign(valor_referencia) as hugeint) * "
    f"((2 * abs({_SIZE.format('valor_venda')}) * 1000000 + abs({_SIZE.format('valor_referencia')})) // (2 * abs({_SIZE.format('valor_referencia')}))) as decimal(38,0)) * cast(0.0001 as decimal(10,4)) end"
)


@query("c19_safe_ratio", f"select {AT}, cast({_RATIO} as decimal(28,4)) as percentual from vendas")
def _(w):
    """Sold against reference, all rows: signs, zeros and missing references as they come."""
    ratio = numbers.safe_ratio(F.col("valor_venda").cast(numbers.SUM), F.col("valor_referencia").cast(numbers.SUM))
    return w.read("vendas").select(*ROW, (ratio * 100).cast("decimal(28,4)").alias("percentual"))


_ODD = "case when event_id % 7 = 0 then cast('nan' as double) when event_id % 11 = 0 then cast('infinity' as double) when event_id % 13 = 0 then cast('-infinity' as double) when event_id % 17 = 0 then cast('-0.0' as double) when event_id % 3 = 0 then -value * 1000 else value end"


@query("c20_finite_guard", f"select event_id, case when isfinite(x) then x + 0.0 end as valor from (select event_id, {_ODD} as x from events)")
def _(w):
    events = w.spark.read.parquet(f"{w.sf}/events.parquet").withColumn("x", F.expr(_ODD))
    return events.select("event_id", numbers.finite(F.col("x")).alias("valor"))


@query("c21_decimal_text", f"select event_id, {_pt('value', 2)} as texto, {_shorter(_pt('value', 2))} as curto from events")
def _(w):
    events, v = w.spark.read.parquet(f"{w.sf}/events.parquet"), F.col("value")
    return events.select("event_id", ptbr.decimal_text(v, 2).alias("texto"), ptbr.decimal_text(v, 2, trim=True).alias("curto"))


def _shown(name: str, sql: str, make) -> None:
    @query(name, f"select {AT}, {sql} as texto from fact")
    def _(w):
        return w.fact_of(*ROW, "valor_referencia", "desconto_concedido", "desconto_percentual").select(*ROW, make().alias("texto"))


_M = fv.MISSING_TEXT
_shown("c22_currency", f"coalesce('R$ ' || {_pt('valor_referencia', 2)}, '{_M}')", lambda: ptbr.currency(F.col("valor_referencia")))


@query("c23_compact_number", f"select event_id, {_compact('value * event_id * event_id')} as texto from events")
def _(w):
    events = w.spark.read.parquet(f"{w.sf}/events.parquet")
    x = F.col("value") * F.col("event_id") * F.col("event_id")
    return events.select("event_id", ptbr.compact_number(x).alias("texto"))


_shown(
    "c24_compact_currency",
    f"coalesce('R$ ' || case when abs(valor_referencia / 40) < 1000 then {_pt('valor_referencia / 40', 2)} else {_compact('valor_referencia / 40')} end, '{_M}')",
    lambda: ptbr.compact_currency(F.col("valor_referencia").cast("double") / 40),
)


@query("c25_integer_text", "select event_id, translate(format('{:,}', cast(trunc(value * event_id) as bigint)), ',', '.') as texto from events")
def _(w):
    events = w.spark.read.parquet(f"{w.sf}/events.parquet")
    return events.select("event_id", ptbr.integer_text(F.col("value") * F.col("event_id")).alias("texto"))


_shown("c26_percent_text", f"coalesce({_pt('desconto_percentual', 2)} || '%', '{_M}')", lambda: ptbr.percent_text(F.col("desconto_percentual")))
_shown(
    "c27_ratio_text",
    f"coalesce({_pt('(cast(desconto_concedido as double) / nullif(cast(valor_referencia as double), 0) * 100)', 2)} || '%', '{fv.ZERO_PERCENT}')",
    lambda: ptbr.ratio_text(F.col("desconto_concedido"), F.col("valor_referencia")),
)

_TICKS = """
select row_number() over (order by t) - 1 as posicao, t * step as valor from (
  select step, unnest(range(cast(floor(lo / step) as bigint), cast(ceil(hi / step) as bigint) + 1)) as t from (
    select lo, hi, mag * case when raw / mag <= 1 then 1 when raw / mag <= 2 then 2 when raw / mag <= 2.5 then 2.5
      when raw / mag <= 5 then 5 else 10 end as step from (
        select *, pow(10.0, floor(log10(raw))) as mag from (
          select lo, hi, (hi - lo) / 4.0 as raw from (
            select least(0.0, cast(min(receita) as double)) as lo, greatest(0.0, cast(max(receita) as double)) as hi from (
              select sum(valor_venda) as receita from fact group by date_trunc('month', data_venda)))))))
"""


@query("c28_axis_ticks", _TICKS)
def _(w):
    ticks = explore.axis_ticks(explore.monthly_series(w.sales_of("data_venda", "valor_venda", "venda_id")), "receita")
    return ticks.select(F.col("posicao").cast("bigint").alias("posicao"), "valor")


_PRESENTED = {
    "quality_issues": f"case when trim(quality_issues) <> '' then quality_issues else '{fv.NO_ALERTS}' end",
    "valor_venda": f"'R$ ' || {_pt('valor_venda', 2)}",
    "valor_referencia": f"coalesce('R$ ' || {_pt('valor_referencia', 2)}, '{_M}')",
    "desconto_percentual": f"coalesce({_pt('desconto_percentual', 2)} || '%', '{_M}')",
}


@query("c29_presented", "select " + ", ".join(f'{_PRESENTED.get(c, c)} as "{t}"' for c, t in fv.TRACE_TITLES.items()) + " from sales")
def _(w):
    return explore.presented(w.sales_of(*fv.TRACE_TITLES))
