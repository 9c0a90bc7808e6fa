"""Rules, filters, joins, aggregations, duplicates, sorts and unions over whole tables."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..operators import explore, keys, marts, metrics, rules
from . import adapter, oracle as o
from .book import query
from .scalar_queries import _BOARD, AT, ROW, _pt
from .world import as_of

# --- rules -------------------------------------------------------------------------------------------
for _i, (_rule, (_dim, _key)) in enumerate(rules.DIMENSION_RULES.items(), 1):

    @query(f"r{_i:02d}_{_rule}", f"select coalesce(sum(n), 0)::bigint as failed_rows from (select count(*) as n from {_dim} group by {_key} having count(*) > 1)")
    def _(w, _dim=_dim, _key=_key):
        return keys.repeated_row_count(w.clean(_dim), _key)


for _i, _rule in enumerate(o.SALES_RULES, 4):

    @query(f"r{_i:02d}_{_rule}", f"select {AT} from prepared where {o.rule_sql(_rule)}")
    def _(w, _rule=_rule):
        return w.failing(_rule).select(*ROW)


# --- predicates --------------------------------------------------------------------------------------
@query("d01_rule_catalog", "select c.*, coalesce(failed_rows, 0)::bigint as failed_rows from catalog c left join failures using (rule_id)")
def _(w):
    counts = w.report.select("rule_id", "failed_rows")
    return rules.catalog_table(w.spark).join(counts, "rule_id", "left")


@query("d02_valid_split", f"select {AT} from flagged where is_valid")
def _(w):
    return w.fact_of(*ROW)


@query("d02_quarantine", "select * from rejected")
def _(w):
    return w.rejected


@query("d03_date_range", f"select {AT}, data_venda from sales where data_venda between date '1997-03-05' and date '1998-10-20'")
def _(w):
    picked = explore.Selection(start=date(1997, 3, 5), end=date(1998, 10, 20))
    return explore.apply_selection(w.sales_of(*ROW, "data_venda"), picked)


@query("d04_value_filters", f"select {AT} from sales where marca in ('BRAND#2', 'BRAND#7', 'BRAND#17') and canal_origem in ('2-High', '5-Low') and forma_pagamento in ('Pix')")
def _(w):
    picked = explore.Selection(marca=("BRAND#2", "BRAND#7", "BRAND#17"), canal_origem=("2-High", "5-Low"), forma_pagamento=("Pix",))
    return explore.apply_selection(w.sales_of(*ROW, "marca", "canal_origem", "forma_pagamento"), picked).select(*ROW)


_SEARCH = " or ".join(f"coalesce(contains(lower({c}), 'ring'), false)" for c in fv.SEARCHED_COLUMNS)


@query("d05_text_search", f"select {AT} from sales where {_SEARCH}")
def _(w):
    return explore.search(w.sales_of(*ROW, *fv.SEARCHED_COLUMNS), "  RiNg ").select(*ROW)


@query("d06_with_alert", f"select {AT}, quality_issues from sales where trim(coalesce(quality_issues, '')) <> ''")
def _(w):
    return explore.with_alerts(w.sales_of(*ROW, "quality_issues"), True).select(*ROW, "quality_issues")


@query("d06_without_alert", f"select {AT} from sales where trim(coalesce(quality_issues, '')) = ''")
def _(w):
    return explore.with_alerts(w.sales_of(*ROW, "quality_issues"), False).select(*ROW)


@query("d07_board_filter", f"select * from ({_BOARD}) where severidade = 'Erro' and status = 'Falhou'")
def _(w):
    return explore.filter_board(explore.quality_board(w.report), "Erro", "Falhou")


@query("d08_affected_rules", f"select * from ({_BOARD}) where registros_afetados > 0")
def _(w):
    return explore.affected_rules(explore.quality_board(w.report))


@query("d09_filter_options", " union ".join(f"select '{a}' as atributo, {a} as valor from sales where {a} is not null" for a in fv.FILTER_ATTRIBUTES))
def _(w):
    return explore.filter_options(w.sales_of(*fv.FILTER_ATTRIBUTES))


@query("d09_period", "select min(data_venda) as inicio, max(data_venda) as fim from sales")
def _(w):
    return explore.period(w.sales_of("data_venda"))


_FIGURES = ("valor_venda", "desconto_concedido")


@query("d10_empty_selection", "select cast(0 as decimal(28,2)) as faturamento, count(*) as vendas, cast(null as decimal(18,4)) as ticket_medio, cast(0 as decimal(28,2)) as desconto_concedido from sales where marca = 'NENHUMA'")
def _(w):
    return explore.kpis(explore.apply_selection(w.sales_of("marca", *_FIGURES), explore.Selection(marca=("NENHUMA",))))


# --- joins -------------------------------------------------------------------------------------------
def _joined(need: str) -> "object":
    def make(w):
        out = w.looked_up({need})
        return out.drop(rules.VEHICLE_KNOWN, rules.STORE_KNOWN, rules.CONSULTANT_KNOWN)

    return make


for _i, (_need, _dim, _key, _eq) in enumerate(
    (
        ("vehicle", "veiculos", "veiculo_id", "="),
        ("store", "lojas", "loja_id", "="),
        ("consultant", "consultores", "consultor_id", "is not distinct from"),
    ),
    1,
):
    query(
        f"e{_i:02d}_join_{_need}",
        f"select v.*, d.* exclude ({_key}) from vendas v left join canon_{_dim} d on v.{_key} {_eq} d.{_key}",
    )(_joined(_need))

_ORPHANS = [r for r in o.SALES_RULES if r.startswith("orphan_")]


@query("e04_key_membership", f"select {AT}, " + ", ".join(f"coalesce({o.rule_sql(r)}, false) as {r}" for r in _ORPHANS) + " from prepared")
def _(w):
    chosen = [r for r in rules.sales_rules(as_of()) if r.rule_id in _ORPHANS]
    prepared = w.looked_up(set(rules.needs_of(chosen)), wide=False)
    return prepared.select(*ROW, *[rules.failing(r).alias(r.rule_id) for r in chosen])


@query("e05_consultant_store", f"select {AT}, v.consultor_id, d.consultor_loja_id as loja_esperada from vendas v left join canon_consultores d on v.consultor_id is not distinct from d.consultor_id")
def _(w):
    out = w.looked_up({"consultant"}, wide=False)
    return out.select(*ROW, "consultor_id", F.col(rules.CONSULTANT_STORE).alias("loja_esperada"))


@query("e06_many_to_one_guard", "select 'veiculo_id' as key, count(*) as rows from canon_veiculos union all select 'loja_id', count(*) from canon_lojas union all select 'consultor_id', count(*) from canon_consultores")
def _(w):
    c = w.canon()
    parts = [keys.assert_unique(c[d], k) for d, k in (("veiculos", "veiculo_id"), ("lojas", "loja_id"), ("consultores", "consultor_id"))]
    return reduce(DataFrame.unionByName, parts)


# --- aggregations ------------------------------------------------------------------------------------
@query("f01_monthly_mart", "select * from mart")
def _(w):
    return marts.monthly_mart(w.fact_of(*marts.MART_READS)).withColumn("mes", F.col("mes").cast("date"))


_BELOW = "valor_venda < valor_referencia"
_WEIGHED = ("valor_venda", "valor_referencia", "desconto_concedido")


@query("f02_filtered_sums", f"select marca, cast(sum(desconto_concedido) filter (where {_BELOW}) as decimal(28,2)) as desconto, cast(sum(valor_referencia) filter (where {_BELOW}) as decimal(28,2)) as referencia from fact group by marca")
def _(w):
    sums = [F.sum(F.when(metrics.below_reference(), F.col(c))).cast(explore.TOTAL).alias(a) for c, a in (("desconto_concedido", "desconto"), ("valor_referencia", "referencia"))]
    return w.fact_of("marca", *_WEIGHED).groupBy("marca").agg(*sums)


@query("f03_weighted_discount", f"select loja, {o.weighted(f'sum(desconto_concedido) {o.BELOW}', f'sum(valor_referencia) {o.BELOW}')} as desconto_percentual_ponderado from fact group by loja")
def _(w):
    return w.fact_of("loja", *_WEIGHED).groupBy("loja").agg(metrics.discount_percent().alias("desconto_percentual_ponderado"))


@query("f04_overall_metrics", f"select {o.financial('decimal(28,2)', 'decimal(18,4)', 4)} from fact")
def _(w):
    return metrics.overall(w.fact_of(*marts.MART_READS[4:]))


_KPIS = f"select cast(sum(valor_venda) as decimal(28,2)) as faturamento, count(*) as vendas, {o.mean('valor_venda', 'decimal(18,4)', 4)} as ticket_medio, cast(sum(desconto_concedido) as decimal(28,2)) as desconto_concedido from sales"


@query("f05_kpis", f"{_KPIS} where uf in ('NATION_3', 'NATION_5', 'NATION_18')")
def _(w):
    return explore.kpis(explore.apply_selection(w.sales_of("uf", *_FIGURES), explore.Selection(uf=("NATION_3", "NATION_5", "NATION_18"))))


@query("f06_monthly_series", "select cast(date_trunc('month', data_venda) as date) as mes, cast(sum(valor_venda) as decimal(28,2)) as receita, count(venda_id) as vendas from sales group by 1")
def _(w):
    return explore.monthly_series(w.sales_of("data_venda", "valor_venda", "venda_id"))


@query("f06_monthly_events", "select cast(date_trunc('month', ts) as date) as mes, count(*) as eventos, cast(sum(cast(value as decimal(18,2))) as decimal(28,2)) as total from events group by 1")
def _(w):
    from ..functions.dates import month_of

    events = w.spark.read.parquet(f"{w.sf}/events.parquet")
    return events.groupBy(month_of(F.col("ts")).alias("mes")).agg(
        F.count(F.lit(1)).alias("eventos"), F.sum(F.col("value").cast("decimal(18,2)")).cast(explore.TOTAL).alias("total")
    )


@query("f07_revenue_by_brand", "select marca, cast(sum(valor_venda) as decimal(28,2)) as receita from sales where marca is not null group by marca")
def _(w):
    return explore.revenue_by_brand(w.sales_of("marca", "valor_venda"))


@query("f08_by_store", "select loja, count(venda_id) as vendas, cast(sum(valor_venda) as decimal(28,2)) as receita from sales where loja is not null group by loja")
def _(w):
    return explore.by_store(w.sales_of("loja", "valor_venda", "venda_id"))


@query("f09_by_channel", f"select canal, vendas, {_pt('(cast(vendas as double) / cast(sum(vendas) over () as double) * 100)', 2)} || '%' as percentual from (select coalesce(canal_origem, '{fv.NOT_INFORMED}') as canal, count(*) as vendas from sales group by 1)")
def _(w):
    return explore.by_channel(w.sales_of("canal_origem"))


@query("f10_by_payment", f"select coalesce(forma_pagamento, '{fv.NOT_INFORMED}') as forma, count(*) as vendas from sales group by 1")
def _(w):
    return explore.by_payment(w.sales_of("forma_pagamento"))


@query("f11_volumes", f"select *, {_pt('(cast(validos as double) / cast(recebidos as double) * 100)', 2)} || '%' as taxa_aprovacao from (select (select count(*) from vendas) as recebidos, (select count(*) from fact) as validos, (select count(*) from rejected) as rejeitados)")
def _(w):
    judged = w.once("validity", w.judged(rules.VALID))
    return explore.volumes(w.read("vendas"), judged.where(rules.VALID), judged.where(~F.col(rules.VALID)))


@query("f12_rule_counts", "select count(*) as executadas, count(*) filter (where status = 'passed') as aprovadas, count(*) filter (where status = 'failed') as falhas, count(*) filter (where status = 'warning') as avisos from report")
def _(w):
    return explore.rule_counts(w.report)


@query("f13_quality_report", "select * from report")
def _(w):
    return w.report.withColumn("position", F.col("position").cast("int"))


@query("f14_trace_counts", "select count(*) as registros, count(*) filter (where trim(quality_issues) <> '') as com_alertas from sales")
def _(w):
    return explore.trace_counts(w.sales_of("quality_issues"))


_RECONCILED = " union all ".join(
    f"select '{c}' as metrica, cast(cast({e} as {t}) as varchar) as fato, cast(cast(sum(m.{c}) as {t}) as varchar) as mart, true as confere from mart m"
    for c, e, t in (
        ("quantidade_vendas", "(select count(*) from fact)", "bigint"),
        ("receita", "(select sum(valor_venda) from fact)", "decimal(28,2)"),
        ("desconto_concedido_total", "(select sum(desconto_concedido) from fact)", "decimal(28,2)"),
        ("agio_referencia_total", "(select sum(agio_referencia) from fact)", "decimal(28,2)"),
        ("variacao_liquida_referencia_total", "(select sum(variacao_liquida_referencia) from fact)", "decimal(28,2)"),
    )
)


@query("f15_reconcile", _RECONCILED)
def _(w):
    fact = w.once("fact_for_mart", w.fact_of(*marts.MART_READS))  # both sides read it
    return marts.reconcile(fact, marts.monthly_mart(fact))


# --- duplicates --------------------------------------------------------------------------------------
@query("g01_mark_repeated", f"select {AT}, coalesce(veiculo_id is not null and vehicle_sales > 1, false) as repetido from prepared")
def _(w):
    sales = w.clean("vendas")
    return keys.mark_repeated(sales, "veiculo_id", "repetido", w.hot_of("veiculo_id"), w.once).select(*ROW, "repetido")


@query("g02_mark_later", f"select {AT}, coalesce(venda_id is not null and occurrence > 1, false) as posterior from prepared")
def _(w):
    sales = w.clean("vendas")
    return keys.mark_later(sales, "venda_id", "posterior", w.hot_of("venda_id"), w.once).select(*ROW, "posterior")


@query("g03_first_per_key", "select * exclude (rn) from (select *, row_number() over (partition by consultor_id order by lower(__source_file), __source_file, __source_line) as rn from consultores) where rn = 1")
def _(w):
    return keys.first_per_key(w.clean("consultores"), "consultor_id")


# --- sorts and limits --------------------------------------------------------------------------------
@query("h01_top_brands", "select marca, cast(sum(valor_venda) as decimal(28,2)) as receita from sales where marca is not null group by marca order by receita desc, marca limit 10")
def _(w):
    return explore.top_brands(w.sales_of("marca", "valor_venda"))


@query("h02_investigation_sort", f"select {AT}, data_venda, valor_venda from sales")
def _(w):
    rows = w.once("investigated", w.sales_of(*ROW, "data_venda", "valor_venda"))  # a sort reads its rows twice
    return explore.sort_sales(rows, "newest").select(*ROW, "data_venda", "valor_venda")


@query("h03_board_order", 'select "check", failed_rows from report')
def _(w):
    return explore.board_order(w.report).select("check", "failed_rows")


@query("h04_display_sorts", "select loja, cast(sum(valor_venda) as decimal(28,2)) as receita from sales where loja is not null group by loja")
def _(w):
    return explore.by_store(w.sales_of("loja", "valor_venda", "venda_id")).select("loja", "receita")


@query("h05_frequency_order", f"select coalesce(canal_origem, '{fv.NOT_INFORMED}') as canal, count(*) as vendas from sales group by 1")
def _(w):
    return explore.by_channel(w.sales_of("canal_origem")).select("canal", "vendas")


# --- unions ------------------------------------------------------------------------------------------
@query("i01_union_all", "select * from raw_vendas")
def _(w):
    """The monthly files of one contract put together again."""
    from ..sources.batch import combine

    sales = w.raw("vendas")
    halves = [sales.where(F.col("__source_file") < "vendas_1998"), sales.where(F.col("__source_file") >= "vendas_1998")]
    return combine(halves, "vendas")


# --- end to end --------------------------------------------------------------------------------------
@query("l02_validate_fact", "select * from fact")
def _(w):
    return w.fact


_L4 = "uf in ('NATION_1', 'NATION_2', 'NATION_4', 'NATION_8') and data_venda between date '1996-01-01' and date '1999-12-31'"


@query("l04_explore_investigation", f"select {', '.join(fv.EXPORTED_COLUMNS)} from sales where {_L4} and trim(quality_issues) <> '' and ({_SEARCH.replace('ring', 'brand#1')})")
def _(w):
    picked = explore.Selection(start=date(1996, 1, 1), end=date(1999, 12, 31), uf=("NATION_1", "NATION_2", "NATION_4", "NATION_8"))
    sales = explore.apply_selection(w.sales_of(*fv.EXPORTED_COLUMNS), picked)
    return explore.export_rows(explore.investigate(sales, "Brand#1", alerts=True, order="highest"))
