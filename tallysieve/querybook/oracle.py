"""The same tables as common table expressions for the SQL oracle."""

from __future__ import annotations

from .. import fixed_values as fv
from . import adapter as a

N_STORES = "(select count(*) from supplier)"
WS = " \t\n\r" + a.NBSP
NULLS = ", ".join(f"'{w}'" for w in fv.NULL_WORDS)


def _columns(columns: dict[str, str]) -> str:
    return ", ".join(f"{e} as {c}" for c, e in columns.items())


def text(c: str) -> str:
    t = f"trim({c}, '{WS}')"
    return f"(case when lower({t}) not in ({NULLS}) then {t} end)"


def ident(c: str) -> str:
    return f"upper({text(c)})"


def bare(c: str) -> str:
    b = f"regexp_replace(replace({c}, 'R$', ''), '[\\s{a.NBSP}]+', '', 'g')"
    return f"(case when contains({b}, ',') then replace(replace({b}, '.', ''), ',', '.') else {b} end)"


def money(c: str) -> str:
    b = bare(c)
    return (
        f"(case when regexp_matches({b}, '^[+-]?([0-9]+(\\.[0-9]{{0,2}}0*)?|\\.[0-9]{{1,2}}0*)$') "
        f"then try_cast({b} as decimal(18,2)) when regexp_matches({b}, '^[0-9]{{1,9}}e[0-9]$') "
        f"then cast(cast({b} as double) as decimal(18,2)) end)"
    )


def number(c: str) -> str:
    b = bare(c)
    return (
        f"(case when regexp_matches({b}, '^[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)(e[+-]?[0-9]+)?$') "
        f"then try_cast({b} as double) end)"
    )


def day(c: str) -> str:
    t = text(c)
    return (
        f"(case when regexp_matches({t}, '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}$') then try_cast({t} as date) "
        f"when regexp_matches({t}, '^[0-9]{{4}}/') then cast(try_strptime({t}, '%Y/%m/%d') as date) "
        f"when regexp_matches({t}, '^[0-9]{{1,2}}/') then cast(try_strptime({t}, '%d/%m/%Y') as date) end)"
    )


KINDS = {"id": ident, "text": text, "date": day, "money": money, "number": number}


def _clean(name: str) -> str:
    from ..plans.normalise import CLEANERS, KEPT_ORIGINALS

    cols = [f"{KINDS[k](c)} as {c}" for c, k in CLEANERS[name].items()]
    cols += ["__source_file", "__source_line"]
    cols += [f"{c} as {c}_original" for c in KEPT_ORIGINALS.get(name, ())]
    return f"select {', '.join(cols)} from raw_{name}"


def _canon(name: str, key: str, prefix: str) -> str:
    renames = f"__source_file as {prefix}_source_file, __source_line as {prefix}_source_line"
    rest = [c for c in fv.CONTRACT_COLUMNS[name]]
    cols = ", ".join(
        f"{c} as consultor_loja_id" if name == "consultores" and c == "loja_id" else c for c in rest
    )
    return (
        f"select {cols}, {renames} from (select *, row_number() over (partition by {key} "
        f"order by lower(__source_file), __source_file, __source_line) as rn from {name}) where rn = 1"
    )


def rule_sql(rule_id: str) -> str:
    """Boolean SQL of one sales rule over the prepared rows."""
    return {
        "missing_venda_id": "venda_id is null",
        "duplicate_venda_id": "venda_id is not null and occurrence > 1",
        "invalid_data_venda": "data_venda is null",
        "future_data_venda": f"data_venda > date '{a.AS_OF}'",
        "invalid_valor_venda": "valor_venda is null",
        "negative_valor_venda": "valor_venda < 0",
        "zero_valor_venda": "valor_venda = 0",
        "suspicious_valor_venda_placeholder": "valor_venda = 9999999.00",
        "invalid_valor_referencia": "valor_referencia is null",
        "missing_veiculo_id": "veiculo_id is null",
        "orphan_veiculo_id": "veiculo_id is not null and veiculo_id not in (select veiculo_id from veiculos where veiculo_id is not null)",
        "missing_loja_id": "loja_id is null",
        "orphan_loja_id": "loja_id is not null and loja_id not in (select loja_id from lojas where loja_id is not null)",
        "missing_consultor_id": "consultor_id is null",
        "orphan_consultor_id": "consultor_id is not null and consultor_id not in (select consultor_id from consultores where consultor_id is not null)",
        "consultor_loja_mismatch": "consultor_id is not null and expected_store <> loja_id",
        "veiculo_multiple_sales": "veiculo_id is not null and vehicle_sales > 1",
    }[rule_id]


SALES_RULES = [r[0] for r in fv.RULE_TEXTS if r[3] == "vendas"]
_FATAL = [r[0] for r in fv.RULE_TEXTS if r[7]]
ORDER = "lower(__source_file), __source_file, __source_line"


def mean(x: str, to: str = "decimal(18,2)", scale: int = 2) -> str:
    """Mean of positive amounts, rounded half-up in integers."""
    p = 10 ** (scale - 2)
    n = f"(2 * cast(sum({x}) * 100 as hugeint) * {p} + count({x})) // (2 * count({x}))"
    return (
        f"cast(cast({n} as varchar) as decimal(38,0)) * cast({10 ** -scale:.{scale}f} as decimal(10,{scale}))".join(
            ("cast(", f" as {to})")
        )
    )


def weighted(num: str, den: str) -> str:
    """num / den * 100 at four decimals, rounded half-up in integers."""
    n, d = f"cast({num} * 100 as hugeint)", f"cast({den} * 100 as hugeint)"
    return (
        f"cast(cast(cast((2 * {n} * 1000000 + {d}) // (2 * nullif({d}, 0)) as varchar) as decimal(38,0)) "
        "* cast(0.0001 as decimal(10,4)) as decimal(9,4))"
    )


BELOW = "filter (where valor_venda < valor_referencia)"


def financial(money: str = "decimal(18,2)", ticket: str = "decimal(18,2)", scale: int = 2) -> str:
    return (
        "count(*) as quantidade_vendas, "
        f"cast(sum(valor_venda) as {money}) as receita, {mean('valor_venda', ticket, scale)} as ticket_medio, "
        f"cast(sum(desconto_concedido) as {money}) as desconto_concedido_total, "
        f"cast(sum(agio_referencia) as {money}) as agio_referencia_total, "
        f"cast(sum(variacao_liquida_referencia) as {money}) as variacao_liquida_referencia_total, "
        f"{weighted(f'sum(desconto_concedido) {BELOW}', f'sum(valor_referencia) {BELOW}')} as desconto_percentual_ponderado"
    )


_SALES_OUT = (
    "venda_id, data_venda, veiculo_id, loja_id, consultor_id, canal_origem, forma_pagamento, valor_referencia, "
    "valor_venda, __source_file, __source_line, data_venda_original, valor_referencia_original, "
    "valor_venda_original, quality_issues, is_valid"
)
SALES_OUT = [c.strip() for c in _SALES_OUT.split(",")]

CTES: dict[str, str] = {
    "sales_base": (
        f"select *, {_columns(a.SALES_BASE)} from lineitem left join orders on l_orderkey = o_orderkey"
    ),
    "raw_vendas": f"select {_columns(a.sales_columns(N_STORES))} from sales_base",
    "vehicle_base": f"select part.*, i from part, (select unnest(range({a.COPIES})) as i)",
    "raw_veiculos": (
        f"select {_columns(a.vehicle_columns(False))} from vehicle_base union all "
        f"select {_columns(a.vehicle_columns(True))} from vehicle_base where {a.VEHICLE_COPY}"
    ),
    "store_base": "select * from supplier left join nation on s_nationkey = n_nationkey",
    "raw_lojas": (
        f"select {_columns(a.store_columns(False))} from store_base union all "
        f"select {_columns(a.store_columns(True))} from store_base where {a.STORE_COPY}"
    ),
    "raw_consultores": " union all ".join(
        f"select {_columns(a.consultant_columns(N_STORES, copy))} from customer where {cond}"
        for copy, cond in (("", "true"), ("copy", a.CONSULTANT_COPY), ("null", a.CONSULTANT_NULL))
    ),
    **{name: _clean(name) for name in ("vendas", "veiculos", "lojas", "consultores")},
    "canon_veiculos": _canon("veiculos", "veiculo_id", "veiculo"),
    "canon_lojas": _canon("lojas", "loja_id", "loja"),
    "canon_consultores": _canon("consultores", "consultor_id", "consultor"),
    "prepared": (
        "select v.*, c.consultor_loja_id as expected_store, "
        f"row_number() over (partition by venda_id order by {ORDER}) as occurrence, "
        "count(*) over (partition by veiculo_id) as vehicle_sales "
        "from vendas v left join canon_consultores c on v.consultor_id = c.consultor_id"
    ),
    "flagged": (
        "select *, concat_ws('|', " + ", ".join(f"case when {rule_sql(r)} then '{r}' end" for r in SALES_RULES)
        + ") as quality_issues, not (" + " or ".join(f"coalesce({rule_sql(r)}, false)" for r in _FATAL)
        + ") as is_valid from prepared"
    ),
    "rejected": f"select {_SALES_OUT} from flagged where not is_valid",
    "fact_joined": (
        "select " + ", ".join(f"f.{c}" for c in SALES_OUT)
        + ", v.* exclude (veiculo_id), l.* exclude (loja_id), c.* exclude (consultor_id) "
        "from flagged f left join canon_veiculos v on f.veiculo_id = v.veiculo_id "
        "left join canon_lojas l on f.loja_id = l.loja_id "
        "left join canon_consultores c on f.consultor_id is not distinct from c.consultor_id where is_valid"
    ),
    "fact_gaps": (
        "select *, case when valor_referencia is not null then greatest(valor_referencia - valor_venda, 0) end as d, "
        "case when valor_referencia is not null then greatest(valor_venda - valor_referencia, 0) end as g "
        "from fact_joined"
    ),
    "fact": (
        "select * exclude (d, g), cast(d as decimal(18,2)) as desconto_concedido, "
        "cast(g as decimal(18,2)) as agio_referencia, cast(d - g as decimal(18,2)) as variacao_liquida_referencia, "
        f"case when valor_referencia > 0 then {weighted('d', 'valor_referencia')} end as desconto_percentual "
        "from fact_gaps"
    ),
    "catalog": (
        "select * from (values "
        + ", ".join(
            "(" + ", ".join([str(i)] + [str(x).lower() if isinstance(x, bool) else f"'{x}'" for x in row]) + ")"
            for i, row in enumerate(fv.RULE_TEXTS)
        )
        + ") t(position, rule_id, description, severity, dataset, \"condition\", treatment, reason, invalidates_sale)"
    ),
    "failures": (
        " union all ".join(
            f"select 'duplicate_{k}' as rule_id, coalesce(sum(n), 0)::bigint as failed_rows from "
            f"(select count(*) as n from {t} group by {k} having count(*) > 1)"
            for t, k in (("consultores", "consultor_id"), ("lojas", "loja_id"), ("veiculos", "veiculo_id"))
        )
        + " union all "
        + " union all ".join(
            f"select '{r}', count(*) filter (where {rule_sql(r)}) from prepared" for r in SALES_RULES
        )
    ),
    "report": (
        "select position, rule_id as \"check\", rule_id, description, severity, dataset, \"condition\", treatment, "
        "reason, invalidates_sale, failed_rows, case when failed_rows = 0 then 'passed' when severity = 'error' "
        "then 'failed' else 'warning' end as status from catalog join failures using (rule_id)"
    ),
    "mart": (
        "select cast(date_trunc('month', data_venda) as date) as mes, marca, loja, uf, "
        f"{financial()} from fact group by 1, 2, 3, 4"
    ),
    "sales": (
        "select venda_id, data_venda, valor_venda, valor_referencia, desconto_concedido, desconto_percentual, "
        "upper(trim(marca)) as marca, modelo, loja, uf, "
        "replace(replace(replace(replace(replace(replace(lower(trim(canal_origem)), 'urgent', 'Urgent'), "
        "'high', 'High'), 'medium', 'Medium'), 'low', 'Low'), 'not', 'Not'), 'specified', 'Specified') "
        "as canal_origem, upper(substring(trim(forma_pagamento), 1, 1)) || lower(substring(trim(forma_pagamento), 2)) "
        "as forma_pagamento, consultor, quality_issues, __source_file, __source_line from fact"
    ),
}


def sql(body: str) -> str:
    """The body with every common table expression it reaches, in order of definition."""
    needed: set[str] = set()

    def reach(statement: str) -> None:
        words = set(statement.replace("(", " ").replace(")", " ").replace(",", " ").split())
        for name in CTES:
            if name in words and name not in needed:
                needed.add(name)
                reach(CTES[name])

    reach(body)
    parts = [f"{name} as materialized ({CTES[name]})" for name in CTES if name in needed]
    return (f"with {', '.join(parts)} " if parts else "") + body
