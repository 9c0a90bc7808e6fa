"""Messy sales and dimensions drawn from the driver's order tables.

Every expression is one SQL text that both engines read the same way.
The Spark side reads the parquet tables, the oracle side names them as views.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.normalise import normalise

AS_OF = "2026-01-01"
COPIES = 30  # vehicles per part
NBSP = "\u00a0"


def _day(iso: str, shape: int) -> str:
    """An ISO day text in one of the three accepted shapes."""
    if shape == 0:
        return iso
    if shape == 1:
        return f"replace({iso}, '-', '/')"
    return f"concat(substring({iso}, 9, 2), '/', substring({iso}, 6, 2), '/', substring({iso}, 1, 4))"


def _text(x: str) -> str:
    return f"cast({x} as string)"


def _grouped(money: str) -> str:
    """1234.5 as `1.234,50`."""
    whole = f"cast(floor({money}) as bigint)"
    cents = f"cast(({money} - floor({money})) * 100 as bigint)"
    return (
        f"concat(cast(cast(floor({money} / 1000) as bigint) as string), '.', "
        f"lpad(cast({whole} % 1000 as string), 3, '0'), ',', lpad(cast({cents} as string), 2, '0'))"
    )


K, REF, DAY = "k", "ref", "day"
# Computed once per row, below the messy columns.
SALES_BASE = {
    K: "(l_orderkey * 7 + l_linenumber)",
    REF: "cast(l_extendedprice as decimal(18,2))",
    DAY: "cast(cast(l_shipdate as date) as string)",
}
SOLD = f"cast({REF} * (1 - cast(l_discount as decimal(4,2))) as decimal(18,2))"


def sales_columns(n_stores: str) -> dict[str, str]:
    store_no = f"case when {K} % 17 = 0 then l_suppkey else o_custkey % {n_stores} end"
    return {
        "venda_id": (
            f"case when {K} % 211 = 0 then 'N/A' "
            f"else concat(' s', {_text('l_orderkey')}, '-', {_text('l_linenumber')}, ' ') end"
        ),
        "data_venda": (
            f"case when {K} % 97 = 0 then '2025-02-30' when {K} % 101 = 0 then '2099-01-01' "
            f"when {K} % 223 = 0 then '' when {K} % 3 = 0 then {DAY} when {K} % 3 = 1 then {_day(DAY, 1)} "
            f"else concat(' ', {_day(DAY, 2)}) end"
        ),
        "veiculo_id": (
            f"case when {K} % 103 = 0 then 'P-404' when {K} % 107 = 0 then '-' "
            f"else concat('p', {_text('l_partkey')}, '-', {_text(f'l_orderkey % {COPIES}')}) end"
        ),
        "loja_id": (
            f"case when {K} % 109 = 0 then 'L-404' when {K} % 113 = 0 then '' "
            f"else concat('L', {_text(store_no)}) end"
        ),
        "consultor_id": (
            f"case when {K} % 127 = 0 then 'C-404' when {K} % 131 = 0 then 'null' "
            f"else concat('c', {_text('o_custkey')}, '{NBSP}') end"
        ),
        "canal_origem": (
            f"case when {K} % 19 = 0 then 'None' when {K} % 2 = 0 then concat('  ', lower(o_orderpriority)) "
            f"else concat(o_orderpriority, '{NBSP}') end"
        ),
        "forma_pagamento": (
            f"case when {K} % 29 = 0 then 'n/a' when l_returnflag = 'A' then 'À vista' "
            "when l_returnflag = 'N' then ' pix' else 'FINANCIAMENTO PRÓPRIO' end"
        ),
        "valor_referencia": (
            f"case when {K} % 137 = 0 then 'x' when {K} % 10 = 9 then {_grouped(REF)} "
            f"when {K} % 2 = 1 then concat('R$ ', replace({_text(REF)}, '.', ',')) else {_text(REF)} end"
        ),
        "valor_venda": (
            f"case when {K} % 139 = 0 then '0' when {K} % 149 = 0 then '-1.00' when {K} % 151 = 0 then '9999999' "
            f"when {K} % 157 = 0 then '10.555' when {K} % 163 = 0 then '12e3' "
            f"when {K} % 5 = 0 then {_text(f'({REF} + 100)')} else {_text(SOLD)} end"
        ),
        "__source_file": f"concat('vendas_', replace(substring({DAY}, 1, 7), '-', '_'), '.csv')",
        "__source_line": (
            "cast((l_orderkey * 8 + l_linenumber) * 1000003 + (l_partkey * 31 + l_suppkey * 17) % 1000003 as bigint)"
        ),
    }


def vehicle_columns(copy: bool) -> dict[str, str]:
    j = "((p_partkey + i) % 7)"
    line = "p_partkey * 64 + i + 2" + (" + 32" if copy else "")
    return {
        "veiculo_id": f"concat('P', {_text('p_partkey')}, '-', {_text('i')})",
        "ano_modelo": f"case when {j} = 6 then 'x' else {_text('2000 + p_size % 25')} end",
        "marca": (
            "case when p_partkey % 3 = 0 then p_brand when p_partkey % 3 = 1 then concat(' ', lower(p_brand)) "
            "when p_partkey % 11 = 5 then 'NA' else concat(p_brand, ' ') end"
        ),
        "modelo": "p_name",
        "versao": f"concat('v', {_text('i')})",
        "carroceria": "'cópia'" if copy else "p_type",
        "cambio": "case when p_size % 2 = 0 then 'Auto' else 'Manual' end",
        "combustivel": "case when p_size % 5 = 0 then '' else 'Flex' end",
        "tipo_veiculo": "p_type",
        "quilometragem": (
            f"case {j} when 0 then '0' when 1 then '12.345,6' when 2 then '1e3' when 3 then '5f' "
            f"when 4 then '-.5' when 5 then ' 1 234,50 ' else '1_000' end"
        ),
        "cor_externa": "case when i % 2 = 0 then 'Preto' else 'branco' end",
        "cor_interna": "'Preto'",
        "score_avaliacao": f"case when {j} = 3 then 'NaN' when {j} < 3 then '9.5' else '8,75' end",
        "__source_file": "'dim_veiculos.csv'",
        "__source_line": f"cast({line} as bigint)",
    }


def store_columns(copy: bool) -> dict[str, str]:
    line = "s_suppkey * 4 + 2" + (" + 1" if copy else "")
    return {
        "loja_id": f"concat('l', {_text('s_suppkey')})",
        "loja": "'cópia'" if copy else "s_name",
        "cidade": "concat('Cidade ', n_name)",
        "uf": "lower(n_name)",
        "cluster": "case s_suppkey % 4 when 0 then 'A' when 1 then 'B' when 2 then 'none' else 'C' end",
        "__source_file": "'dim_lojas.csv'",
        "__source_line": f"cast({line} as bigint)",
    }


def consultant_columns(n_stores: str, copy: str) -> dict[str, str]:
    """copy: '' for the rows themselves, 'copy' for later copies, 'null' for rows without id."""
    line = "c_custkey * 4 + 2" + {"": "", "copy": " + 1", "null": " + 2"}[copy]
    hired = "cast(cast(date '2015-01-01' + cast(c_custkey % 3000 as int) as date) as string)"
    return {
        "consultor_id": "'-'" if copy == "null" else f"concat('C', {_text('c_custkey')})",
        "consultor": {"": "c_name", "copy": "'cópia'", "null": "'sem cadastro'"}[copy],
        "loja_id": f"concat('L', {_text(f'c_custkey % {n_stores}')})",
        "equipe": "lower(c_mktsegment)",
        "data_admissao": (
            f"case when c_custkey % 61 = 0 then '31/02/2020' else {_day(hired, 2)} end"
        ),
        "__source_file": "'dim_consultores.csv'",
        "__source_line": f"cast({line} as bigint)",
    }


# Which source rows come in extra forms.
VEHICLE_COPY = "p_partkey % 50 = 0"
STORE_COPY = "s_suppkey % 20 = 3"
CONSULTANT_COPY = "c_custkey % 40 = 0"
CONSULTANT_NULL = "c_custkey % 90 = 7"


# --- Spark ---------------------------------------------------------------------------------------
def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(e).alias(c) for c, e in columns.items()])


def _store_count(spark: SparkSession, sf: str):
    """Number of stores as a scalar subquery."""
    return table(spark, sf, "supplier").agg(F.count(F.lit(1)).alias("n")).scalar()


def raw_sales(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    # Both sides grow together, so neither is broadcast; the shuffle also spreads a file of one row group.
    joined = table(spark, sf, "lineitem").join(
        orders.hint("merge"), F.expr("l_orderkey = o_orderkey"), "left"
    )
    base = joined.withColumns({c: F.expr(e) for c, e in SALES_BASE.items()})
    return _select(base.withColumn("n_stores", _store_count(spark, sf)), sales_columns("n_stores"))


def raw_vehicles(spark: SparkSession, sf: str) -> DataFrame:
    # Spread the parts before each becomes many rows; a single row group would keep one task busy.
    spread = table(spark, sf, "part").repartition(spark.sparkContext.defaultParallelism)
    part = spread.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    own = _select(part, vehicle_columns(False))
    return own.unionByName(_select(part.where(VEHICLE_COPY), vehicle_columns(True)))


def raw_stores(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation")
    joined = table(spark, sf, "supplier").join(nation, F.expr("s_nationkey = n_nationkey"), "left")
    own = _select(joined, store_columns(False))
    return own.unionByName(_select(joined.where(STORE_COPY), store_columns(True)))


def raw_consultants(spark: SparkSession, sf: str) -> DataFrame:
    people = table(spark, sf, "customer").withColumn("n_stores", _store_count(spark, sf))
    own = _select(people, consultant_columns("n_stores", ""))
    copies = _select(people.where(CONSULTANT_COPY), consultant_columns("n_stores", "copy"))
    nulls = _select(people.where(CONSULTANT_NULL), consultant_columns("n_stores", "null"))
    return own.unionByName(copies).unionByName(nulls)


RAW = {
    "vendas": raw_sales, "consultores": raw_consultants, "lojas": raw_stores, "veiculos": raw_vehicles,
}


def raw(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return RAW[name](spark, sf)


def clean(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return normalise(raw(spark, sf, name), name)

