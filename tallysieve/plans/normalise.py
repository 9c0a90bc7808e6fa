"""Typed tables from raw text, one projection per contract."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, numbers, text

# Column -> kind of cleaning. Columns that are not listed pass through.
CLEANERS: dict[str, dict[str, str]] = {
    "vendas": {
        "venda_id": "id", "data_venda": "date", "veiculo_id": "id", "loja_id": "id", "consultor_id": "id",
        "canal_origem": "text", "forma_pagamento": "text", "valor_referencia": "money", "valor_venda": "money",
    },
    "consultores": {
        "consultor_id": "id", "consultor": "text", "loja_id": "id", "equipe": "text", "data_admissao": "date",
    },
    "lojas": {"loja_id": "id", "loja": "text", "cidade": "text", "uf": "id", "cluster": "text"},
    "veiculos": {
        "veiculo_id": "id", "ano_modelo": "number", "marca": "text", "modelo": "text", "versao": "text",
        "carroceria": "text", "cambio": "text", "combustivel": "text", "tipo_veiculo": "text",
        "quilometragem": "number", "cor_externa": "text", "cor_interna": "text", "score_avaliacao": "number",
    },
}
FUNCTIONS = {
    "id": text.clean_id, "text": text.clean_text, "date": dates.parse_date, "money": numbers.parse_money,
    "number": numbers.parse_number,
}
KEPT_ORIGINALS: dict[str, tuple[str, ...]] = {"vendas": ("data_venda", "valor_referencia", "valor_venda")}


def normalise(raw: DataFrame, contract: str) -> DataFrame:
    """Apply the cleaners of one contract; originals of dates and amounts are kept as `<column>_original`."""
    kinds = {c: k for c, k in CLEANERS[contract].items() if c in raw.columns}
    originals = {f"{c}_original": F.col(c) for c in KEPT_ORIGINALS.get(contract, ()) if c in raw.columns}
    return raw.withColumns(originals).withColumns({c: FUNCTIONS[k](F.col(c)) for c, k in kinds.items()})


def normalise_all(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: normalise(df, name) for name, df in raw.items()}
