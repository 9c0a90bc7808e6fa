"""Words, names, limits and texts that results must carry unchanged.

Nothing here is logic. Every table is stated once, in its natural order, and the rest of the package
only refers to it.
"""

from __future__ import annotations

# --- Fixed values: column contracts, in header order -------------------------------------------
CONTRACT_COLUMNS: dict[str, tuple[str, ...]] = {
    "consultores": ("consultor_id", "consultor", "loja_id", "equipe", "data_admissao"),
    "lojas": ("loja_id", "loja", "cidade", "uf", "cluster"),
    "veiculos": (
        "veiculo_id", "ano_modelo", "marca", "modelo", "versao", "carroceria", "cambio",
        "combustivel", "tipo_veiculo", "quilometragem", "cor_externa", "cor_interna",
        "score_avaliacao",
    ),
    "vendas": (
        "venda_id", "data_venda", "veiculo_id", "loja_id", "consultor_id", "canal_origem",
        "forma_pagamento", "valor_referencia", "valor_venda",
    ),
}
SOURCE_FILE = "__source_file"
SOURCE_LINE = "__source_line"

# --- Fixed values: file names and archive layout -------------------------------------------------
DIMENSION_FILE_NAMES: dict[str, str] = {
    "dim_consultores.csv": "consultores",
    "dim_lojas.csv": "lojas",
    "dim_veiculos.csv": "veiculos",
}
SALES_FILE_NAME = r"^vendas_[0-9]{4}(_(0[1-9]|1[0-2]))?\.csv$"
DIMENSION_FOLDER = "dados/dimensoes"
SALES_FOLDER = "dados/vendas"
ARCHIVE_FOLDERS = ("dados", "dados/dimensoes", "dados/vendas")
README_NAME = "README.md"
PLACEHOLDER_NAME = ".gitkeep"

# --- Fixed values: admission limits --------------------------------------------------------------
MIB = 1024 * 1024
MAX_ENTRIES = 32
MAX_ARCHIVE_BYTES = 64 * MIB
MAX_FILE_BYTES = 32 * MIB
MAX_TOTAL_BYTES = 64 * MIB
MAX_COMPRESSION_RATIO = 200.0

# --- Fixed values: delimited text ----------------------------------------------------------------
DELIMITER = ";"
DELIMITER_CANDIDATES = (";", ",", "\t", "|")
UTF8_BOM_HEX = "EFBBBF"
REFUSED_BOM_HEX = ("FFFE0000", "0000FEFF", "FFFE", "FEFF")

# --- Fixed values: cleaning ----------------------------------------------------------------------
NULL_WORDS = ("", "na", "n/a", "null", "none", "nan", "-")
CURRENCY_SIGN = "R$"
PLACEHOLDER_AMOUNT = "9999999.00"

# --- Fixed values: quality rules, in report order ------------------------------------------------
# (rule_id, description, severity, dataset, condition, treatment, reason, invalidates_sale)
_KEEP_FIRST_REASON = (
    "A primeira ocorrência na ordem consolidada é canônica; as demais não entram na dimensão, "
    "evitando multiplicidade no relacionamento com vendas."
)
RULE_TEXTS: tuple[tuple[str, str, str, str, str, str, str, bool], ...] = (
    ("duplicate_consultor_id", "Identificador de consultor duplicado na dimensão.", "error", "consultores",
     "consultor_id aparece mais de uma vez; todas as ocorrências são contadas",
     "keep_first_source_occurrence", _KEEP_FIRST_REASON, False),
    ("duplicate_loja_id", "Identificador de loja duplicado na dimensão.", "error", "lojas",
     "loja_id aparece mais de uma vez; todas as ocorrências são contadas",
     "keep_first_source_occurrence", _KEEP_FIRST_REASON, False),
    ("duplicate_veiculo_id", "Identificador de veículo duplicado na dimensão.", "error", "veiculos",
     "veiculo_id aparece mais de uma vez; todas as ocorrências são contadas",
     "keep_first_source_occurrence", _KEEP_FIRST_REASON, False),
    ("missing_venda_id", "Venda sem identificador.", "error", "vendas",
     "venda_id está ausente", "reject_sale",
     "A venda não pode ser identificada de forma única.", True),
    ("duplicate_venda_id", "Identificador de venda repetido.", "error", "vendas",
     "venda_id repete uma ocorrência anterior na ordem consolidada",
     "keep_first_and_reject_later_source_occurrences",
     "A primeira ocorrência na ordem consolidada é canônica; ocorrências posteriores são rejeitadas "
     "para evitar contagem duplicada.", True),
    ("invalid_data_venda", "Data da venda ausente, inválida ou em formato não aceito.", "error", "vendas",
     "data_venda normalizada é nula", "reject_sale",
     "A data é necessária para análises temporais.", True),
    ("future_data_venda", "Data da venda posterior ao dia da execução.", "warning", "vendas",
     "data_venda é posterior à data atual", "retain_with_warning",
     "Pode representar dado antecipado ou erro de origem.", False),
    ("invalid_valor_venda", "Valor da venda ausente ou não monetário.", "error", "vendas",
     "valor_venda normalizado é nulo", "reject_sale",
     "O valor é necessário para as métricas financeiras.", True),
    ("negative_valor_venda", "Valor da venda negativo.", "error", "vendas",
     "valor_venda é menor que zero", "reject_sale",
     "Venda negativa exige tratamento de negócio não definido.", True),
    ("zero_valor_venda", "Valor da venda igual a zero.", "error", "vendas",
     "valor_venda é igual a zero", "reject_sale",
     "Uma venda sem valor não representa uma transação comercial válida.", True),
    ("suspicious_valor_venda_placeholder", "Valor da venda contém o placeholder 9.999.999 da fonte.",
     "error", "vendas", "valor_venda é exatamente igual a 9.999.999", "reject_sale",
     "O valor repetido é um extremo incompatível com as referências e com os demais valores "
     "comerciais deste dataset.", True),
    ("invalid_valor_referencia", "Valor de referência ausente ou não monetário.", "warning", "vendas",
     "valor_referencia normalizado é nulo", "retain_with_warning",
     "A venda é utilizável, mas o desconto não pode ser calculado.", False),
    ("missing_veiculo_id", "Venda sem identificador de veículo.", "error", "vendas",
     "veiculo_id está ausente", "reject_sale", "O veículo é obrigatório para compor a fato.", True),
    ("orphan_veiculo_id", "Veículo da venda não existe na dimensão.", "error", "vendas",
     "veiculo_id não está na dimensão de veículos", "reject_sale",
     "O relacionamento obrigatório com veículo falharia.", True),
    ("missing_loja_id", "Venda sem identificador de loja.", "error", "vendas",
     "loja_id está ausente", "reject_sale", "A loja é obrigatória para compor a fato.", True),
    ("orphan_loja_id", "Loja da venda não existe na dimensão.", "error", "vendas",
     "loja_id não está na dimensão de lojas", "reject_sale",
     "O relacionamento obrigatório com loja falharia.", True),
    ("missing_consultor_id", "Venda sem identificador de consultor.", "warning", "vendas",
     "consultor_id está ausente", "retain_with_warning",
     "A venda permanece útil sem atribuição ao consultor.", False),
    ("orphan_consultor_id", "Consultor da venda não existe na dimensão.", "warning", "vendas",
     "consultor_id não está na dimensão de consultores", "retain_with_warning",
     "A venda permanece útil, com atribuição não resolvida.", False),
    ("consultor_loja_mismatch", "Consultor pertence a loja diferente da venda.", "warning", "vendas",
     "loja da venda difere da loja do consultor", "retain_with_warning",
     "Pode ser uma venda cruzada legítima ou erro cadastral.", False),
    ("veiculo_multiple_sales", "Veículo está associado a múltiplas vendas.", "warning", "vendas",
     "veiculo_id aparece em mais de uma venda", "retain_with_warning",
     "A recorrência requer análise, mas não prova duplicidade.", False),
)

# --- Fixed values: display texts -----------------------------------------------------------------
RULE_LABELS: dict[str, str] = {
    "duplicate_consultor_id": "Consultor duplicado",
    "duplicate_loja_id": "Loja duplicada",
    "duplicate_veiculo_id": "Veículo duplicado",
    "missing_venda_id": "Identificador da venda ausente",
    "duplicate_venda_id": "Venda duplicada",
    "invalid_data_venda": "Data de venda inválida",
    "future_data_venda": "Data de venda futura",
    "invalid_valor_venda": "Valor de venda inválido",
    "negative_valor_venda": "Valor de venda negativo",
    "zero_valor_venda": "Valor de venda igual a zero",
    "suspicious_valor_venda_placeholder": "Valor de venda suspeito (9.999.999)",
    "invalid_valor_referencia": "Valor de referência inválido",
    "missing_veiculo_id": "Identificador do veículo ausente",
    "orphan_veiculo_id": "Veículo sem correspondência",
    "missing_loja_id": "Identificador da loja ausente",
    "orphan_loja_id": "Loja sem correspondência",
    "missing_consultor_id": "Identificador do consultor ausente",
    "orphan_consultor_id": "Consultor sem correspondência",
    "consultor_loja_mismatch": "Consultor vinculado a outra loja",
    "veiculo_multiple_sales": "Veículo associado a múltiplas vendas",
}
SEVERITY_LABELS = {"error": "Erro", "warning": "Aviso"}
STATUS_LABELS = {"passed": "Aprovada", "failed": "Falhou", "warning": "Aviso"}
NOT_INFORMED = "Não informado"
NO_ALERTS = "Sem alertas"
MISSING_TEXT = "—"
ZERO_PERCENT = "0,00%"
COMPACT_UNITS = ((1_000_000_000, "B"), (1_000_000, "M"), (1_000, "mil"))
TICK_MULTIPLIERS = (1.0, 2.0, 2.5, 5.0, 10.0)
TRACE_TITLES = {
    "venda_id": "Venda", "data_venda": "Data", "quality_issues": "Alertas de qualidade", "marca": "Marca",
    "modelo": "Modelo", "loja": "Loja", "uf": "UF", "consultor": "Consultor",
    "valor_venda": "Valor da venda", "valor_referencia": "Valor de referência",
    "desconto_percentual": "Desconto (%)", "__source_file": "Arquivo de origem",
    "__source_line": "Linha de origem",
}

# --- Fixed values: column lists of the published and explored tables ---------------------------------
EXPLORED_COLUMNS = (
    "venda_id", "data_venda", "valor_venda", "valor_referencia", "desconto_concedido",
    "desconto_percentual", "marca", "modelo", "loja", "uf", "canal_origem", "forma_pagamento",
    "consultor", "quality_issues", "__source_file", "__source_line",
)
SEARCHED_COLUMNS = ("venda_id", "consultor", "loja", "modelo", "marca", "__source_file")
EXPORTED_COLUMNS = (
    "venda_id", "data_venda", "marca", "modelo", "loja", "uf", "consultor", "canal_origem",
    "forma_pagamento", "valor_referencia", "valor_venda", "desconto_percentual", "quality_issues",
    "__source_file", "__source_line",
)
FILTER_ATTRIBUTES = ("marca", "loja", "uf", "canal_origem", "forma_pagamento", "consultor")
