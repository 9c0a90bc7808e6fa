import os
import sys
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from tallysieve.session import tune

    yield tune(session)
    session.stop()


SALE = {
    "venda_id": "S1", "data_venda": "2025-01-15", "veiculo_id": "V1", "loja_id": "L1", "consultor_id": "C1",
    "canal_origem": "Loja", "forma_pagamento": "À vista", "valor_referencia": "100.00", "valor_venda": "90.00",
}
STORES = [("L1", "Centro", "Manaus", "AM", "A"), ("L2", "Norte", "Manaus", "AM", "B")]
PEOPLE = [("C1", "Ana", "L1", "A", "2020-01-01"), ("C2", "Bruno", "L2", "B", "2021-02-02")]
CARS = [
    (f"V{i}", "2024", "Marca", f"Modelo V{i}", "Base", "SUV", "Auto", "Flex", "Novo", "0", "Preto", "Preto", "9.5")
    for i in range(1, 5)
]


@pytest.fixture(scope="session")
def make_tables(spark):
    """Four raw tables; rows are tuples in contract order, sales are changes to the default sale."""
    from tallysieve.contracts import CONTRACTS

    def frame(name, rows, source):
        numbered = [(*row, source, i) for i, row in enumerate(rows, 2)]
        return spark.createDataFrame(numbered, CONTRACTS[name].raw_schema)

    def make(*changes, stores=STORES, people=PEOPLE, cars=CARS):
        sales = [tuple({**SALE, **c}[k] for k in CONTRACTS["vendas"].columns) for c in changes or ({},)]
        return {
            "vendas": frame("vendas", sales, "vendas_2025.csv"),
            "lojas": frame("lojas", stores, "dim_lojas.csv"),
            "consultores": frame("consultores", people, "dim_consultores.csv"),
            "veiculos": frame("veiculos", cars, "dim_veiculos.csv"),
        }

    return make


@pytest.fixture(scope="session")
def run_rules(make_tables):
    from pyspark.sql import functions as F

    from tallysieve.plans.evaluate import evaluate
    from tallysieve.plans.normalise import normalise_all

    def run(*changes, split=False, **dims):
        tables = normalise_all(make_tables(*changes, **dims))
        return evaluate(tables, F.lit("2026-01-01").cast("date"), split_hot_keys=split)

    return run


EXPLORED = [
    ("S1", "2025-01-10", "90", "100", "TOYOTA", "Modelo 1", "Centro", "AM", "Loja", "À vista", "Ana", "", 2),
    ("S2", "2025-01-20", "110", "100", "TOYOTA", "Modelo 2", "Norte", "AM", "Site", "Pix", "Bruno", "orphan_consultor_id", 3),
    ("S3", "2025-02-15", "200", "200", "HONDA", "Modelo 3", "Centro", "SP", "Marketplace", "Financiamento", "Carla", "", 4),
    ("S4", "2025-03-05", "300", "300", "FORD", "Modelo 4", "Sul", "RJ", "Telefone", "Cartão", "Diego", "veiculo_multiple_sales", 5),
    ("S5", "2025-03-20", "150", "150", "NISSAN", "Modelo 5", "Manaus", "AM", None, None, None, "", 6),
]


@pytest.fixture(scope="session")
def sales(spark):
    from tallysieve.operators import explore
    from tallysieve.operators.metrics import with_metrics

    rows = [
        (r[0], date.fromisoformat(r[1]), Decimal(r[2]), Decimal(r[3]), *r[4:12], "vendas_2025.csv", r[12]) for r in EXPLORED
    ]
    schema = (
        "venda_id string, data_venda date, valor_venda decimal(18,2), valor_referencia decimal(18,2), marca string, "
        "modelo string, loja string, uf string, canal_origem string, forma_pagamento string, consultor string, "
        "quality_issues string, __source_file string, __source_line bigint"
    )
    return explore.explored(with_metrics(spark.createDataFrame(rows, schema))).cache()
