from datetime import date

import pytest
from pyspark.sql import functions as F

from tallysieve.operators import explore


def ids(df):
    return [r["venda_id"] for r in df.collect()]


def test_kpis(sales):
    row = explore.kpi_texts(explore.kpis(sales)).collect()[0]
    assert tuple(row) == ("R$ 850,00", "5", "R$ 170,00", "R$ 10,00")


@pytest.mark.parametrize(
    ("query", "expected"),
    [("s2", {"S2"}), ("bRuNo", {"S2"}), (" centro ", {"S1", "S3"}), ("modelo 4", {"S4"}), ("nada", set()), ("", {"S1", "S2", "S3", "S4", "S5"})],
)
def test_search(sales, query, expected):
    assert set(ids(explore.search(sales, query))) == expected


def test_alerts(sales):
    assert set(ids(explore.with_alerts(sales, True))) == {"S2", "S4"}
    assert set(ids(explore.with_alerts(sales, False))) == {"S1", "S3", "S5"}
    assert tuple(explore.trace_counts(sales).collect()[0]) == (5, 2)


@pytest.mark.parametrize(
    ("order", "expected"),
    [("newest", "S5 S4 S3 S2 S1"), ("oldest", "S1 S2 S3 S4 S5"), ("highest", "S4 S3 S5 S2 S1"), ("lowest", "S1 S2 S5 S3 S4")],
)
def test_sorts(sales, order, expected):
    assert ids(explore.sort_sales(sales, order)) == expected.split()


@pytest.mark.parametrize(
    ("picked", "expected"),
    [
        ({"canal_origem": ("Site",)}, {"S2"}),
        ({"forma_pagamento": ("Financiamento",)}, {"S3"}),
        ({"consultor": ("Diego",)}, {"S4"}),
        ({"marca": ("TOYOTA",)}, {"S1", "S2"}),
        ({"marca": ("TOYOTA",), "loja": ("Centro",), "uf": ("AM",)}, {"S1"}),
        ({"marca": ("TOYOTA",), "canal_origem": ("Site",), "consultor": ("Ana",)}, set()),
        ({"start": date(2025, 1, 20), "end": date(2025, 3, 5)}, {"S2", "S3", "S4"}),
        ({}, {"S1", "S2", "S3", "S4", "S5"}),
    ],
)
def test_selection(sales, picked, expected):
    selection = explore.Selection(**picked)
    assert set(ids(explore.apply_selection(sales, selection))) == expected
    assert selection.active is bool(picked)
    assert not selection.cleared().active


def test_options_and_period(sales):
    counts = {r[0]: r[1] for r in explore.filter_options(sales).groupBy("atributo").count().collect()}
    assert counts == {"marca": 4, "loja": 4, "uf": 3, "canal_origem": 4, "forma_pagamento": 4, "consultor": 4}
    assert tuple(map(str, explore.period(sales).collect()[0])) == ("2025-01-10", "2025-03-20")


def test_shares_keep_missing_channel(sales):
    rows = {r["canal"]: (r["vendas"], r["percentual"]) for r in explore.by_channel(sales).collect()}
    assert rows["Não informado"] == (1, "20,00%")
    assert len(rows) == 5


REPORT = [
    ("duplicate_venda_id", "error", 2, "failed"), ("future_data_venda", "warning", 1, "warning"),
    ("invalid_data_venda", "error", 0, "passed"), ("missing_venda_id", "error", 0, "passed"),
    ("custom_unmapped_rule", "warning", 0, "passed"),
]


def test_quality_board(spark):
    report = spark.createDataFrame(REPORT, "check string, severity string, failed_rows bigint, status string")
    assert tuple(explore.rule_counts(report).collect()[0]) == (5, 3, 1, 1)
    board = explore.quality_board(report)
    assert {r[0] for r in explore.filter_board(board, "Aviso").collect()} == {"Data de venda futura", "Custom Unmapped Rule"}
    assert {r[0] for r in explore.filter_board(board, status="Falhou").collect()} == {"Venda duplicada"}
    assert explore.filter_board(board, "Erro", "Aviso").isEmpty()
    assert [r[0] for r in board.collect()][:2] == ["Venda duplicada", "Data de venda futura"]
    assert explore.affected_rules(board).count() == 2


def test_volumes(spark):
    n = lambda k: spark.range(k)
    assert explore.volumes(n(6), n(5), n(1)).collect()[0]["taxa_aprovacao"] == "83,33%"
    assert explore.volumes(n(0), n(0), n(0)).collect()[0]["taxa_aprovacao"] == "0,00%"


def test_ticks(spark):
    df = spark.createDataFrame([(250000.0,), (1252000.0,)], "v double")
    ticks = [r["valor"] for r in explore.axis_ticks(df, "v").orderBy("posicao").collect()]
    assert ticks[0] == 0 and ticks[-1] >= 1252000 and len(ticks) <= 6
    assert [r["valor"] for r in explore.axis_ticks(df.where("v < 0"), "v").collect()] == [0.0]


def test_presented_keeps_sources(sales):
    rows = {r["Venda"]: r for r in explore.presented(sales).collect()}
    assert rows["S1"]["Alertas de qualidade"] == "Sem alertas"
    assert rows["S1"]["Valor da venda"] == "R$ 90,00"
    assert rows["S1"]["Desconto (%)"] == "10,00%"
    assert sales.agg(F.sum("valor_venda")).collect()[0][0] == 850


def test_order_proof_sees_every_swapped_pair(spark, tmp_path):
    from tallysieve.operators.order import order_breaks

    rows = [(None if k % 17 == 16 else k // 3, f"t{k % 3}") for k in range(60)]
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    order = [(F.col("n"), False), (F.col("t"), True)]

    def breaks(listed, name, parts):
        for k in range(parts):  # part files in turn
            part = listed[k * len(listed) // parts : (k + 1) * len(listed) // parts]
            folder = tmp_path / f"{name}-{k}"
            spark.createDataFrame(part, "n int, t string").coalesce(1).write.parquet(str(folder))
            (tmp_path / name).mkdir(exist_ok=True)
            next(folder.glob("part-*.parquet")).rename(tmp_path / name / f"part-{k:03d}.parquet")
        return order_breaks(spark.read.parquet(str(tmp_path / name)), order).collect()[0]

    found = breaks(rows, "sorted", 4)
    assert (found["parts"], found["rows"], found["breaks"]) == (4, 60, 0)
    for k in (5, 14, 58):  # within a part, at a border, among NULLs
        swapped = [*rows[:k], rows[k + 1], rows[k], *rows[k + 2 :]]
        assert breaks(swapped, f"swap{k}", 4)["breaks"] >= 1
    assert breaks(rows[30:] + rows[:30], "turned", 2)["borders"] == 1
    assert order_breaks(spark.read.schema("n int, t string").parquet(str(tmp_path / "sorted")).where("n < 0"), order).collect()[0]["breaks"] == 0
