from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallysieve.functions import dates, numbers, ptbr, text


def column(spark, values, make, kind="string"):
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(make(F.col("v"))).collect()]


def test_clean_text_strips_unicode_space_and_null_words(spark):
    values = [" N/A ", "null", "-", "", "\u3000a b\x1f\t", "\xa0Nan", "nullx", "a\nb\n", "--", None]
    assert column(spark, values, text.clean_text) == [None, None, None, None, "a b", None, "nullx", "a\nb", "--", None]
    assert column(spark, [" ab ", "none"], text.clean_id) == ["AB", None]


def test_labels(spark):
    assert column(spark, ["e-commerce", "LOJA física"], text.title_label) == ["E-Commerce", "Loja Física"]
    assert column(spark, [" PIX", "À VISTA"], text.sentence_label) == ["Pix", "À vista"]
    assert column(spark, ["custom_unmapped_rule", "orphan_loja_id"], text.rule_label) == [
        "Custom Unmapped Rule", "Loja sem correspondência",
    ]


def test_dates(spark):
    good = ["2025-01-31", "2025/01/31", "31/01/2025", " 31/1/2025\xa0"]
    assert column(spark, good, dates.parse_date) == [date(2025, 1, 31)] * 4
    bad = ["2025-02-30", "2025-001-05", "2025-01-31 10:00", "2025", "2025-01/31", "n/a", None]
    assert column(spark, bad, dates.parse_date) == [None] * 7


MONEY = {
    "10": "10.00", "10,50": "10.50", "10.555": None, "x": None, "R$ 100,10": "100.10", "1.234": None,
    "1.230": "1.23", "1.234,50": "1234.50", "1,234.56": None, "1.234.567": None, "1e5": "100000.00", "R$": None,
    "10.500": "10.50", ".5": "0.50", " NaN ": None, "1_000": "1000.00", "1E-3": None, "100e-2": "1.00", "-5": "-5.00",
    "+3": "3.00", "1.": "1.00", "12345678901234567": None, "0e99": "0.00", "inf": None, "R$\xa01.280.000,00": "1280000.00",
    "١٢٣,5": "123.50",
}


def test_money_is_exact_or_null(spark):
    got = column(spark, list(MONEY), numbers.parse_money)
    assert got == [None if v is None else Decimal(v) for v in MONEY.values()]


def test_money_of_any_length(spark):
    values = {
        "10000000000000000000e-5": "100000000000000.00", "1e003": "1000.00", "1.50000000000000000000e0": "1.50",
        "0" * 45 + "e1": "0.00", "1," + "0" * 70 + ".0": "1.00", "12e-10": None, "1.0000000000000000000001e0": None,
        "1e": None, "e5": None, ".e5": None, "5e-02": "0.05", "-.5E+1": "-5.00", "0e99999999999999": "0.00", "1e99999999999999": None,
        "1e16": None, "1e15": "1000000000000000.00",
    }
    got = column(spark, list(values), numbers.parse_money)
    assert got == [None if v is None else Decimal(v) for v in values.values()]


def test_numbers(spark):
    values = ["1e3", "1.", "-.5", "+3", "1_000", "0x10", "1d", "5f", "12.345,6", "nan", "inf"]
    expected = [1000.0, 1.0, -0.5, 3.0, None, None, None, None, 12345.6, None, float("inf")]
    assert column(spark, values, numbers.parse_number) == expected


@pytest.mark.parametrize(
    ("make", "values", "expected"),
    [
        (ptbr.compact_currency, [32547527600.0, 751462600.0, 282724.5, 850.0, -1250000.0],
         ["R$ 32,5 B", "R$ 751,5 M", "R$ 282,7 mil", "R$ 850,00", "R$ -1,2 M"]),
        (ptbr.compact_number, [115121.0, 1500000.0, 2500000000.0, 942.0, -1500.0],
         ["115,1 mil", "1,5 M", "2,5 B", "942", "-1,5 mil"]),
        (ptbr.currency, [1280000.0, None, float("nan"), float("inf")], ["R$ 1.280.000,00", "—", "—", "—"]),
        (ptbr.percent_text, [1.54], ["1,54%"]),
        (ptbr.integer_text, [115879.9, -0.5], ["115.879", "0"]),
    ],
)
def test_display_texts(spark, make, values, expected):
    assert column(spark, values, make, "double") == expected


def test_ratio_text(spark):
    rows = spark.createDataFrame([(5.0, 6.0), (0.0, 0.0), (1.0, None)], "a double, b double")
    assert [r[0] for r in rows.select(ptbr.ratio_text(F.col("a"), F.col("b"))).collect()] == ["83,33%", "0,00%", "0,00%"]
