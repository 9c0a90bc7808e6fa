"""A sample of the registered queries against their oracle SQL on the smallest test tables."""

import os

import pytest

from compare import compare, oracle_connection

SF = "/root/testdata/sf0.001"
SAMPLE = (
    "c06_parse_money", "c06_long_amounts", "b02_quarantine_csv", "c07_normalise_veiculos", "c12_issue_list", "d02_quarantine", "e03_join_consultant",
    "f01_monthly_mart", "f13_quality_report", "g02_mark_later", "r20_veiculo_multiple_sales", "a05_expand_archive",
)

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, oracle, name):
    from __spark_entry__ import oracle_sql, queries

    assert compare(queries()[name](spark, SF), oracle, oracle_sql()[name]) == ""


def test_every_query_has_an_oracle():
    from tallysieve.querybook import all_oracles, all_queries

    assert set(all_queries()) == set(all_oracles())
    assert len(all_queries()) > 100
