"""Queries against their SQL on the smallest data set; CHECK_ALL=1 runs every one of them."""

import os

import pytest

import __spark_entry__ as contract
import check

SF_DIR = "/root/testdata/sf0.001"
QUICK = (
    "scan_csv_typed", "upsert_merge", "clean_clientes_py", "clean_clientes_sql", "scalar_functions", "abt_py", "abt_sql", "insight_a",
    "insight_d", "insight_e", "ntile_scaled", "perfil_cliente", "stratified_split", "kb_loan_cards", "kb_summary_doc", "retrieve_context",
)
NAMES = list(contract.oracle_sql()) if os.environ.get("CHECK_ALL") else QUICK


@pytest.fixture(scope="module")
def con():
    return check.connect(SF_DIR)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, con, name):
    assert check.differences(name, contract.queries()[name](spark, SF_DIR), con) == []


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
