"""Every registered query against its SQL on the smallest test folder."""

import pytest

import __spark_entry__ as contract
from compare import differences, open_oracle
from conftest import SF_DIR
from doselake import oracle, registry

ORACLE = contract.oracle_sql()
QUERIES = contract.queries()


@pytest.fixture(scope="module")
def con():
    return open_oracle(SF_DIR)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLE])
def test_matches_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLE])
def test_rows_only(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_every_statement_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["uf", "taxa_cobertura"]
    assert df.count() > 20


def test_every_query_of_the_library_has_sql():
    assert set(registry.queries()) == set(oracle.statements())
