"""Every registered query against its DuckDB SQL on the sf0.001 tables."""

import pytest

import __spark_entry__ as E
from oracle_compare import compare, duck
from tillroll.plans.registry import QUERIES as CORE

SF = "/root/testdata/sf0.001"
SQL = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(CORE))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, name, QUERIES[name], SQL.get(name), SF, con)
    assert res["status"] in ("match", "rows-only"), res


def test_every_core_query_has_sql():
    assert sorted(set(CORE) - set(SQL)) == []


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["Year", "Month", "Revenue", "Date"]
