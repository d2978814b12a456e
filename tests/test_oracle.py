"""Every registered query against its SQL oracle (DuckDB) on sf0.01."""

import pytest

from ledgerlens.plans.catalog import QUERIES
from tests.compare import compare, duck

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    build, sql = QUERIES[name]
    ok, msg = compare(build(spark, SF), con, sql)
    assert ok, msg


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns[:2] == ["report_name", "moment"]
    assert set(E.oracle_sql()) <= set(E.queries())
