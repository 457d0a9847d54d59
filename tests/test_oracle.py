import pytest
from compare import connect, mismatch

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    assert mismatch(spark, con, name, contract.queries()[name], contract.oracle_sql()[name], SF) is None


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
