import pytest

import __spark_entry__ as contract
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = connect(SF)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, duck, name):
    df = contract.queries()[name](spark, SF)
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert df.columns
        df.collect()
    else:
        assert compare(df, sql, duck) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
