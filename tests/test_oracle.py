"""Every registered query against its reference SQL on the small tables."""

import pytest

import __spark_entry__ as contract
from verification import oracle, spark_queries
from verification.compare import connect, difference

SMALL = "/root/testdata/sf0.001"
QUERIES, SQL = spark_queries.registered(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.fixture(autouse=True, scope="module")
def compiled(spark):
    """Run the queries as a cluster would, with generated code."""
    keys = ("spark.sql.codegen.wholeStage", "spark.sql.codegen.factoryMode")
    for key, value in zip(keys, ("true", "FALLBACK")):
        spark.conf.set(key, value)
    yield
    for key, value in zip(keys, ("false", "NO_CODEGEN")):
        spark.conf.set(key, value)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL) and set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_result(spark, duck, name):
    mine = QUERIES[name](spark, SMALL).toArrow()
    assert difference(mine, duck.sql(SQL[name]).to_arrow_table()) is None
