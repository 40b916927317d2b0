"""Every registered query against its SQL, on whole tables."""

import pytest

import __spark_entry__ as registry
from compare import database, difference

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = registry.library_queries(), registry.oracle.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return database(FOLDER)


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)
    trained = {"gbt_scores", "gbt_importances", "gbt_cross_validation", "boosted_scores", "boosted_importances"}
    assert set(QUERIES) - set(SQL) == trained


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, connection, name):
    assert difference(QUERIES[name](spark, FOLDER), connection, SQL[name]) is None


def test_entry(spark):
    df = registry.entry(spark)
    assert len(df.columns) == 33 and df.count() > 0
