"""The operators' queries against their SQL, on whole tables."""

import pytest

from compare import database, difference
from plateward.llm.oracle import oracle_sql
from plateward.llm.queries import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return database(FOLDER)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_equals_sql(spark, connection, name):
    assert difference(queries()[name](spark, FOLDER), connection, oracle_sql()[name]) is None


def test_one_query_per_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries() if name.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in queries()
