"""Every query with SQL equals DuckDB on the given tables."""

import pytest

import __spark_entry__ as contract
from checks import oracle
from checks.compare import differences, duck
from tests.conftest import TINY


@pytest.fixture(scope="module")
def con():
    return duck(TINY)


@pytest.mark.parametrize("name", sorted(oracle.statements()))
def test_matches_sql(spark, con, name):
    assert differences(spark, con, TINY, name) is None


def test_every_statement_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_returns_the_flagship(spark):
    top = contract.entry(spark)
    assert top.columns == [
        "song", "artist", "play_count", "unique_listeners", "avg_duration_sec",
    ]
    assert top.count() == 10
