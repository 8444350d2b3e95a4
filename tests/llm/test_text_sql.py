"""Registered text queries against their SQL."""

import pytest

from checks.compare import canonical, duck
from playlake.llm import queries
from tests.conftest import SMALL


@pytest.mark.parametrize("name", sorted(queries.statements()))
def test_query_matches_its_sql(spark, name):
    mine = queries.registered()[name](spark, SMALL)
    theirs = duck(SMALL).execute(queries.statements()[name])
    columns = [column[0] for column in theirs.description]
    assert sorted(mine.columns) == sorted(columns)
    assert canonical(mine.columns, mine.collect()) == canonical(columns, theirs.fetchall())
