"""The queries that SQL can express, against DuckDB on the same files."""

from __future__ import annotations

import pytest
from cases import SMALL, oracle

from roadstream.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_query_matches_sql(spark, name):
    result = QUERIES[name](spark, SMALL)
    expected = oracle().execute(ORACLE_SQL[name])
    columns = [c[0] for c in expected.description]
    assert sorted(columns) == sorted(result.columns)
    rows = sorted((tuple(r[c] for c in columns) for r in result.collect()), key=repr)
    assert rows == sorted(expected.fetchall(), key=repr)
