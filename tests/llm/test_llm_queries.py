"""The queries with SQL against it on the smallest tables."""

import pytest

from corpusmill.llm import queries as llm
from tests.test_queries import DATA, duck, rows  # noqa: F401

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables here")


@pytest.mark.parametrize("name", sorted(llm.SQL))
def test_query_equals_its_sql(spark, duck, name):  # noqa: F811
    df = llm.QUERIES[name](spark, str(DATA))
    rel = duck.sql(llm.SQL[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows(df.columns, df.collect()) == rows(rel.columns, rel.fetchall())
