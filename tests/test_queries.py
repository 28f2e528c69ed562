"""Every core query against its SQL on the smallest tables; the queries without SQL must run."""

import math
from pathlib import Path

import pytest

from corpusmill.plans import queries as core

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for p in DATA.iterdir():
        c.sql(f"create view {p.stem} as select * from '{p}'")
    return c


def value(v):
    return "nan" if isinstance(v, float) and math.isnan(v) else v if v is None or isinstance(v, float) else str(v)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(value(r[i]) for i in order) for r in data], key=str)


@pytest.mark.parametrize("name", sorted(core.SQL))
def test_query_equals_its_sql(spark, duck, name):
    df = core.QUERIES[name](spark, str(DATA))
    rel = duck.sql(core.SQL[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows(df.columns, df.collect()) == rows(rel.columns, rel.fetchall())


@pytest.mark.parametrize("name", sorted(set(core.QUERIES) - set(core.SQL)))
def test_query_without_sql_gives_rows(spark, name):
    got = core.QUERIES[name](spark, str(DATA))
    assert len(got.columns) > 1 and not got.isEmpty()


def test_every_sql_has_its_query():
    assert set(core.SQL) <= set(core.QUERIES)
