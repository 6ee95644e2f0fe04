"""Every query with a statement gives the same rows in both engines, on the smallest tables."""

import math
import os

import duckdb
import pytest

from terraloom.plans.oracle import oracle_sql
from terraloom.plans.queries import QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{DATA}/{f}')")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
    return "~" if v is None else str(v)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    names = sorted(df.columns)
    ours = sorted(tuple(map(plain, r)) for r in df.select(*(f"`{n}`" for n in names)).collect())
    found = duck.execute(oracle_sql()[name])
    at = [[c[0] for c in found.description].index(n) for n in names]
    assert ours == sorted(tuple(plain(r[i]) for i in at) for r in found.fetchall())


def test_every_statement_has_a_query():
    assert set(oracle_sql()) <= set(QUERIES)
