"""Every query with SQL gives the rows that DuckDB gives on the smallest tables; the others run."""

import decimal
import os

import pytest

import __spark_entry__ as entry

CORE = [m for m in entry._modules() if not m.__name__.startswith("stratalog.llm")]
QUERIES = {k: f for m in CORE for k, f in m.QUERIES.items()}
SQL = {k: s for m in CORE for k, s in m.SQL.items()}


def canon(v):
    if v is None:
        return "~"
    if isinstance(v, (float, decimal.Decimal)):
        return repr(round(float(v), 6))
    return str(v)


@pytest.fixture(scope="module")
def duck(data):
    import duckdb

    c = duckdb.connect()
    for f in os.listdir(data):
        at = f"{data}/{f}/*.parquet" if os.path.isdir(f"{data}/{f}") else f"{data}/{f}"
        c.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{at}'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, data, duck):
    df = QUERIES[name](spark, data)
    cols = sorted(df.columns)
    got = sorted(tuple(canon(r[c]) for c in cols) for r in df.collect())
    if name in SQL:
        r = duck.sql(SQL[name])
        assert sorted(r.columns) == cols
        at = [r.columns.index(c) for c in cols]
        assert got == sorted(tuple(canon(x[i]) for i in at) for x in r.fetchall())


def test_names_agree():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark, data):
    assert entry.entry(spark).columns
