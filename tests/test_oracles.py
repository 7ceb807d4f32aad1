"""Every registered query against its SQL counterpart on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def shown(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, int) and not isinstance(v, bool):
        return f"{float(v):.9g}" if abs(v) < 10**9 else str(v)
    return str(v)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, sf_dir, duck, name):
    df = entry.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted(tuple(shown(r[c]) for c in columns) for r in df.collect())
    assert got
    if name not in SQL:
        return
    result = duck.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert columns == sorted(names)
    assert got == sorted(tuple(shown(r[names.index(c)]) for c in columns) for r in result.fetchall())


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(entry.queries())
