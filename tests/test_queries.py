"""Every registered query against its check SQL on the smallest tables."""

import duckdb
import pytest
from conftest import SF

import __spark_entry__ as entry
from check_queries import as_rows

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    from pathlib import Path

    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for f in Path(SF).glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = as_rows(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        assert got
        return
    res = duck.execute(ORACLES[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert got == as_rows(cols, res.fetchall())


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_every_check_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
