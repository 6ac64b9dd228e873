"""Every query of the catalog against its SQL over the smallest tables."""

import os

import pytest

from quarrylight.plans import catalog

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(TESTDATA):
        pytest.skip("no test tables")
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for f in os.listdir(TESTDATA):
        path = f"{TESTDATA}/{f}"
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def plain(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    return str(v) if hasattr(v, "isoformat") else v


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    df = catalog.queries()[name](spark, TESTDATA)
    columns = sorted(df.columns)
    got = sorted(repr([plain(v) for v in r]) for r in df.select(*columns).collect())
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        assert len(got) > 0
        return
    want = duck.sql(f"SELECT {', '.join(f'\"{c}\"' for c in columns)} FROM ({sql})").fetchall()
    assert got == sorted(repr([plain(v) for v in r]) for r in want)
