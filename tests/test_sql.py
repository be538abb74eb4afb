"""Every core query against its SQL on the smallest tables, row by row."""

import math
import os

import pytest

from tallyforge.plans import catalog

DATA = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables here")


def plain(v):
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if type(v).__name__ == "Decimal":
        return round(float(v), 6)
    return float(v) if isinstance(v, int) and not isinstance(v, bool) else v if v is None or isinstance(v, bool) else str(v)


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW \"{f[:-8]}\" AS SELECT * FROM read_parquet('{DATA}/{f}')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, tables, name):
    df = catalog.queries()[name](spark, DATA)
    got = [plain(tuple(r)) for r in df.collect()]
    sql = catalog.oracle_sql().get(name)
    if sql:
        c = tables.execute(sql)
        names = [x[0] for x in c.description]
        want = [plain(r) for r in c.fetchall()]
        assert sorted(df.columns) == sorted(names)
        order = lambda rows, cols: sorted((tuple(r[cols.index(k)] for k in sorted(cols)) for r in rows), key=str)
        assert order(got, df.columns) == order(want, names)
