"""Every query of the engine against its SQL on the smallest tables."""

import datetime
import decimal
from pathlib import Path

import duckdb
import pytest

from termloom.plans import registry

DATA = Path("/root/testdata/sf0.001")


def plain(v):
    if isinstance(v, (datetime.date, datetime.datetime)):
        return str(v)[:10]
    if isinstance(v, (float, decimal.Decimal)):
        return f"{float(v):.6f}"
    return str(v)


@pytest.mark.skipif(not DATA.exists(), reason="the test tables aren't here")
@pytest.mark.parametrize("name", list(registry.queries()))
def test_query(spark, name):
    df = registry.queries()[name](spark, str(DATA))
    rows = df.collect()
    if sql := registry.oracle_sql().get(name):
        c = duckdb.connect()
        for p in DATA.glob("*.parquet"):
            c.execute(f"create view {p.stem} as select * from '{p}'")
        q = c.execute(sql)
        names = [d[0] for d in q.description]
        want = sorted(tuple(plain(dict(zip(names, r))[n]) for n in df.columns) for r in q.fetchall())
        assert sorted(names) == sorted(df.columns)
        assert sorted(tuple(plain(v) for v in r) for r in rows) == want
