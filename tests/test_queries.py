"""Every core query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from rollbook.plans import catalog


def canonical(rows):
    return sorted(repr(tuple("" if v is None else f"{v:.9g}" if isinstance(v, float) else v for v in r)) for r in rows)


@pytest.fixture(scope="module")
def db(small):
    con = duckdb.connect()
    for f in os.listdir(small):
        con.execute(f"create view {f[:-8]} as select * from read_parquet('{small}/{f}')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, small, db, name):
    df = catalog.QUERIES[name](spark, small)
    columns = sorted(df.columns)
    rows = [tuple(r[c] for c in columns) for r in df.collect()]
    if name in catalog.SQL:
        out = db.execute(catalog.SQL[name])
        names = [d[0] for d in out.description]
        assert sorted(names) == columns
        assert canonical(rows) == canonical([tuple(r[names.index(c)] for c in columns) for r in out.fetchall()])
