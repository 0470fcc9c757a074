"""Every query of the library against its DuckDB SQL on the same tables."""

import datetime as dt
import math

import duckdb
import pytest

from lakepulse.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day).isoformat()
    return "None" if math.isnan(v) else f"{float(v) + 0.0:.9g}"


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_its_sql(spark, sf, duck, name):
    found = catalog.QUERIES[name](spark, sf)
    if name not in catalog.ORACLES:
        assert found.count() > 0
        return
    want = duck.execute(catalog.ORACLES[name])
    names = [c[0] for c in want.description]
    assert sorted(found.columns) == sorted(names)
    assert rows_of(found.columns, found.collect()) == rows_of(names, want.fetchall())
