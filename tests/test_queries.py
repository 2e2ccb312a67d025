"""Every query with SQL gives DuckDB's rows on the driver tables."""

import math

import duckdb
import pandas as pd
import pytest

from mosaica.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events".split()


def rows(df):
    def plain(v):
        if v is None or v is pd.NA or v != v:
            return None
        if isinstance(v, bool):
            return str(v)
        try:
            return round(float(v), 5) + 0.0
        except (TypeError, ValueError):
            return str(v)

    df = df[sorted(df.columns)].astype(object)
    return sorted((tuple(plain(v) for v in r) for r in df.itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, sf, name):
    got = catalog.QUERIES[name](spark, sf)
    if name not in catalog.ORACLE:
        got.collect()
        return
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    a, b = got.toPandas(), con.sql(catalog.ORACLE[name]).df()
    assert sorted(a.columns) == sorted(b.columns)
    a, b = rows(a), rows(b)
    assert len(a) == len(b)
    for x, y in zip(a, b):
        for u, v in zip(x, y):
            assert u == v or (isinstance(u, float) and isinstance(v, float) and math.isclose(u, v, rel_tol=1e-5, abs_tol=2e-5)), (x, y)
