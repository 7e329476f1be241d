"""Every registered query against its SQL."""

import datetime
import math

import duckdb
import pytest

from auditloom.plans import registry

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5) + 0.0
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query(spark, sf_dir, name):
    df = registry.QUERIES[name](spark, sf_dir)
    got = df.collect()
    assert all(got_type != "void" for _, got_type in df.dtypes)
    assert got  # equal, but empty, shows nothing
    if name not in registry.SQL:
        return
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    want = con.sql(registry.SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    key = lambda row: tuple(map(str, row))
    left = sorted((tuple(plain(r[c]) for c in sorted(df.columns)) for r in got), key=key)
    at = [want.columns.index(c) for c in sorted(df.columns)]
    right = sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=key)
    assert left == right
