"""Every query with SQL against DuckDB on the same tables."""
import decimal
import glob
import math
import os

import pytest

import dumpmill.queries_ingest  # noqa: F401
from dumpmill.registry import ORACLES, QUERIES


def norm(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def compare(df, con, sql):
    got = sorted((tuple(norm(r[c]) for c in sorted(df.columns)) for r in df.collect()), key=repr)
    rel = con.sql(sql)
    order = [rel.columns.index(c) for c in sorted(rel.columns)]
    want = sorted((tuple(norm(r[i]) for i in order) for r in rel.fetchall()), key=repr)
    assert sorted(df.columns) == sorted(rel.columns)
    assert got == want


@pytest.fixture(scope="session")
def con(sf_dir):
    import duckdb

    own = duckdb.connect()
    own.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        own.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return own


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    compare(df, con, ORACLES[name])
    assert con.sql(f"SELECT count(*) FROM ({ORACLES[name]})").fetchall()[0][0] > 0
