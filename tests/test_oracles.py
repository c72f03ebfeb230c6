"""Every core query with SQL gives DuckDB's rows on the smallest tables."""

import datetime
from collections import Counter
from pathlib import Path

import pytest

from paperloom.plans.catalogue import ORACLES, QUERIES

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables here")


def plain(v):
    if isinstance(v, float):
        return round(v, 9) if v == v else "nan"
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in FOLDER.glob("*.parquet"):
        con.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, str(FOLDER))
    columns = sorted(df.columns)
    mine = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    said = duck.sql(ORACLES[name])
    at = [said.columns.index(c) for c in columns]
    theirs = Counter(tuple(plain(r[k]) for k in at) for r in said.fetchall())
    assert sorted(said.columns) == columns
    assert mine == theirs


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, str(FOLDER)).columns
