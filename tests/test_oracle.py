"""Every registered query against its SQL on the test tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from verdance.catalog.oracle import ORACLE
from verdance.catalog.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(v):
    if hasattr(v, "isoformat"):
        return v.replace(tzinfo=None).isoformat()
    return repr(v)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    cur = duck.execute(ORACLE[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == sorted(tuple(plain(r[i]) for i in order) for r in cur.fetchall())


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns[:2] == ["greenhouse", "win_start"]
    assert df.limit(1).count() == 1
