"""Every core query with SQL against that SQL; every other one runs and has rows; all survive odd and empty tables."""

import glob
import os

import duckdb
import pytest

from sedimenta.plans import catalogue

QUERIES = catalogue.queries()
SQL = catalogue.oracle_sql()


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    value = lambda v: round(v, 6) if isinstance(v, float) else v
    return sorted(repr(tuple(value(r[i]) for i in order)) for r in rows)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for p in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    done = duck.execute(SQL[name])
    cols = [d[0] for d in done.description]
    assert sorted(cols) == sorted(df.columns)
    assert canon([tuple(r) for r in df.collect()], df.columns) == canon(done.fetchall(), cols)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_has_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


@pytest.fixture(scope="module")
def empty(spark, sf, tmp_path_factory):
    out = tmp_path_factory.mktemp("empty")
    for p in glob.glob(f"{sf}/*.parquet"):
        spark.read.parquet(p).limit(0).write.parquet(str(out / os.path.basename(p)))
    return str(out)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty, name):
    QUERIES[name](spark, empty).collect()
