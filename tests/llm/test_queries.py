import glob
import os

import duckdb
import pytest

from sedimenta.llm import queries as Q
from tests.test_queries import canon

ALL, SQL = Q.queries(), Q.oracle_sql()
COLUMNS = {"p1_found": ["row_id_a", "row_id_b"], "p2_found": ["origin", "record_id", "line_no"], "p3_found": ["app_id_a", "app_id_b"], "p4_found": ["member_id_a", "member_id_b"], "p5_found": ["doc_id", "item_id"], "p7_found": ["doc_id"]}


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, sf, name):
    con = duckdb.connect()
    for p in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    df = ALL[name](spark, sf)
    done = con.execute(SQL[name])
    cols = [d[0] for d in done.description]
    assert sorted(cols) == sorted(df.columns)
    assert canon([tuple(r) for r in df.collect()], df.columns) == canon(done.fetchall(), cols)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_distinct_rows(spark, sf, name):
    df = ALL[name](spark, sf)
    assert df.columns == COLUMNS[name]
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(set(got))


@pytest.fixture(scope="module")
def empty(spark, sf, tmp_path_factory):
    out = tmp_path_factory.mktemp("empty")
    for p in glob.glob(f"{sf}/*.parquet"):
        spark.read.parquet(p).limit(0).write.parquet(str(out / os.path.basename(p)))
    return str(out)


@pytest.mark.parametrize("name", sorted(ALL))
def test_empty_tables(spark, empty, name):
    ALL[name](spark, empty).collect()
