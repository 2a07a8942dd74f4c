"""The queries that have SQL against it, over whole tables."""

import glob
import os

import pytest

from parlance.llm import queries

duckdb = pytest.importorskip("duckdb")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    got = con.execute(queries.oracle_sql()[name])
    names = [c[0] for c in got.description]
    df = queries.queries()[name](spark, sf_dir)
    assert sorted(names) == sorted(df.columns)
    assert sorted(repr(tuple(r)) for r in df.select(*names).collect()) == sorted(map(repr, got.fetchall()))
