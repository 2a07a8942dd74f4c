"""Every query against its SQL, and the schema of those without."""

import glob
import os

import pytest

duckdb = pytest.importorskip("duckdb")

from parlance.oracle import oracle_sql  # noqa: E402
import parlance.queries_blocks  # noqa: E402, F401 - registers its queries
from parlance.queries import QUERIES  # noqa: E402

SQL = oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return c


def rows(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(r[i] for i in order)) for r in found)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    got = con.execute(SQL[name])
    names = [c[0] for c in got.description]
    assert sorted(names) == sorted(df.columns)
    assert rows(df.columns, df.collect()) == rows(names, got.fetchall())


def test_all_queries_are_known():
    assert set(SQL) <= set(QUERIES) and len(SQL) > 80
