"""Every registered query with a SQL twin equals DuckDB on the sf0.001 tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from credere.sources.tables import TABLES
from tools.check_oracle import digest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_sql_twin(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_entry_smoke(spark):
    out = E.entry(spark)
    assert out.columns == ["label", "count", "share"]
    assert out.count() >= 1


def test_every_query_has_a_docstring():
    for name, fn in E.queries().items():
        assert fn.__doc__, name
