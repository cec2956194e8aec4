"""Every query of the reference's operators against its SQL on the smallest tables, where they are at hand."""

import os

import duckdb
import pytest

from quarry.plans import registry

HERE = os.environ.get("TESTDATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(HERE), reason="no test tables")


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, name):
    df = registry.queries()[name](spark, HERE)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{HERE}/{table}.parquet'")
    rel = con.sql(registry.oracle_sql()[name])
    at = [rel.columns.index(c) for c in columns]
    assert sorted(rel.columns) == columns
    assert got == sorted(repr(tuple(r[k] for k in at)) for r in rel.fetchall())


def test_entry_points_agree():
    import __spark_entry__ as entry

    assert set(registry.queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
