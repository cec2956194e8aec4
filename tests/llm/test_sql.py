"""Queries that SQL can express, against it, on the smallest tables where they are at hand."""

import os

import duckdb
import pytest

from quarry.llm import registry

HERE = os.environ.get("TESTDATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(HERE), reason="no test tables")


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query(spark, name):
    df = registry.queries()[name](spark, HERE)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    con = duckdb.connect()
    for table in ("documents", "pages", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{HERE}/{table}.parquet'")
    rel = con.sql(registry.oracle_sql()[name])
    at = [rel.columns.index(c) for c in columns]
    assert sorted(rel.columns) == columns and got == sorted(repr(tuple(r[k] for k in at)) for r in rel.fetchall())


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_query_without_sql_reads_all_documents(spark, name):
    docs = spark.read.parquet(f"{HERE}/documents.parquet")
    got = registry.queries()[name](spark, HERE)
    assert got.columns[0] == "doc_id"
    ids = [r["doc_id"] for r in got.select("doc_id").collect()]
    if name.split("_")[0] in ("op5", "op6", "op9"):  # a row a document
        assert sorted(ids) == sorted(r["doc_id"] for r in docs.select("doc_id").collect())
    if name == "op5_byte_bpe":
        assert got.where("NOT round_trip").isEmpty()


def test_ten_queries_are_registered():
    assert [n.split("_")[0] for n in registry.queries()] == [f"op{k}" for k in range(1, 11)]
