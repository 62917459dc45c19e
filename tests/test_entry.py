"""Every registered query against its SQL."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from lexmill.plans import all_queries

SF = "/root/testdata/sf0.001"
QUERIES, SQL = all_queries().queries, all_queries().sql


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return c


def rows(table):
    names = sorted(table.schema.names)
    return names, sorted(map(repr, table.select(names).to_pylist()))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF).toArrow()
    assert got.num_rows
    if name in SQL:
        assert rows(got) == rows(duck.execute(SQL[name]).to_arrow_table())


def test_entry(spark):
    assert entry.entry(spark).columns == ["doc_id", "chunk_no", "chunk"]
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql()) <= set(entry.queries())
