"""Operators that SQL can express, against their SQL in DuckDB."""

import duckdb
import pytest

from lapidar.llm.entries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    df = QUERIES[name](spark, SF)
    rel = con.sql(SQL[name])
    order = [rel.columns.index(c) for c in df.columns]
    assert sorted(df.columns) == sorted(rel.columns)
    assert sorted(map(tuple, df.collect()), key=repr) == sorted((tuple(r[i] for i in order) for r in rel.fetchall()), key=repr)
