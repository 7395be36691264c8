"""Queries that SQL can express, against it."""

from __future__ import annotations

import duckdb
import pytest

from tillweave.llm.queries import QUERIES, SQL


def _plain(value):
    return round(value, 4) if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted((tuple(_plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    cursor = con.execute(SQL[name])
    order = [[d[0] for d in cursor.description].index(c) for c in columns]
    want = sorted((tuple(_plain(r[i]) for i in order) for r in cursor.fetchall()), key=repr)
    assert got and got == want


def test_every_dealt_operator_has_a_query():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
