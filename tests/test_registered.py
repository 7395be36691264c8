"""Every registered query against its SQL, on the smallest sample tables."""

from __future__ import annotations

from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry_module

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()

from tillweave.registered import QUERIES, SQL  # noqa: E402


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    return float(value) if isinstance(value, Decimal) else value


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted((tuple(_plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    cursor = duck.execute(SQL[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = sorted((tuple(_plain(r[i]) for i in order) for r in cursor.fetchall()), key=repr)
    assert got == want
    assert got, "a registered query must not be empty"


def test_entry_runs(spark):
    assert 0 < entry_module.entry(spark).count() <= 10
