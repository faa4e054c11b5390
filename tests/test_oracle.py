"""Every registered query against its SQL on another engine."""

import math
from decimal import Decimal

import duckdb
import pytest
from conftest import TABLES

import __spark_entry__ as entry
from claimlens.plans.star_oracle import ORACLE
from claimlens.plans.star_queries import QUERIES

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE"}


@pytest.fixture(scope="module")
def engine(small_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{small_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    return "NaN" if isinstance(value, float) and math.isnan(value) else value


def sorted_rows(rows, columns):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, small_dir, engine, name):
    df = QUERIES[name](spark, small_dir)
    engine.execute(ORACLE[name])
    columns = [d[0] for d in engine.description]
    assert sorted(df.columns) == sorted(columns)
    assert {c: TYPES[t] for c, t in df.dtypes} == {d[0]: str(d[1]).upper() for d in engine.description}
    expected = engine.fetchall()
    assert expected, "a query without rows tests nothing"
    assert sorted_rows(df.collect(), df.columns) == sorted_rows(expected, columns)


def test_entry_runs(spark, small_dir):
    rows = entry.entry(spark).collect()
    assert {r.is_hotspot for r in rows} == {0, 1}
