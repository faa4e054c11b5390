import duckdb
import pytest

from claimlens.llm.queries import ORACLE, QUERIES

TABLES = ("documents", "embeddings", "benchmark")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, small_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small_dir}/{t}.parquet'")
    got = QUERIES[name](spark, small_dir)
    cursor = con.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(str, map(tuple, got.select(columns).collect()))) == sorted(map(str, cursor.fetchall()))
