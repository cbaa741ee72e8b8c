"""Queries with SQL against DuckDB on the same whole tables."""

import duckdb
import pytest

from fieldspark.llm.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    want = db.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    got = QUERIES[name](spark, DATA)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want.fetchall())


def test_one_query_for_each_operator():
    assert [n.split("_")[0] for n in sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == [f"op{k}" for k in range(1, 14)]
