"""Each query against its SQL on the same tables: names, row counts and values."""

import math
from pathlib import Path

import duckdb
import pytest

from fieldspark.plans import catalog

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
DATA = "/root/testdata/sf0.01"


def _norm(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6f}".replace("-0.000000", "0.000000")
    return str(v)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(_norm(r[i]) for i in order) for r in rows])


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, db, name):
    df = catalog.QUERIES[name](spark, DATA)
    got = [tuple(r) for r in df.collect()]
    assert got
    if name not in catalog.ORACLES:
        return
    want = db.execute(catalog.ORACLES[name])
    names, rows = [d[0] for d in want.description], want.fetchall()
    assert sorted(df.columns) == sorted(names)
    types = {r[0]: r[1] for r in db.execute(f"DESCRIBE {catalog.ORACLES[name]}").fetchall()}
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    assert _rows(df.columns, got) == _rows(names, rows)


def test_every_oracle_has_a_query():
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)
