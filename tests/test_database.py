"""SQLite tables read by several tasks, damaged files as rows, and written databases read back."""

import sqlite3

import pytest
from pyspark.sql import functions as F

from fieldspark.session import ready
from fieldspark.sources import database


@pytest.fixture(autouse=True)
def _ready(spark):
    ready(spark)
    spark.dataSource.register(database.SqliteSource)


def made(path, rows, columns="id INTEGER PRIMARY KEY, stamp REAL, label VARCHAR(9), image BLOB, note", table="Node", tail=""):
    db = sqlite3.connect(path)
    db.execute(f"CREATE TABLE {table} ({columns}){tail}")
    db.executemany(f"INSERT INTO {table} VALUES ({', '.join('?' * (columns.count(',') + 1))})", rows)
    db.commit()
    db.close()
    return str(path)


def read(spark, *paths, table="Node", **options):
    return spark.read.format("sqlite").options(table=table, **options).load(",".join(paths))


def test_a_large_table_is_read_by_several_tasks(spark, tmp_path):
    path = made(tmp_path / "map.db", [(i, i / 4, f"n{i % 7}", bytes([i % 256]), i) for i in range(1, 100_001)])
    df = read(spark, path, rows=20_000)
    assert df.dtypes == [("file", "string"), ("id", "bigint"), ("stamp", "double"), ("label", "string"), ("image", "binary"), ("note", "string")]
    assert df.select(F.spark_partition_id()).distinct().count() == 5
    got = df.agg(F.count("*"), F.countDistinct("id"), F.sum("id"), F.sum("stamp"), F.sum(F.col("note").cast("bigint")), F.sum(F.conv(F.hex("image"), 16, 10).cast("bigint"))).first()
    total = 100_000 * 100_001 // 2
    assert tuple(got) == (100_000, 100_000, total, total / 4, total, sum(i % 256 for i in range(1, 100_001)))


def test_values_of_any_kind(spark, tmp_path):
    rows = [(1, 2, None, "x", 1.5), (2, "late", b"\xff", None, b"raw"), (-5, None, "", b"", None), (2**62, 1e300, "ä", b"\x00", "t")]
    got = sorted(tuple(r)[1:] for r in read(spark, made(tmp_path / "a.db", rows), rows=100).collect())
    assert got == [(-5, None, "", b"", None), (1, 2.0, None, b"x", "1.5"), (2, None, "�", None, "raw"), (2**62, 1e300, "ä", b"\x00", "t")]


def test_tables_without_row_ids_views_and_empty_ones(spark, tmp_path):
    one = made(tmp_path / "a.db", [("k", 1)], "k TEXT PRIMARY KEY, v INT", tail=" WITHOUT ROWID")
    two = made(tmp_path / "b.db", [], "k TEXT PRIMARY KEY, v INT")
    db = sqlite3.connect(two)
    db.execute("CREATE VIEW Seen AS SELECT 'x' AS a, 3 AS b")
    db.commit()
    db.close()
    assert [tuple(r) for r in read(spark, one, two).collect()] == [(one, "k", 1)]
    assert [r["a"] for r in read(spark, two, table="Seen").collect()] == ["x"]
    assert read(spark, two).collect() == []
    with pytest.raises(Exception, match="no such table"):
        read(spark, two, table="Absent").collect()


def test_damage_is_a_row_or_an_error(spark, tmp_path):
    good = made(tmp_path / "good.db", [(i, 0.0, "", b"", None) for i in range(10)])
    text, gone, other = tmp_path / "text.db", str(tmp_path / "gone.db"), made(tmp_path / "other.db", [(1,)], "id INTEGER PRIMARY KEY")
    text.write_text("this is no database, and long enough to be looked at " * 40)
    torn = made(tmp_path / "torn.db", [(i, 0.0, "x" * 500, b"", None) for i in range(2000)])
    raw = bytearray(open(torn, "rb").read())
    raw[len(raw) // 2 :] = b"\x7f" * (len(raw) - len(raw) // 2)
    open(torn, "wb").write(raw)
    paths = (str(text), gone, good, other, torn)
    rows = read(spark, *paths, damaged="row", rows=500).collect()
    damaged = {r["file"] for r in rows if r["damage"]}
    assert damaged == {str(text), gone, other, torn}
    assert sorted(r["id"] for r in rows if r["file"] == good) == list(range(10))
    for p in (str(text), gone, other):
        assert [r["id"] for r in rows if r["file"] == p] == [None]
    with pytest.raises(Exception):
        read(spark, *paths).collect()


def test_written_and_read_back(spark, tmp_path):
    rows = [(i, f"t'{i}\"", i % 2 == 0, i / 3, bytes([i]), None) for i in range(100)] + [(None,) * 6]
    df = spark.createDataFrame(rows, "`select` int, `a b` string, c boolean, d double, e binary, f date").repartition(3)
    paths = database.write_sqlite(df, f"file://{tmp_path}/out", "odd name", rows=20)
    assert len(paths) >= 6
    got = read(spark, *paths, table="odd name").drop("file").collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted((tuple(r) for r in got), key=key) == [(a, b, None if c is None else int(c), d, None if e is None else bytes(e), f) for a, b, c, d, e, f in sorted(rows, key=key)]
    long = spark.createDataFrame([(i, "x" * 50_000) for i in range(600)], "id int, text string").coalesce(1)
    paths = database.write_sqlite(long, f"file://{tmp_path}/long", "t", size=1 << 23)  # files fill up by bytes too
    assert len(paths) == 3 and read(spark, *paths, table="t").where(F.length("text") == 50_000).agg(F.sum("id")).first()[0] == 600 * 599 // 2
    assert database.write_sqlite(df.limit(0), f"file://{tmp_path}/none", "t") == []
